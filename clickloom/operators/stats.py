"""Histograms, fits and mixture scores."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import maths


def _count_bins(placed: DataFrame, total_bins: Column, center: Column, width: Column) -> DataFrame:
    counts = placed.groupBy("bin").agg(F.count("*").alias("count"))
    every = placed.sparkSession.range(1).select(F.explode(F.sequence(F.lit(0).cast("long"), total_bins)).alias("bin"))
    filled = every.join(counts, "bin", "left").fillna(0, ["count"])
    with_total = filled.withColumn("_total", counts.agg(F.sum("count")).scalar())
    return with_total.select(
        "bin",
        center.alias("center"),
        "count",
        (F.col("count") / F.col("_total") / width).alias("density"),
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between minimum and maximum; the last bin is closed on both sides.

    A constant column is widened by 0.5 on each side. Counts are aggregated map-side; only the
    range travels, as a scalar subquery.
    """
    value = F.col(column).cast("double")
    low0, high0 = df.agg(F.min(value)).scalar(), df.agg(F.max(value)).scalar()
    flat = low0 == high0
    low = F.when(flat, low0 - 0.5).otherwise(low0)
    high = F.when(flat, high0 + 0.5).otherwise(high0)
    ranged = df.where(value.isNotNull()).select(value.alias("_x"), low.alias("_low"), high.alias("_high"))
    width = (F.col("_high") - F.col("_low")) / bins
    guess = F.least(F.floor((F.col("_x") - F.col("_low")) / width), F.lit(bins - 1))

    def edge(i: Column) -> Column:
        return F.col("_low") + i * width

    # the division can land one bin off at an edge; the edges themselves decide
    fixed = (
        F.when(F.col("_x") < edge(guess), guess - 1)
        .when((guess < bins - 1) & (F.col("_x") >= edge(guess + 1)), guess + 1)
        .otherwise(guess)
    )
    placed = ranged.select(fixed.cast("long").alias("bin"))
    bin_width = (high - low) / bins
    return _count_bins(placed, F.lit(bins - 1).cast("long"), low + (F.col("bin") + 0.5) * bin_width, bin_width)


def histogram_width(
    df: DataFrame, column: str, width: float, start: float | None = None, end: float | None = None
) -> DataFrame:
    """Bins of a given width over edges start, start + width, .. below end + 1; the last is closed."""
    value = F.col(column).cast("double")
    low = F.lit(float(start)) if start is not None else df.agg(F.min(value)).scalar()
    high = F.lit(float(end)) if end is not None else df.agg(F.max(value)).scalar()
    last = (F.ceil((high + 1 - low) / width) - 2).cast("long")
    ranged = df.where(value.isNotNull()).select(value.alias("_x"), low.alias("_low"), last.alias("_last"))
    spot = F.floor((F.col("_x") - F.col("_low")) / width)
    closing = F.col("_x") == F.col("_low") + (F.col("_last") + 1) * width
    placed = ranged.withColumn("bin", F.when(closing, F.col("_last")).otherwise(spot).cast("long"))
    placed = placed.where(F.col("bin").between(F.lit(0), F.col("_last"))).select("bin")
    return _count_bins(placed, last, low + (F.col("bin") + 0.5) * width, F.lit(float(width)))


def linear_fit(df: DataFrame, x: Column, y: Column, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept")
    )


def mean_plus_std(df: DataFrame, keys: Sequence[str], value: str, out: str = "upper") -> DataFrame:
    """Mean plus one population standard deviation."""
    return df.groupBy(*keys).agg((F.avg(value) + F.stddev_pop(value)).alias(out))


def standardise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / sample standard deviation per column."""
    scaled = {}
    for name in columns:
        mean, spread = df.agg(F.avg(name)).scalar(), df.agg(F.stddev_samp(name)).scalar()
        scaled[name] = F.try_divide(F.col(name) - mean, spread)
    return df.withColumns(scaled)


class Component(NamedTuple):
    """One mixture component: weight, peak (mean, sigma) and decay time; unused parts are None."""

    weight: float
    mean: float | None = None
    sigma: float | None = None
    tau: float | None = None


def component_density(part: Component, x: Column | None, t: Column | None, log: bool = False) -> Column:
    """Weighted density of a Gaussian, exponential or combined component, or its logarithm."""
    terms = [F.lit(part.weight)] if not log else [F.ln(F.lit(part.weight))]
    if part.mean is not None:
        shape = maths.ln_gauss if log else maths.gauss
        terms.append(shape(x, F.lit(part.mean), F.lit(part.sigma)))
    if part.tau is not None:
        shape = maths.ln_exp_density if log else maths.exp_density
        terms.append(shape(t, F.lit(part.tau)))
    result = terms[0]
    for term in terms[1:]:
        result = result + term if log else result * term
    return result


def score_mixture(
    df: DataFrame, components: Sequence[Component], x: Column | None = None, t: Column | None = None
) -> DataFrame:
    """Adds the most likely component and the mixture log-density of each row.

    Components are literals in the plan, so scoring needs neither a join nor a shuffle.
    """
    logs = F.array(*[component_density(c, x, t, log=True) for c in components])
    top = F.array_max("_logs")
    total = F.aggregate("_logs", F.lit(0.0), lambda acc, v: acc + F.exp(v - top))
    return (
        df.withColumn("_logs", logs)
        .withColumn("component", (F.array_position("_logs", top) - 1).cast("long"))
        .withColumn("log_density", top + F.ln(total))
        .drop("_logs")
    )
