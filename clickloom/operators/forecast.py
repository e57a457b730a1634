"""Daily series and Fourier forecasts.

A series is one array cell whose length is the number of days in the window, so it has a fixed
bound; the [pandas] steps transform a whole Arrow batch of series as one matrix.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.dates import day_index
from clickloom.functions.maths import growth_rate
from clickloom.operators.joins import enrich_by_title

AHEAD = 7


def pad_days(df: DataFrame, keys: Sequence[str], value: str, start: dt.date, end: dt.date, date: str = "date") -> DataFrame:
    """One row per item and day of the window, 0 where the item has none."""
    inside = df.where(F.col(date).between(F.lit(start), F.lit(end)))
    sums = inside.groupBy(*keys, date).agg(F.sum(value).alias(value))
    calendar = F.explode(F.sequence(F.lit(start), F.lit(end)))
    every = sums.select(*keys).distinct().withColumn(date, calendar)
    return every.join(sums, [*keys, date], "left").fillna(0, [value])


def daily_series(df: DataFrame, keys: Sequence[str], value: str, start: dt.date, end: dt.date, date: str = "date") -> DataFrame:
    """Sparse series per item: sorted (day, value) pairs, at most one per day of the window."""
    inside = df.where(F.col(date).between(F.lit(start), F.lit(end)))
    sums = inside.groupBy(*keys, date).agg(F.sum(value).cast("double").alias("_value"))
    point = F.struct(day_index(F.col(date), F.lit(start)).alias("day"), F.col("_value").alias("value"))
    return sums.groupBy(*keys).agg(F.sort_array(F.collect_list(point)).alias("points"))


def _dense(days: pd.Series, values: pd.Series, length: int) -> np.ndarray:
    """Zero-padded matrix (series x days); amounts are cut to whole numbers."""
    grid = np.zeros((len(days), length))
    for row, (d, v) in enumerate(zip(days, values)):
        grid[row, np.asarray(d, dtype=int) - 1] = v
    return np.trunc(grid)


def extrapolate(signals: np.ndarray, ahead: int, harmonics: int | None = None, detrend: bool = True) -> np.ndarray:
    """Continue each row by ``ahead`` days from its strongest harmonics.

    Frequencies are k / (n - 1) and only the first half of the spectrum is used, undoubled; these
    two choices define the result. The linear trend is slope * day without an intercept.
    """
    count, n = signals.shape
    day = np.arange(1, n + 1, dtype=float)
    future = np.arange(1, n + ahead + 1, dtype=float)
    centred = day - day.mean()
    slope = signals @ centred / (centred @ centred) if detrend else np.zeros(count)
    spectrum = np.fft.fft(signals - np.outer(slope, day), axis=1)[:, : n // 2]
    size, phase = np.abs(spectrum) / n, np.angle(spectrum)
    used = 1 + (n if harmonics is None else harmonics)
    if used < size.shape[1]:
        weak = np.argsort(-size, axis=1, kind="stable")[:, used:]
        np.put_along_axis(size, weak, 0.0, axis=1)
    waves = 2 * np.pi * np.outer(np.linspace(0, 1, n)[: n // 2], future)
    # amplitude * cos(wave + phase), as two matrix products
    restored = (size * np.cos(phase)) @ np.cos(waves) - (size * np.sin(phase)) @ np.sin(waves)
    return np.clip(restored + np.outer(slope, future), 0, None)


def restored_series(length: int, ahead: int = AHEAD, harmonics: int | None = None, detrend: bool = True):
    """[pandas] UDF (days, values) -> restored values for ``length + ahead`` days."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def restore(days: pd.Series, values: pd.Series) -> pd.Series:
        return pd.Series(list(extrapolate(_dense(days, values, length), ahead, harmonics, detrend)))

    return restore


def _mean(values: Column, start: int, count: int) -> Column:
    part = F.slice(values, start, count)
    return F.aggregate(part, F.lit(0.0), lambda a, x: a + x) / count


def forecast(
    df: DataFrame, keys: Sequence[str], value: str, start: dt.date, end: dt.date, harmonics: int | None = None
) -> DataFrame:
    """Mean of the last known and of the next seven days per item, with the growth between them."""
    length = (end - start).days + 1
    series = daily_series(df, keys, value, start, end)
    restored = series.withColumn("_all", restored_series(length, AHEAD, harmonics)("points.day", "points.value"))
    last = _mean(F.col("_all"), -2 * AHEAD, AHEAD)
    ahead = _mean(F.col("_all"), -AHEAD, AHEAD)
    return restored.select(*keys, last.alias("revenue_l7"), ahead.alias("revenue_f7")).withColumn(
        "grow_rate", growth_rate(F.col("revenue_f7"), F.col("revenue_l7"))
    )


def forecast_days(
    df: DataFrame, keys: Sequence[str], value: str, start: dt.date, end: dt.date, ahead: int = AHEAD,
    harmonics: int | None = None,
) -> DataFrame:
    """Predicted value per item and future day."""
    length = (end - start).days + 1
    series = daily_series(df, keys, value, start, end)
    restored = series.withColumn("_all", restored_series(length, ahead, harmonics)("points.day", "points.value"))
    future = F.posexplode(F.slice("_all", -ahead, ahead)).alias("_pos", "predicted")
    return restored.select(*keys, future).select(
        *keys, F.date_add(F.lit(end), F.col("_pos") + 1).alias("date"), "predicted"
    )


def backtest(
    df: DataFrame, keys: Sequence[str], value: str, start: dt.date, end: dt.date, held_out: int = 30
) -> DataFrame:
    """Mean absolute error per item of a forecast for the last ``held_out`` days."""
    cut = end - dt.timedelta(days=held_out)
    predicted = forecast_days(df, keys, value, start, cut, ahead=held_out)
    actual = df.where(F.col("date").between(F.lit(cut + dt.timedelta(days=1)), F.lit(end)))
    actual = actual.groupBy(*keys, "date").agg(F.sum(value).cast("double").alias("_actual"))
    both = predicted.join(actual, [*keys, "date"], "left").fillna(0.0, ["_actual"])
    return both.groupBy(*keys).agg(F.avg(F.abs(F.col("predicted") - F.col("_actual"))).alias("mae"))


def power_spectrum(df: DataFrame, keys: Sequence[str], value: str, start: dt.date, end: dt.date) -> DataFrame:
    """Frequency, power and phase per item for the first half of the spectrum."""
    length = (end - start).days + 1
    kind = T.ArrayType(T.StructType([T.StructField("psd", T.DoubleType()), T.StructField("phase", T.DoubleType())]))

    @F.pandas_udf(kind)
    def spectrum(days: pd.Series, values: pd.Series) -> pd.Series:
        half = np.fft.fft(_dense(days, values, length), axis=1)[:, : length // 2]
        power, phase = np.abs(half) ** 2 / length, np.angle(half)
        return pd.Series([[{"psd": a, "phase": b} for a, b in zip(p, q)] for p, q in zip(power, phase)])

    series = daily_series(df, keys, value, start, end)
    cells = series.select(*keys, F.posexplode(spectrum("points.day", "points.value")).alias("k", "_c"))
    return cells.select(
        *keys, "k", (F.col("k") / F.lit(length - 1)).alias("freq"), F.col("_c.psd").alias("psd"), F.col("_c.phase").alias("phase")
    )


def revenue_forecast(ads: DataFrame, items: DataFrame, start: dt.date, end: dt.date, money: str = "revenue") -> DataFrame:
    """Forecast per tenant and title with the product id; titles without a product are dropped."""
    known = enrich_by_title(forecast(ads, ["web_id", "title"], money, start, end), items, keep_unknown=False)
    return known.withColumn("date", F.lit(end))
