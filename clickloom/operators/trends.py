"""Comparisons between snapshots and between hours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators.joins import align_now_last

EXACT_ZERO = 0.0


def trend(now: DataFrame, last: DataFrame, keys: Sequence[str], base: str = "last", value: str = "pageviews") -> DataFrame:
    """Relative change against the previous snapshot.

    ``base='last'``: (now - last) / last. ``base='now'``: (now - last) / now * 100.
    A key without a previous value has trend 0, and so has a division by zero (no infinities).
    """
    both = align_now_last(now, last, keys, value)
    current, before = F.col(value).cast("double"), F.col(f"{value}_last").cast("double")
    if base == "last":
        change = F.try_divide(current - before, before)
    elif base == "now":
        change = F.try_divide(current - before, current) * 100
    else:
        raise ValueError("base is 'last' or 'now'")
    return both.withColumns(
        {
            "trend": F.coalesce(change, F.lit(EXACT_ZERO)),
            f"{value}_last": F.coalesce(F.col(f"{value}_last"), F.lit(0).cast("long")),
        }
    )


def _hour_rule(diff: Column, value: Column, before: Column, hour: Column) -> Column:
    zero = F.lit(0).cast("long")
    known = F.coalesce(diff, zero)
    lifted = F.when((F.coalesce(before, zero) == 0) & (known == 0) & (value != 0), value).otherwise(known)
    return F.when(hour == 0, value).otherwise(lifted)


def hour_delta(
    snapshots: DataFrame, keys: Sequence[str], hour: str = "hour", value: str = "pageviews"
) -> DataFrame:
    """Increase of a cumulative daily counter over the hour before it.

    ``keys`` include the day, so a window holds at most 24 rows. Hour 0, and a key without an
    earlier hour, report the full value.
    """
    line = Window.partitionBy(*keys).orderBy(hour)
    adjacent = F.lag(hour).over(line) == F.col(hour) - 1
    before = F.when(adjacent, F.lag(value).over(line))
    marked = snapshots.withColumn("_before", before)
    rule = _hour_rule(F.col(value) - F.col("_before"), F.col(value), F.col("_before"), F.col(hour))
    return marked.withColumn(f"{value}_hour", rule).drop("_before")


def cumulative_by_hour(facts: DataFrame, keys: Sequence[str], hour: str = "hour", value: str = "pageviews") -> DataFrame:
    """Day-to-date value at each hour that has data (keys include the day)."""
    sums = facts.groupBy(*keys, hour).agg(F.sum(value).alias(value))
    line = Window.partitionBy(*keys).orderBy(hour).rowsBetween(Window.unboundedPreceding, 0)
    return sums.withColumn(value, F.sum(value).over(line))
