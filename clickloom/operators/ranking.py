"""Top-k, positions and running values that hold up when one key owns most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Spark prunes `row_number() <= k` inside each map task only up to this k
# (spark.sql.optimizer.windowGroupLimitThreshold); larger k is ranked in two stages.
MAP_SIDE_LIMIT = 1000


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def top_k(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    k: int,
    rank: str | None = None,
    spread: int = 64,
) -> DataFrame:
    """First ``k`` rows of every key in ``order`` (which should be total).

    Small k is pruned before the shuffle by Spark's window group limit. Larger k is first ranked
    inside ``spread`` hash slices of the key, so no task ever sorts a whole hot key.
    """
    out = rank or "_rank"
    if k > MAP_SIDE_LIMIT:
        slices = Window.partitionBy(*_cols(keys), "_slice").orderBy(*order)
        df = (
            df.withColumn("_slice", F.pmod(F.xxhash64(*_cols(df.columns)), F.lit(spread)))
            .withColumn("_rank1", F.row_number().over(slices))
            .where(F.col("_rank1") <= k)
            .drop("_slice", "_rank1")
        )
    window = Window.partitionBy(*_cols(keys)).orderBy(*order)
    ranked = df.withColumn(out, F.row_number().over(window)).where(F.col(out) <= k)
    return ranked if rank else ranked.drop(out)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """De-duplicate on ``keys`` keeping the first row in ``order``."""
    return top_k(df, keys, order, 1)


def top_n(df: DataFrame, order: Sequence[Column], n: int, offset: int = 0) -> DataFrame:
    """Global ``ORDER BY .. LIMIT n [OFFSET m]``."""
    ordered = df.orderBy(*order)
    return (ordered.offset(offset) if offset else ordered).limit(n)


def rank_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str = "rank") -> DataFrame:
    """1..n inside each key; for keys whose size is known to be small (reports after a top-n)."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*_cols(keys)).orderBy(*order)))


def add_position(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], slice_by: Column, out: str = "position"
) -> DataFrame:
    """Exact 1-based position of each row inside its key, without one task per key.

    ``slice_by`` must not decrease along ``order`` (a day of a timestamp, a range of an id). Rows
    are numbered inside (key, slice); slice sizes, one row each, carry the offset over.
    """
    part = [*keys, "_slice"]
    sliced = df.withColumn("_slice", slice_by)
    sizes = sliced.groupBy(*part).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*_cols(keys)).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy(*part).orderBy(*order)
    numbered = sliced.withColumn("_inside", F.row_number().over(inside))
    return (
        numbered.join(offsets, part)
        .withColumn(out, F.col("_inside") + F.col("_offset"))
        .drop("_slice", "_inside", "_offset")
    )


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    value: Column,
    slice_by: Column,
    out: str = "running",
) -> DataFrame:
    """Cumulative sum along ``order`` inside each key, in slices like :func:`add_position`."""
    part = [*keys, "_slice"]
    sliced = df.withColumn("_slice", slice_by).withColumn("_value", value)
    sums = sliced.groupBy(*part).agg(F.sum("_value").alias("_s"))
    before = Window.partitionBy(*_cols(keys)).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("_offset", F.coalesce(F.sum("_s").over(before), F.lit(0))).drop("_s")
    inside = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        sliced.withColumn("_inside", F.sum("_value").over(inside))
        .join(offsets, part)
        .withColumn(out, F.col("_inside") + F.col("_offset"))
        .drop("_slice", "_value", "_inside", "_offset")
    )


def moving_average(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    value: str,
    window: int,
    slice_by: Column,
    mode: str = "sliding",
    out: str = "average",
    block: int = 4096,
) -> DataFrame:
    """Trailing mean of ``window`` rows (partial at the head), or the mean of full fixed blocks.

    ``sliding`` keeps every row. Rows are cut into blocks of ``block`` positions and the last
    ``window - 1`` rows of a block are copied to the next one, so a long series is many tasks.
    ``fixing`` returns one row per complete block of ``window`` rows.
    """
    placed = add_position(df, keys, order, slice_by, "_pos")
    if mode == "fixing":
        groups = placed.groupBy(*keys, F.floor((F.col("_pos") - 1) / window).alias("block"))
        means = groups.agg(F.avg(value).alias(out), F.count("*").alias("_n"))
        return means.where(F.col("_n") == window).drop("_n")
    size = max(block, window)
    home = F.floor((F.col("_pos") - 1) / size)
    is_tail = F.pmod(F.col("_pos") - 1, F.lit(size)) >= size - window + 1
    homes = F.when(is_tail & F.lit(window > 1), F.array(home, home + 1)).otherwise(F.array(home))
    copied = placed.withColumn("_home", home).withColumn("_block", F.explode(homes))
    frame = (
        Window.partitionBy(*_cols(keys), "_block").orderBy("_pos").rowsBetween(-(window - 1), 0)
    )
    return (
        copied.withColumn(out, F.avg(value).over(frame))
        .where(F.col("_block") == F.col("_home"))
        .drop("_pos", "_home", "_block")
    )
