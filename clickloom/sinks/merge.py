"""Row-level table changes as DataFrame transformations, and their writers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.session import materialise

BUCKETS = 16
PRUNED = 1000  # values of a partition column that a scan is told


def replace_into(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whole-row upsert; ``new`` has one row per key."""
    return old.join(new, list(keys), "left_anti").unionByName(new)


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Insert new keys and update ``columns`` (default all) of known ones.

    A matched flag decides, so a new null wins over an old value.
    """
    keys = list(keys)
    values = [c for c in old.columns if c not in keys]
    changed = set(values if columns is None else columns)
    left = old.select(*keys, F.struct(*values).alias("_old"), F.lit(True).alias("_had"))
    right = new.select(*keys, F.struct(*values).alias("_new"), F.lit(True).alias("_has"))
    both = left.join(right, keys, "full")

    def value(name: str) -> Column:
        fresh, kept = F.col(f"_new.{name}"), F.col(f"_old.{name}")
        take = F.col("_has").isNotNull() if name in changed else F.col("_had").isNull()
        return F.when(take, fresh).otherwise(kept).alias(name)

    return both.select(*keys, *[value(c) for c in values]).select(*old.columns)


def update_where(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Update ``columns`` of matched rows; nothing is inserted."""
    incoming = new.select(*keys, F.struct(*columns).alias("_new"), F.lit(True).alias("_has"))
    joined = old.join(incoming, list(keys), "left")
    updates = {c: F.when(F.col("_has"), F.col(f"_new.{c}")).otherwise(F.col(c)) for c in columns}
    return joined.withColumns(updates).select(*old.columns)


def insert_ignore(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``new`` to append: those whose key the table does not have."""
    return new.join(old, list(keys), "left_anti")


def drop_expired(df: DataFrame, today: dt.date, column: str = "expired_date") -> DataFrame:
    return df.where(F.col(column) >= F.lit(today))


def keep_days(df: DataFrame, today: dt.date, days: int = 91, column: str = "date") -> DataFrame:
    """Retention of the last ``days`` days, yesterday being the newest."""
    return df.where(F.col(column) >= F.lit(today - dt.timedelta(days=days - 1)))


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is not true (null keeps the row)."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def write_table(df: DataFrame, path: str, by: Sequence[str] = (), max_rows: int = 1_000_000) -> None:
    """One distributed write; ``max_rows`` bounds each file."""
    df.write.mode("overwrite").option("maxRecordsPerFile", max_rows).partitionBy(*by).parquet(path)


def overwrite_partitions(df: DataFrame, root: str, by: Sequence[str]) -> None:
    """Replace only the partitions that ``df`` has rows for (a weekday ring, a report day)."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(root)


def write_tables(tables: Mapping[str, DataFrame], root: str, by: Mapping[str, Sequence[str]] | None = None) -> None:
    """Write named tables below ``root``; share a materialised input between them first."""
    for name, df in tables.items():
        write_table(df, f"{root}/{name}", (by or {}).get(name, ()))


def read_or_none(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.parquet(root)
    except AnalysisException as err:
        if err.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def table_buckets(spark: SparkSession, root: str, wanted: int = BUCKETS) -> int:
    """Hash buckets of the table at ``root``; a table that has none yet gets ``wanted`` and keeps them.

    The number lies beside the rows in a folder that readers of the table skip.
    """
    stored = read_or_none(spark, f"{root}/_properties")
    if stored is not None:
        return stored.first()["buckets"]
    spark.createDataFrame([(wanted,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(f"{root}/_properties")
    return wanted


def touched_rows(table: DataFrame, fresh: DataFrame, layout: Sequence[str], bound: int = PRUNED) -> DataFrame:
    """The table's rows in partitions that ``fresh`` names.

    The join decides. Up to ``bound`` values of a partition column are also written into the scan as literals, so that
    other partitions are not even listed; beyond it a range of values is.
    """
    named = fresh.select(*layout).distinct()
    for column in layout:
        values = [r[0] for r in fresh.select(column).distinct().limit(bound + 1).collect()]
        known = [v for v in values if v is not None]
        if len(values) > bound:
            low, high = fresh.agg(F.min(column), F.max(column)).first()
            inside = F.col(column).between(low, high)
        else:
            inside = F.col(column).isin(known) if known else F.lit(False)
        table = table.where(inside if len(known) == len(values) <= bound else inside | F.col(column).isNull())
    same = [F.col(f"t.{c}").eqNullSafe(F.col(f"n.{c}")) for c in layout]
    return table.alias("t").join(named.alias("n"), same, "left_semi")


def merge_into(
    new: DataFrame,
    root: str,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    by: Sequence[str] = (),
    buckets: int = BUCKETS,
) -> None:
    """Upsert ``new`` (one row per key) into a parquet table of partitions ``by`` and hash buckets.

    ``by`` names key columns with few values per batch (the day of a report); only partitions that
    ``new`` touches are read and rewritten, so a daily batch leaves older days alone. The merged
    rows are first written to the shared scratch folder: the table is never read while it is
    replaced, a failed replacement can be run again, and the same input twice gives the same table.
    ``buckets`` counts when the table is made; choose it so that a partition's bucket fits a task. Rows are
    clustered by bucket before they are written, so each has few files.
    """
    if not set(by) <= set(keys):
        raise ValueError("partition columns have to be part of the key")
    spark = new.sparkSession
    layout = [*by, "bucket"]
    bucket = F.pmod(F.xxhash64(*keys), F.lit(table_buckets(spark, root, buckets))).cast("int")
    fresh = materialise(new.withColumn("bucket", bucket), "merge-input")
    old = read_or_none(spark, root)
    merged = fresh
    if old is not None:
        old = old.select(*[F.col(f.name).cast(f.dataType) for f in fresh.schema.fields])
        old = touched_rows(old, fresh, layout).select(*fresh.columns)
        merged = materialise(upsert(old, fresh, [*keys, "bucket"], columns), "merged")
    overwrite_partitions(merged.repartition(*layout), root, layout)


def read_merged(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(root).drop("bucket")
