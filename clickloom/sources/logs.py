"""Tables and time-partitioned logs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.operators.filters import filter_by


def read_table(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, where: Column | None = None
) -> DataFrame:
    """Parquet scan; columns and predicates are pushed into it."""
    df = spark.read.parquet(path)
    df = df.where(where) if where is not None else df
    return df.select(*columns) if columns else df


def spread_small(df: DataFrame, below: int = 1 << 30) -> DataFrame:
    """Share a small scan out to all cores before CPU-heavy text work.

    A small file often is a single split. Its size is read from the plan's statistics; anything
    larger keeps its own splits and is not shuffled.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if size < below else df


def spread_by(df: DataFrame, key: str, below: int = 4 << 20) -> DataFrame:
    """Share a scan out by ``key``, in parts of about ``below`` bytes of its files, before its rows are taken apart.

    Whole rows travel once; what a part makes of them and groups by the key and more columns stays where it is, and a
    part's groups fit in memory.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-size // below)), key)


def read_query(spark: SparkSession, url: str, query: str, split: str, low: int, high: int, parts: int, **options: str) -> DataFrame:
    """Database query read in ``parts`` ranges of the numeric column ``split``."""
    reader = spark.read.format("jdbc").options(**options)
    return reader.options(
        url=url, dbtable=f"({query}) q", partitionColumn=split, lowerBound=low, upperBound=high, numPartitions=parts
    ).load()


def dump_log(df: DataFrame, root: str, ts: str = "ts") -> None:
    """Write a log as ``date=yyyy-MM-dd/hour=h`` partitions.

    The rebalance hint gathers an hour's rows into few files and lets AQE split a busy hour.
    """
    stamped = df.withColumns({"date": F.date_format(ts, "yyyy-MM-dd"), "hour": F.hour(ts)})
    stamped.hint("rebalance", "date", "hour").write.partitionBy("date", "hour").parquet(root)


def read_hours(
    spark: SparkSession, root: str, start: dt.datetime, end: dt.datetime, prefix: str | None = None
) -> DataFrame:
    """Log rows of the half-open hour range, read from only the partitions inside it."""
    log = spark.read.parquet(f"{root}/{prefix}" if prefix else root)
    # a text key over both partition columns keeps the range a pure partition predicate
    key = F.concat(F.date_format(F.col("date").cast("date"), "yyyy-MM-dd"), F.lpad(F.col("hour").cast("string"), 2, "0"))
    return log.where((key >= start.strftime("%Y-%m-%d%H")) & (key < end.strftime("%Y-%m-%d%H")))


def read_day(spark: SparkSession, root: str, day: dt.date, prefix: str | None = None) -> DataFrame:
    first = dt.datetime.combine(day, dt.time())
    return read_hours(spark, root, first, first + dt.timedelta(days=1), prefix)


def read_latest_hour(spark: SparkSession, root: str, now: dt.datetime, prefix: str | None = None) -> DataFrame:
    first = now.replace(minute=0, second=0, microsecond=0)
    return read_hours(spark, root, first, first + dt.timedelta(hours=1), prefix)


def read_latest_minute(spark: SparkSession, root: str, now: dt.datetime, ts: str = "ts", prefix: str | None = None) -> DataFrame:
    """Rows of the minute before ``now``."""
    end = now.replace(second=0, microsecond=0)
    start = end - dt.timedelta(minutes=1)
    rows = read_latest_hour(spark, root, start, prefix)
    low, high = (F.lit(x.isoformat(sep=" ")).cast("timestamp_ntz") for x in (start, end))
    return rows.where((F.col(ts) >= low) & (F.col(ts) < high))


def repair_glued(c: Column) -> Column:
    """Objects written back to back, or parted by ``"landing"`` marks, as one JSON array text."""
    mark = '("landing")+'
    joined = F.replace(c, F.lit("}{"), F.lit("},{"))
    joined = F.regexp_replace(joined, rf"\}}{mark}\{{", "},{")
    joined = F.regexp_replace(joined, rf"\A{mark}\{{", "{")
    joined = F.regexp_replace(joined, rf"\}}{mark}\z", "}")
    return F.concat(F.lit("["), joined, F.lit("]"))


def parse_glued(df: DataFrame, text: str, schema: T.StructType | str) -> DataFrame:
    """One row per object; text that cannot be repaired yields no rows and never fails the scan."""
    kind = schema if isinstance(schema, str) else schema.simpleString()
    kind = kind if kind.startswith("struct<") else f"struct<{kind}>"
    parsed = F.from_json(repair_glued(F.col(text)), f"array<{kind}>")
    rest = [c for c in df.columns if c != text]
    return df.select(*rest, F.explode(parsed).alias("_o")).where(F.col("_o").isNotNull()).select(*rest, "_o.*")


def read_glued_json(spark: SparkSession, path: str, schema: T.StructType | str, whole: bool = True) -> DataFrame:
    """Glued JSON files (``whole``: an object is a file; else one text per line)."""
    return parse_glued(spark.read.text(path, wholetext=whole), "value", schema)


def parse_document(df: DataFrame, text: str, schema: T.StructType, out: str = "document") -> DataFrame:
    """Single JSON documents as a struct; ``readable`` is false where the text is no such document."""
    marked = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    parsed = F.from_json(text, marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    return df.withColumn(out, parsed).withColumn(
        "readable", F.col(out).isNotNull() & F.col(f"{out}._bad").isNull()
    )


def filter_log(df: DataFrame, criteria: Mapping[str, Any] | None = None) -> DataFrame:
    """Rows that carry the asked fields (by default an event type and a tenant)."""
    return filter_by(df, criteria if criteria is not None else {"event_type": None, "web_id": None})


def dump_filtered(df: DataFrame, root: str, criteria: Mapping[str, Any] | None = None, ts: str = "ts") -> None:
    dump_log(filter_log(df, criteria), root, ts)


def count_objects(spark: SparkSession, path: str) -> DataFrame:
    """Number and size of non-empty files; the content column is pruned, so nothing is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.where(F.col("length") > 0).agg(F.count("*").alias("objects"), F.sum("length").alias("bytes"))
