"""Small helpers that several operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(col: str = "text") -> Column:
    """The text itself; null counts as the empty text."""
    return F.coalesce(F.col(col), F.lit(""))


def keyed(df: DataFrame, key: str) -> DataFrame:
    """Rows that can be named: those without a key are left out of every result."""
    return df.where(F.col(key).isNotNull())


def shares(rows: int, each: int) -> int:
    """How many parts of about ``each`` rows ``rows`` make; at least one."""
    return max(1, -(-rows // each))
