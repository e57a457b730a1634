"""Word-list files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_word_list(spark: SparkSession, path: str, lower: bool = False) -> DataFrame:
    """One word per line as column ``word``; stopword lists are read with ``lower``."""
    lines = spark.read.text(path).withColumnRenamed("value", "word")
    return lines.withColumn("word", F.lower("word")) if lower else lines
