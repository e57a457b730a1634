"""Incremental reads by stored high-water ids, and latest-n reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.ranking import top_k


def incremental(df: DataFrame, marks: DataFrame, tenant: str = "web_id", id_col: str = "id", n: int | None = None) -> DataFrame:
    """Rows above each tenant's stored id (``marks`` is (tenant, id_record)), the ``n`` lowest if given."""
    joined = df.join(marks.select(tenant, "id_record"), tenant, "left")
    fresh = joined.where(F.col(id_col) > F.coalesce("id_record", F.lit(-1))).drop("id_record")
    return fresh if n is None else top_k(fresh, [tenant], [F.asc(id_col)], n)


def high_water(df: DataFrame, tenant: str = "web_id", id_col: str = "id") -> DataFrame:
    """New marks after a batch."""
    return df.groupBy(tenant).agg(F.max(id_col).alias("id_record"))


def latest_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The latest ``n`` rows of every tenant in one job."""
    return top_k(df, keys, order, n)
