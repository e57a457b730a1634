"""Page-view roll-ups by article, keyword and source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.filters import SOURCE_NAMES, recode
from clickloom.operators.joins import salted_join
from clickloom.operators.ranking import top_k

MEASURES = ("pageviews", "landings", "exits", "bounce", "time_on_page")

# fixed values: external source buckets besides the publisher's own network and ``other``
SOURCE_BUCKETS = (
    "google", "facebook", "yahoo", "xuite", "youtube", "line", "feed_related", "dcard", "ptt", "edm",
)
SOURCE_TABLES = ("google", "facebook", "xuite", "yahoo", "line", "youtube")


def _sums() -> list[Column]:
    return [F.sum(m).alias(m) for m in MEASURES]


def day_pageviews(facts: DataFrame, split_ids: bool = False) -> DataFrame:
    """All (article, source) rows per tenant and day; ``split_ids`` cuts article ids at ``&`` first."""
    rows = facts.withColumn("article_id", F.split("article_id", "&")[0]) if split_ids else facts
    return rows.groupBy("web_id", "date", "article_id", "source_domain").agg(*_sums())


def hot_pageviews(facts: DataFrame, n: int) -> DataFrame:
    """The ``n`` busiest (article, source) rows per tenant and day, for a report of the top; roll-ups take all rows."""
    order = [F.desc("pageviews"), F.asc("article_id"), F.asc("source_domain")]
    return top_k(day_pageviews(facts), ["web_id", "date"], order, n)


def attach_articles(rows: DataFrame, articles: DataFrame, spread: int | None = None) -> DataFrame:
    """Day rows with article columns. Rows are already one per (day, article, source)."""
    on = ["web_id", "article_id"]
    return salted_join(rows, articles, on, spread=spread) if spread else rows.join(articles, on)


def with_source(rows: DataFrame) -> DataFrame:
    """Adds the display source and whether the view came from the tenant's own pages."""
    source = recode("source_domain", SOURCE_NAMES)
    return rows.withColumn("source", source).withColumn("internal", F.col("source") == F.col("web_id"))


def explode_keywords(rows: DataFrame, keywords: str = "keyword_list") -> DataFrame:
    """One row per (article row, keyword); repeated keywords of one article count again."""
    return rows.withColumn("keyword", F.explode(keywords)).drop(keywords)


def _split_counts() -> list[Column]:
    zero = F.lit(0).cast("long")
    return [
        F.sum(F.when(~F.col("internal"), F.col("pageviews")).otherwise(zero)).alias("external_source_count"),
        F.sum(F.when(F.col("internal"), F.col("pageviews")).otherwise(zero)).alias("internal_source_count"),
    ]


def keyword_rollup(rows: DataFrame) -> DataFrame:
    """Keyword totals per tenant and day; ``is_cut`` comes from the busiest row that has it."""
    first_seen = F.struct(-F.col("pageviews"), F.col("article_id"), F.col("source_domain"))
    return rows.groupBy("web_id", "date", "keyword").agg(
        *_sums(), *_split_counts(), F.min_by("is_cut", first_seen).alias("is_cut")
    )


def article_rollup(rows: DataFrame, texts: Sequence[str] = ("title",)) -> DataFrame:
    """Article totals per tenant and day with the texts of the busiest row."""
    first_seen = F.struct(-F.col("pageviews"), F.col("source_domain"))
    return rows.groupBy("web_id", "date", "article_id").agg(
        *_sums(), *_split_counts(), *[F.min_by(t, first_seen).alias(t) for t in texts]
    )


def source_rollup(rows: DataFrame, key: str, sources: Sequence[str] = SOURCE_TABLES) -> DataFrame:
    """Totals per source and key for the listed sources: one frame instead of a table per source."""
    kept = rows.where(F.col("source").isin(*sources))
    return kept.groupBy("web_id", "date", "source", key).agg(*_sums())


def source_pivot(
    rows: DataFrame, key: str, own: str = "own", buckets: Sequence[str] = SOURCE_BUCKETS
) -> DataFrame:
    """Page views per source bucket as columns, plus their total.

    Tenant-internal views go to ``internal``, sources outside ``buckets`` and ``own`` to ``other``.
    """
    named = [*buckets, own]
    bucket = (
        F.when(F.col("internal"), "internal")
        .when(F.col("source").isin(*named), F.col("source"))
        .otherwise("other")
    )
    columns = ["internal", *named, "other"]
    # one conditional sum per literal bucket: a pivot without a second aggregation
    sums = [
        F.coalesce(F.sum(F.when(F.col("_bucket") == c, F.col("pageviews"))), F.lit(0).cast("long")).alias(c)
        for c in columns
    ]
    return (
        rows.withColumn("_bucket", bucket)
        .groupBy("web_id", "date", key)
        .agg(*sums, F.sum("pageviews").alias("pageviews"))
    )
