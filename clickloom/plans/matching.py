"""Similarity jobs: related keywords, trend x catalogue, ads x articles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators import keywords, reports, similarity
from clickloom.operators.filters import active_on
from clickloom.operators.joins import keep_not_in
from clickloom.operators.ranking import top_k


def related_keywords(facts: DataFrame, vectors: DataFrame, above: int = 10, n: int | None = None) -> DataFrame:
    """Related keywords among each tenant's read ones, or its ``n`` hottest. ``facts`` is (web_id, keyword, pageviews)."""
    hot = facts.where(F.col("pageviews") > above)
    if n is not None:
        hot = top_k(hot, ["web_id"], [F.desc("pageviews"), F.asc("keyword")], n)
    words = hot.select("web_id", F.col("keyword").alias("word")).distinct().join(vectors.select("word", "vector"), "word")
    return similarity.keyword_similarity(words)


def trend_products(
    trends: DataFrame, item_keywords: DataFrame, vectors: DataFrame, day: dt.date, n: int | None = None, **thresholds: float
) -> DataFrame:
    """Products whose title keywords are close to trending searches, with date and thresholds.

    ``item_keywords`` is (web_id, product_id, keyword).
    """
    known = vectors.select("word", "vector")
    hot = reports.top_trends(trends, day, n=n).select(F.col("keyword").alias("word")).join(known, "word")
    words = item_keywords.select(F.col("keyword").alias("word")).distinct().join(known, "word")
    # words are compared once for all tenants; the first product is then looked up per tenant
    matches = similarity.trend_catalogue_match(words, hot, keys=(), **thresholds)
    carriers = item_keywords.select("web_id", F.col("keyword").alias("keyword_item")).distinct()
    named = matches.join(carriers, "keyword_item")
    return similarity.attach_first_product(named, item_keywords).withColumn("date", F.lit(day))


def ad_matches(
    articles: DataFrame,
    ads: DataFrame,
    rejected: DataFrame,
    vectors: DataFrame,
    article_terms: DataFrame,
    ad_terms: DataFrame,
    today: dt.date,
    text: Column,
) -> DataFrame:
    """Best active, not rejected ad per article.

    ``articles`` and ``ads`` are (id, text ..); ads also carry start_time and end_time. The ``*_terms``
    frames are extracted keyword lists (id, keyword_list) for texts that are not lists themselves.
    """
    live = keep_not_in(active_on(ads, today), rejected, ["id"])

    def words(rows: DataFrame, terms: DataFrame, owner: str) -> DataFrame:
        lists = keywords.flexible_keywords(rows, "id", text, terms)
        named = lists.select(F.col("id").alias(owner), F.explode("keyword_list").alias("word"))
        return named.join(vectors.select("word", "vector"), "word", "left").select(owner, "word", "vector")

    return similarity.match_ads(words(articles, article_terms, "article_id"), words(live, ad_terms, "ad_id"))
