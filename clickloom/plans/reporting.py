"""Report jobs: article metrics, article ids, revenue, search console, ads metrics, trends, dictionaries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.urls import url_key, url_signature
from clickloom.operators import forecast, joins, keywords, reports, sets
from clickloom.operators.ranking import keep_first
from clickloom.session import materialise
from clickloom.sinks.merge import upsert
from clickloom.sources.landed import flatten_console, flatten_ideas, flatten_trends


def article_metrics(rows: DataFrame, published: DataFrame, today: dt.date) -> tuple[DataFrame, DataFrame]:
    """Rates per article, source and window, and the tenant totals behind them."""
    rates = reports.with_published(reports.article_rates(rows, today), published, today)
    stamp = F.lit(int(today.strftime("%Y%m%d")))
    return rates.withColumn("date", stamp), reports.tenant_totals(rows, today).withColumn("date", stamp)


def article_ids(bridge: DataFrame, today: dt.date) -> DataFrame:
    stamp = F.lit(int(today.strftime("%Y%m%d")))
    return reports.keyword_articles(bridge, today).withColumn("date", stamp)


def daily_ads(ads: DataFrame, items: DataFrame, day: dt.date, money: str = "revenue") -> DataFrame:
    """One day's revenue per title with the product id of the title."""
    daily = reports.daily_revenue(ads.where(F.col("date") == F.lit(day)), money)
    return joins.enrich_by_title(daily, items)


def revenue_outlook(ads: DataFrame, items: DataFrame, start: dt.date, end: dt.date, money: str = "revenue") -> DataFrame:
    """Seven-day outlook per tenant and title from the daily revenue fact."""
    return forecast.revenue_forecast(reports.daily_revenue(ads, money), items, start, end, money)


def console_tables(responses: dict[str, DataFrame], dimensions: dict[str, Sequence[str]], items: DataFrame) -> dict[str, DataFrame]:
    """Flattened search-console tables; those with a page get product, title and description."""
    tables = {}
    for name, df in responses.items():
        flat = flatten_console(df, dimensions[name])
        if "page" in dimensions[name]:
            flat = joins.enrich_by_url(
                flat, items, url_key(F.col("page")), url_key(F.col("url")), ("product_id", "title", "description")
            )
        tables[name] = flat
    return tables


def console_products(console: DataFrame, rules: DataFrame, similar: DataFrame, day: dt.date) -> DataFrame:
    """Search queries that lead to products, with three similar products each."""
    signed = url_signature(console, rules, url="page", out="product_id", ignore_case=True, prefix=False)
    return reports.query_product_rank(signed, similar).withColumn("date", F.lit(day))


def new_keywords(asked: Sequence[DataFrame], history: DataFrame, n: int) -> DataFrame:
    """Keywords never asked before, at most ``n`` (the service's daily allowance)."""
    every = sets.union_all(*[a.select("keyword_ask") for a in asked]).distinct()
    unseen = joins.keep_not_in(every, history, ["keyword_ask"])
    return unseen.orderBy("keyword_ask").limit(n)


def refresh_metrics(history: DataFrame, asked: DataFrame, ideas: DataFrame, today: dt.date, first_time: bool) -> DataFrame:
    """Metrics table after a batch of answers.

    First-time keywords replace whole rows and get a zero row when unanswered; a refresh updates the
    monthly traffic only.
    """
    answered = flatten_ideas(ideas, asked).withColumn("google_available", F.lit(1))
    keys = ["keyword_ask", "year", "month"]
    if not first_time:
        return upsert(history, answered.select(*history.columns), keys, ["monthly_traffic"])
    filled = reports.backfill_missing(asked, answered, today)
    return upsert(history, filled.select(*history.columns), keys)


def load_trends(stored: DataFrame, landed: DataFrame) -> DataFrame:
    """Trend table after loading landed responses."""
    return upsert(stored, flatten_trends(landed).select(*stored.columns), ["keyword", "traffic", "date"])


def corpus_idf(editorial: DataFrame, texts: DataFrame, tokens: keywords.Tokens) -> DataFrame:
    """IDF over keyword sets: editorial lists and the token sets of articles without one.

    Both frames carry ``id``; ``editorial`` has ``keywords``. ``tokens`` is an array column or a frame (id, term).
    """
    listed = editorial.select("id", F.explode(F.array_distinct(F.transform(F.split("keywords", ","), lambda k: F.trim(k)))).alias("term"))
    cut = keywords.clean_tokens(keywords.explode_tokens(texts, "id", tokens), "term").select("id", "term")
    return keywords.train_idf(listed.unionByName(cut).withColumn("freq", F.lit(1)))


def label_set(texts: DataFrame, ranked: DataFrame, n: int = 1000, per_article: int = 10) -> DataFrame:
    """Keywords to label: from the articles, in id order, that together bring over ``n`` keywords."""
    best = ranked.where(F.col("rank") <= per_article).join(texts.select("id", "web_id"), "id")
    top = materialise(best.select("web_id", "id", "term"), "label-set")  # read for the batch and for its keywords
    batch = reports.label_batch(top, "web_id", "id", "term", n)
    return top.join(batch.select("web_id", "id"), ["web_id", "id"], "left_semi").select("web_id", "term").distinct()


def copy_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Configuration copy: the listed columns, one row per tenant."""
    return keep_first(df.select(*columns), ["web_id"], [F.asc_nulls_last(c) for c in columns])
