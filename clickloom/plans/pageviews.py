"""Raw tracker events to hourly page-view facts, and facts to the hot keyword/article report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.dates import from_epoch_millis, local_time, parse_date
from clickloom.functions.urls import browser_app, canonical_source, traffic_source, url_signature
from clickloom.operators import rollups, trends
from clickloom.operators.filters import valid_events
from clickloom.operators.sessions import pageview_facts, session_metrics
from clickloom.session import materialise


def pageview_hours(
    events: DataFrame,
    tenants: DataFrame,
    rules: DataFrame,
    domains: DataFrame,
    source_rules: Sequence[tuple[str, str]] | None = None,
    own_aliases: dict[str, str] | None = None,
    local: bool = True,
    app_hosts: Sequence[str] = (),
    blog_networks: Sequence[str] = (),
) -> DataFrame:
    """Validate, sign, attribute, order and sum tracker events.

    ``tenants`` is (web_id), ``rules`` (web_id, pattern, group), ``domains`` (web_id, domain,
    subdomain); the three are configuration tables. ``app_hosts`` and ``blog_networks`` count as the tenant's own.
    """
    valid = valid_events(events, tenants)
    signed = url_signature(valid, rules, url="current_url").where(F.col("article_id") != "_")
    named = signed.join(domains.select("web_id", "domain", "subdomain"), "web_id", "left")
    raw = traffic_source(
        F.col("referrer_url"), F.col("current_url"), F.coalesce(browser_app(F.col("browser_type")), F.lit("")), source_rules
    )
    stamp = F.when(F.col("timestamp").isNotNull(), from_epoch_millis(F.col("timestamp"))).otherwise(
        F.to_timestamp_ntz("datetime")
    )
    views = named.withColumn("_raw", raw).select(
        "event_id", "web_id", "uuid", "article_id",
        stamp.alias("ts"),
        canonical_source(
            F.col("_raw"), F.col("web_id"), F.col("domain"), F.col("subdomain"), own_aliases, app_hosts, blog_networks
        ).alias("source_domain"),
        F.coalesce("record_user.t_p", F.lit(0)).cast("long").alias("time_on_page"),
    )
    # stored once: the session step reads the views twice and should not repeat the URL work
    views = materialise(views, "signed-views")
    clock = local_time(F.col("ts")) if local else F.col("ts")
    return pageview_facts(session_metrics(views), clock)


def hot_report(
    facts: DataFrame,
    articles: DataFrame,
    last_keywords: DataFrame,
    last_articles: DataFrame,
    texts: Sequence[str] = ("title",),
    own: str = "own",
) -> dict[str, DataFrame]:
    """All report tables of one run from one stored frame of article rows.

    ``articles`` is (web_id, article_id, texts.., keyword_list, is_cut); the ``last_*`` frames are
    the previous snapshot (web_id, date, key, pageviews). The article rows are written to the
    shared scratch folder once and every table starts from them.
    """
    rows = materialise(rollups.with_source(rollups.attach_articles(rollups.day_pageviews(facts), articles)), "day-rows")
    exploded = rollups.explode_keywords(rows)
    article_rows = rows.drop("keyword_list")
    keywords = rollups.keyword_rollup(exploded)
    by_article = rollups.article_rollup(article_rows, texts)
    return {
        "keyword": trends.trend(keywords, last_keywords, ["web_id", "date", "keyword"]),
        "article": trends.trend(by_article, last_articles, ["web_id", "date", "article_id"], base="now"),
        "keyword_by_source": rollups.source_rollup(exploded, "keyword", [*rollups.SOURCE_TABLES, own]),
        "article_by_source": rollups.source_rollup(article_rows, "article_id", [*rollups.SOURCE_TABLES, own]),
        "keyword_source_domain": rollups.source_pivot(exploded, "keyword", own),
        "article_source_domain": rollups.source_pivot(article_rows, "article_id", own),
        "keyword_article": exploded.select("web_id", "date", "keyword", "article_id", "is_cut").distinct(),
    }


def hourly_increase(facts: DataFrame, key: str = "article_id") -> DataFrame:
    """Views per key and hour of the day with the increase over the hour before, by weekday."""
    keys = ["web_id", key, "date"]
    delta = trends.hour_delta(trends.cumulative_by_hour(facts, keys), keys)
    return delta.withColumn("weekday", F.weekday(parse_date(F.col("date").cast("string"), "yyyyMMdd")) + 1)
