"""Report tables: rates over rolling windows, search-console and ads reports, trends, revenue."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.dates import months_before
from clickloom.operators.joins import keep_not_in, lookup_default
from clickloom.operators.ranking import keep_first, rank_rows, running_total, top_n
from clickloom.session import materialise

REPORT_WINDOWS = {"yesterday": 1, "week": 7, "month": 30}
REPORT_DOMAINS = ("google", "facebook", "xuite", "yahoo", "line", "youtube")


def in_windows(
    df: DataFrame, date: str, today: dt.date, windows: Mapping[str, int] = REPORT_WINDOWS, out: str = "types"
) -> DataFrame:
    """Repeat each row once per rolling window (a few literals) that its date falls in."""
    hits = [F.when(F.col(date) >= F.lit(today - dt.timedelta(days=n)), F.lit(name)) for name, n in windows.items()]
    upto = df.where(F.col(date) <= F.lit(today))
    return upto.withColumn(out, F.explode(F.array_compact(F.array(*hits))))


def keyword_articles(rows: DataFrame, today: dt.date, windows: Mapping[str, int] = REPORT_WINDOWS) -> DataFrame:
    """Articles per keyword and window, one row each, with the keyword's number of rows beside it.

    ``rows`` is (web_id, keyword, article_id, date); ``days`` counts an article's rows in the window. No list of
    ids is built, so a keyword may have any number of articles.
    """
    keys = ["types", "web_id", "keyword"]
    counted = in_windows(rows, "date", today, windows).groupBy(*keys, "article_id").agg(F.count("*").alias("days"))
    totals = counted.groupBy(*keys).agg(F.sum("days").alias("article_count"))
    return counted.join(totals, keys)


def article_rates(
    rows: DataFrame,
    today: dt.date,
    windows: Mapping[str, int] = REPORT_WINDOWS,
    domains: Sequence[str] = REPORT_DOMAINS,
) -> DataFrame:
    """Share of tenant page views, landing and bounce rate per article, source and window.

    ``rows`` is (web_id, article_id, title, source, date, pageviews, landings, bounce). Every source
    and ``all`` come out of one pass; a source without page views has no rows.
    """
    listed = F.when(F.col("source").isin(*domains), F.col("source"))
    spread = in_windows(rows, "date", today, windows).withColumn(
        "domain", F.explode(F.array_compact(F.array(F.lit("all"), listed)))
    )
    sums = spread.groupBy("types", "web_id", "domain", "article_id").agg(
        F.max("title").alias("title"), *[F.sum(c).alias(c) for c in ("pageviews", "landings", "bounce")]
    )
    totals = sums.groupBy("types", "web_id", "domain").agg(F.sum("pageviews").alias("_total"))
    rated = sums.join(totals.where(F.col("_total") != 0), ["types", "web_id", "domain"])
    return rated.select(
        "types", "web_id", "domain", "article_id", "title",
        F.try_divide("pageviews", "_total").alias("total_pageviews_rate"),
        F.try_divide("landings", "pageviews").alias("total_landings_rate"),
        F.try_divide("bounce", "pageviews").alias("total_bounce_rate"),
    )


def with_published(rates: DataFrame, published: DataFrame, today: dt.date) -> DataFrame:
    """Publication day (yyyyMMdd) of each article, the report day when unknown."""
    default = F.lit(int(today.strftime("%Y%m%d")))
    return lookup_default(rates, published, ["web_id", "article_id"], {"published_time": default})


def tenant_totals(
    rows: DataFrame,
    today: dt.date,
    windows: Mapping[str, int] = REPORT_WINDOWS,
    domains: Sequence[str] = REPORT_DOMAINS,
) -> DataFrame:
    """Page views per tenant and window, in total and per source column."""
    zero = F.lit(0).cast("long")
    columns = [
        F.sum(F.when(F.col("source") == d, F.col("pageviews")).otherwise(zero)).alias(d) for d in domains
    ]
    spread = in_windows(rows, "date", today, windows)
    return spread.groupBy("types", "web_id").agg(F.sum("pageviews").alias("pageviews"), *columns)


def console_report(df: DataFrame, dimension_sets: Sequence[Sequence[str]]) -> DataFrame:
    """Clicks, impressions and impression-weighted position for several dimension sets at once."""
    names = list(dict.fromkeys(d for dims in dimension_sets for d in dims))
    weighted = df.withColumn("_weight", F.col("position") * F.col("impressions"))
    sets = [[F.col(d) for d in dims] for dims in dimension_sets]
    return (
        weighted.groupingSets(sets, *[F.col(n) for n in names])
        .agg(
            F.grouping_id().alias("grouping_set"),
            F.sum("clicks").alias("clicks"),
            F.sum("impressions").alias("impressions"),
            F.try_divide(F.sum("_weight"), F.sum("impressions")).alias("position"),
        )
    )


def query_product_rank(pages: DataFrame, similar: DataFrame, min_clicks: int = 1) -> DataFrame:
    """Search queries ranked by clicks for products that have similar products.

    ``pages`` is (web_id, query, product_id, clicks) with product ids from URL signatures.
    """
    known = pages.where(
        (F.col("clicks") > min_clicks) & (F.col("product_id") != "_") & (F.col("product_id") != F.col("web_id"))
    )
    one = keep_first(known, ["web_id", "product_id"], [F.desc("clicks"), F.asc("query")])
    # `similar` is a top-n report, so the ranked rows are few per tenant
    joined = one.join(similar, ["web_id", "product_id"])
    return rank_rows(joined, ["web_id"], [F.desc("clicks"), F.asc("product_id")], "rank")


def merge_vocab(*lines: DataFrame, column: str = "line") -> DataFrame:
    """Union of ``word freq tag`` lines: three-field lines, distinct, without the tag, sorted."""
    merged = lines[0].select(column)
    for more in lines[1:]:
        merged = merged.union(more.select(column))
    fields = F.split(F.col(column), " ")
    kept = merged.where(F.size(fields) == 3).distinct()
    return kept.select(F.array_join(F.slice(fields, 1, 2), " ").alias(column)).orderBy(column)


def backfill_missing(asked: DataFrame, returned: DataFrame, today: dt.date) -> DataFrame:
    """Metrics plus a zero row for every asked keyword that came back without any.

    ``google_available`` is 1 for returned and 0 for added rows.
    """
    missing = keep_not_in(asked.select("keyword_ask").distinct(), returned, ["keyword_ask"])
    month = {"year": today.year, "month": today.month}
    added = missing.withColumns(
        {
            "keyword_join": F.replace("keyword_ask", F.lit(" "), F.lit("")),
            "keyword_google": F.col("keyword_ask"),
            "competition_level": F.lit(""),
            **{c: F.lit(0.0) for c in ("low_price", "high_price")},
            **{c: F.lit(0).cast("long") for c in ("avg_monthly_traffic", "monthly_traffic")},
            **{c: F.lit(v) for c, v in month.items()},
            "date": F.lit(today),
            "google_available": F.lit(0),
        }
    )
    return returned.withColumn("google_available", F.lit(1)).unionByName(added, allowMissingColumns=True)


def refresh_due(history: DataFrame, today: dt.date, n: int = 50) -> DataFrame:
    """Keywords last seen over three months ago without a row for the target month, busiest first."""
    day = F.lit(today)
    usable = history.where(F.col("google_available") == 1)
    target = months_before(day, 2)
    fresh = usable.where((F.col("year") == F.year(target)) & (F.col("month") == F.month(target)))
    stale = usable.where(F.col("date") < F.add_months(day, -3))
    due = keep_not_in(stale, fresh, ["keyword_ask"])
    best = due.groupBy("keyword_ask").agg(F.max("monthly_traffic").alias("monthly_traffic"))
    return top_n(best, [F.desc("monthly_traffic"), F.asc("keyword_ask")], n)


def label_batch(
    keywords: DataFrame, tenant: str, article: str, keyword: str, n_keywords: int = 1000, slice_size: int = 10_000,
    articles: DataFrame | None = None,
) -> DataFrame:
    """Articles in id order up to the one that takes the distinct keyword count past ``n_keywords``.

    A keyword counts at its first article; the running count is summed in id ranges, so a tenant
    with very many articles is many tasks. ``articles`` (tenant, article) are those with a keyword, if they are at hand.
    """
    firsts = keywords.groupBy(tenant, keyword).agg(F.min(article).alias(article))
    fresh = firsts.groupBy(tenant, article).agg(F.count("*").alias("_new"))
    every = (keywords if articles is None else articles).select(tenant, article).distinct()
    placed = materialise(every.join(fresh, [tenant, article], "left").fillna(0, ["_new"]), "label-batch")  # read twice
    counted = running_total(
        placed, [tenant], [F.col(article)], F.col("_new"),
        F.floor(F.col(article) / slice_size), out="distinct_keywords",
    )
    before = F.col("distinct_keywords") - F.col("_new")
    return counted.where(before <= n_keywords).drop("_new")


def top_trends(trends: DataFrame, end: dt.date, days: int = 2, n: int | None = 200) -> DataFrame:
    """The ``n`` most searched keywords of the last ``days``, or all of them."""
    window = trends.where(F.col("date").between(F.lit(end - dt.timedelta(days=days - 1)), F.lit(end)))
    total = window.groupBy("keyword").agg(F.sum("traffic").alias("traffic_total"))
    return total if n is None else top_n(total, [F.desc("traffic_total"), F.asc("keyword")], n)


def interest_means(series: DataFrame, keyword: str = "keyword", value: str = "value") -> DataFrame:
    return series.groupBy(keyword).agg(F.avg(value).alias("avg_traffic"))


def daily_revenue(ads: DataFrame, money: str = "revenue") -> DataFrame:
    """Sums per (tenant, title, day) over rows with revenue and a URL, one product id per group."""
    kept = ads.where((F.col(money) > 0) & (F.col("url") != "_"))
    return kept.groupBy("web_id", "title", "date").agg(
        F.min("product_id").alias("product_id"),
        *[F.sum(c).alias(c) for c in ("transaction", "click", money)],
    )


def daily_report(ads: DataFrame, measures: Sequence[str], source: str = "google") -> DataFrame:
    """Sums per (tenant, day, product) of one source."""
    kept = ads.where(F.col("source") == source)
    return kept.groupBy("web_id", "date", "product_id").agg(
        F.min("title").alias("title"), *[F.sum(m).alias(m) for m in measures]
    )


def hot_items(ads: DataFrame, money: str = "revenue", n: int = 20) -> DataFrame:
    sums = ads.groupBy("title").agg(F.sum(money).alias(money))
    return top_n(sums, [F.desc(money), F.asc("title")], n)


