"""A*: aggregations and report tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from clickloom.catalog.registry import query, with_
from clickloom.catalog.tables import (
    AD_DAYS, DOCS, FACTS_BASE, KEY_SQL, ROWS_BASE, TAGS, ad_days, article_rows, docs, event_key, facts,
    keyword_rows, table, tags, texts, texts_by_id,
)
from clickloom.functions import text as tx
from clickloom.functions.dates import parse_date
from clickloom.operators import joins, keywords, reports, rollups, sets, stats, usertags
from clickloom.session import materialise

TODAY = dt.date(2024, 1, 31)
MEASURE_SQL = ", ".join(f"CAST(sum({m}) AS BIGINT) AS {m}" for m in rollups.MEASURES)
SPLIT_SQL = """CAST(sum(CASE WHEN NOT internal THEN pageviews ELSE 0 END) AS BIGINT) AS external_source_count,
  CAST(sum(CASE WHEN internal THEN pageviews ELSE 0 END) AS BIGINT) AS internal_source_count"""

COUNTS = """counts AS (SELECT web_id, usertag, count(*) AS term_freq, count(DISTINCT token) AS token_count,
  count(DISTINCT uuid) AS uuid_count FROM tags GROUP BY ALL)"""


@query("A1_tag_counts", with_(TAGS, COUNTS, select="SELECT * FROM counts"))
def tag_counts(spark, sf):
    return usertags.tag_counts(tags(spark, sf))


def _black(spark, sf):
    """Labels as a black list: toxic document ids name the tag in every tenant."""
    toxic = table(spark, sf, "labels").where(F.col("toxic") == 1)
    return toxic.select(
        F.concat(F.lit("t"), F.col("doc_id").cast("string")).alias("usertag"),
        F.explode(F.array(*[F.lit(f"w{i}") for i in range(3)])).alias("web_id"),
    )


BLACK = """black AS (SELECT DISTINCT w.web_id, 't' || doc_id AS usertag FROM labels, (SELECT unnest(['w0','w1','w2']) AS web_id) w
  WHERE toxic = 1)"""


@query(
    "A2_usertag_report",
    with_(
        TAGS, COUNTS, BLACK,
        """ordered AS (SELECT *, row_number() OVER (PARTITION BY web_id ORDER BY token_count) - 1 AS idx,
    count(*) OVER (PARTITION BY web_id) AS n FROM counts),
lim AS (SELECT web_id, n, CASE WHEN n < 60 THEN avg(token_count) - 50 ELSE
    max(CASE WHEN idx = CAST(floor((1 - 60.0 / n) * (n - 1)) AS BIGINT) THEN token_count END) +
    (max(CASE WHEN idx = CAST(ceil((1 - 60.0 / n) * (n - 1)) AS BIGINT) THEN token_count END) -
     max(CASE WHEN idx = CAST(floor((1 - 60.0 / n) * (n - 1)) AS BIGINT) THEN token_count END)) *
    ((1 - 60.0 / n) * (n - 1) - floor((1 - 60.0 / n) * (n - 1))) END AS freq_limit FROM ordered GROUP BY web_id, n)""",
        select="""SELECT c.*, CASE WHEN b.usertag IS NULL THEN 1 ELSE 0 END AS enable, '2024-02-04' AS expired_date
  FROM counts c JOIN lim USING (web_id) LEFT JOIN black b ON b.web_id = c.web_id AND b.usertag = c.usertag
  WHERE (n >= 60 OR token_count > 2) AND token_count > freq_limit""",
    ),
)
def usertag_report(spark, sf):
    return usertags.usertag_report(tags(spark, sf), _black(spark, sf), F.lit("2024-02-04"), many=60)


@query(
    "J8_blacklist_flag",
    with_(
        TAGS, COUNTS, BLACK,
        select="""SELECT c.web_id, c.usertag, CASE WHEN b.usertag IS NULL THEN 1 ELSE 0 END AS enable
  FROM counts c LEFT JOIN black b ON b.web_id = c.web_id AND b.usertag = c.usertag""",
    ),
)
def blacklist_flag(spark, sf):
    counts = usertags.tag_counts(tags(spark, sf))
    return joins.flag_blacklist(counts, _black(spark, sf), ["web_id", "usertag"]).select("web_id", "usertag", "enable")


@query(
    "A3_hot_pageviews",
    with_(
        *ROWS_BASE[:5],
        select="""SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY web_id, date
  ORDER BY pageviews DESC, article_id, source_domain) AS rk FROM days) WHERE rk <= 20""",
    ),
)
def hot_pageviews(spark, sf):
    return rollups.hot_pageviews(facts(spark, sf), 20)


@query("A4_pageview_facts", with_(*FACTS_BASE, select="SELECT * FROM facts"))
def pageview_facts(spark, sf):
    return facts(spark, sf)


@query(
    "A5_keyword_rollup",
    with_(
        *ROWS_BASE,
        select=f"""SELECT web_id, date, keyword, {MEASURE_SQL}, {SPLIT_SQL},
  arg_min(is_cut, (-pageviews, article_id, source_domain)) AS is_cut FROM krows GROUP BY web_id, date, keyword""",
    ),
)
def keyword_rollup(spark, sf):
    return rollups.keyword_rollup(keyword_rows(spark, sf))


@query(
    "A6_article_rollup",
    with_(
        *ROWS_BASE,
        select=f"""SELECT web_id, date, article_id, {MEASURE_SQL}, {SPLIT_SQL}, any_value(title) AS title
  FROM arows GROUP BY web_id, date, article_id""",
    ),
)
def article_rollup(spark, sf):
    return rollups.article_rollup(article_rows(spark, sf))


SOURCES_SQL = "('google','facebook','xuite','yahoo','line','youtube')"


@query(
    "A7_source_keyword_rollup",
    with_(
        *ROWS_BASE,
        select=f"SELECT web_id, date, source, keyword, {MEASURE_SQL} FROM krows WHERE source IN {SOURCES_SQL} GROUP BY 1, 2, 3, 4",
    ),
)
def source_keyword_rollup(spark, sf):
    return rollups.source_rollup(keyword_rows(spark, sf), "keyword")


@query(
    "A7_source_article_rollup",
    with_(
        *ROWS_BASE,
        select=f"SELECT web_id, date, source, article_id, {MEASURE_SQL} FROM arows WHERE source IN {SOURCES_SQL} GROUP BY 1, 2, 3, 4",
    ),
)
def source_article_rollup(spark, sf):
    return rollups.source_rollup(article_rows(spark, sf), "article_id")


def _bucket_sql(columns):
    return ", ".join(f"CAST(sum(CASE WHEN bucket = '{c}' THEN pageviews ELSE 0 END) AS BIGINT) AS {c}" for c in columns)


BUCKETS = ("internal", *rollups.SOURCE_BUCKETS, "own", "other")
NAMED = ", ".join(f"'{b}'" for b in (*rollups.SOURCE_BUCKETS, "own"))
BUCKETED = f"""bucketed AS (SELECT *, CASE WHEN internal THEN 'internal' WHEN source IN ({NAMED}) THEN source ELSE 'other' END
  AS bucket FROM krows)"""


@query(
    "A8_source_pivot",
    with_(
        *ROWS_BASE, BUCKETED,
        select=f"""SELECT web_id, date, keyword, {_bucket_sql(BUCKETS)}, CAST(sum(pageviews) AS BIGINT) AS pageviews
  FROM bucketed GROUP BY web_id, date, keyword""",
    ),
)
def source_pivot(spark, sf):
    return rollups.source_pivot(keyword_rows(spark, sf), "keyword")


@query(
    "A9_cross_hot_keywords",
    with_(
        *ROWS_BASE,
        f"k AS (SELECT keyword, {MEASURE_SQL}, {SPLIT_SQL} FROM krows GROUP BY keyword ORDER BY pageviews DESC, keyword LIMIT 12)",
        "bridge AS (SELECT DISTINCT web_id, keyword, article_id FROM krows)",
        select="SELECT k.*, b.mentioned_articles FROM k JOIN (SELECT keyword, count(*) AS mentioned_articles FROM bridge GROUP BY 1) b USING (keyword)",
    ),
)
def cross_hot_keywords(spark, sf):
    rows = keyword_rows(spark, sf)
    measures = [*rollups.MEASURES, "external_source_count", "internal_source_count"]
    bridge = rows.select("web_id", "keyword", "article_id").distinct()
    return joins.cross_hot(rollups.keyword_rollup(rows), bridge, "keyword", measures, n=12)


@query(
    "A10_cross_hot_sources",
    with_(
        *ROWS_BASE, BUCKETED,
        f"""k AS (SELECT keyword, {_bucket_sql(BUCKETS)}, CAST(sum(pageviews) AS BIGINT) AS pageviews FROM bucketed
  GROUP BY keyword ORDER BY pageviews DESC, keyword LIMIT 12)""",
        "bridge AS (SELECT DISTINCT web_id, keyword, article_id FROM krows)",
        select="SELECT k.*, b.mentioned_articles FROM k JOIN (SELECT keyword, count(*) AS mentioned_articles FROM bridge GROUP BY 1) b USING (keyword)",
    ),
)
def cross_hot_sources(spark, sf):
    rows = keyword_rows(spark, sf)
    bridge = rows.select("web_id", "keyword", "article_id").distinct()
    return joins.cross_hot(rollups.source_pivot(rows, "keyword"), bridge, "keyword", [*BUCKETS, "pageviews"], n=12)


@query(
    "J10_hot_bridge",
    with_(
        *FACTS_BASE,
        """k AS (SELECT article_id, CAST(sum(pageviews) AS BIGINT) AS pageviews FROM facts GROUP BY 1
  ORDER BY pageviews DESC, article_id LIMIT 25)""",
        select=f"""SELECT k.article_id, k.pageviews, count(*) AS mentioned_articles FROM k
  JOIN (SELECT 'a' || {KEY_SQL} AS article_id FROM events) e USING (article_id) GROUP BY 1, 2""",
    ),
)
def hot_bridge(spark, sf):
    bridge = table(spark, sf, "events").select(F.concat(F.lit("a"), event_key().cast("string")).alias("article_id"), "event_id")
    return joins.cross_hot(facts(spark, sf), bridge, "article_id", ["pageviews"], n=25, mentioned="event_id")


def dated(rows):
    return rows.withColumn("date", parse_date(F.col("date").cast("string"), "yyyyMMdd"))


WINDOWED = """wins(types, days) AS (VALUES ('yesterday', 1), ('week', 7), ('month', 30)),
arows_d AS (SELECT *, strptime(CAST(date AS VARCHAR), '%Y%m%d')::DATE AS d FROM arows),
win AS (SELECT types, a.* FROM arows_d a JOIN wins ON d >= DATE '2024-01-31' - CAST(days AS INTEGER) AND d <= DATE '2024-01-31')"""


@query(
    "A11_keyword_articles",
    with_(
        *ROWS_BASE,
        """wins(types, days) AS (VALUES ('yesterday', 1), ('week', 7), ('month', 30)),
pairs AS (SELECT DISTINCT web_id, keyword, article_id, strptime(CAST(date AS VARCHAR), '%Y%m%d')::DATE AS d FROM krows)""",
        select="""SELECT types, web_id, keyword, article_id, count(*) AS days,
  CAST(sum(count(*)) OVER (PARTITION BY types, web_id, keyword) AS BIGINT) AS article_count FROM pairs
  JOIN wins ON d >= DATE '2024-01-31' - CAST(days AS INTEGER) AND d <= DATE '2024-01-31' GROUP BY types, web_id, keyword, article_id""",
    ),
)
def keyword_articles(spark, sf):
    pairs = dated(keyword_rows(spark, sf)).select("web_id", "keyword", "article_id", "date").distinct()
    return reports.keyword_articles(pairs, TODAY)


@query(
    "A12_article_rates",
    with_(
        *ROWS_BASE, WINDOWED,
        f"""dom AS (SELECT *, 'all' AS domain FROM win UNION ALL SELECT *, source AS domain FROM win WHERE source IN {SOURCES_SQL}),
sums AS (SELECT types, web_id, domain, article_id, max(title) AS title, sum(pageviews) AS pv, sum(landings) AS la, sum(bounce) AS bo
  FROM dom GROUP BY 1, 2, 3, 4),
tot AS (SELECT types, web_id, domain, sum(pv) AS total FROM sums GROUP BY 1, 2, 3)""",
        select="""SELECT s.types, s.web_id, s.domain, s.article_id, title, round(CAST(pv AS DOUBLE) / CAST(total AS DOUBLE), 8) AS total_pageviews_rate,
  round(CAST(la AS DOUBLE) / CAST(pv AS DOUBLE), 8) AS total_landings_rate, round(CAST(bo AS DOUBLE) / CAST(pv AS DOUBLE), 8) AS total_bounce_rate,
  20240131 AS published_time
  FROM sums s JOIN tot t USING (types, web_id, domain)""",
    ),
)
def article_rates(spark, sf):
    rates = reports.article_rates(dated(article_rows(spark, sf)), TODAY)
    names = ("total_pageviews_rate", "total_landings_rate", "total_bounce_rate")
    published = docs(spark, sf).select("web_id", "article_id", F.lit(20240101).alias("published_time"))
    rounded = rates.withColumns({n: F.round(n, 8) for n in names})
    return reports.with_published(rounded, published, TODAY)


@query(
    "A13_tenant_totals",
    with_(
        *ROWS_BASE, WINDOWED,
        select="SELECT types, web_id, CAST(sum(pageviews) AS BIGINT) AS pageviews, "
        + ", ".join(
            f"CAST(sum(CASE WHEN source = '{d}' THEN pageviews ELSE 0 END) AS BIGINT) AS {d}" for d in reports.REPORT_DOMAINS
        )
        + " FROM win GROUP BY 1, 2",
    ),
)
def tenant_totals(spark, sf):
    return reports.tenant_totals(dated(article_rows(spark, sf)), TODAY)


@query(
    "A14_daily_revenue",
    with_(
        AD_DAYS,
        select="""SELECT web_id, title, CAST(date AS VARCHAR) AS date, min(product_id) AS product_id, CAST(sum(transaction) AS BIGINT) AS transaction,
  CAST(sum(click) AS BIGINT) AS click, CAST(sum(cents) AS BIGINT) AS cents FROM ad_days WHERE cents > 0 AND url <> '_'
  GROUP BY web_id, title, date""",
    ),
)
def daily_revenue(spark, sf):
    return reports.daily_revenue(ad_days(spark, sf), "cents").withColumn("date", F.col("date").cast("string"))


@query(
    "A15_daily_report",
    with_(
        AD_DAYS,
        select="""SELECT web_id, CAST(date AS VARCHAR) AS date, product_id, min(title) AS title, CAST(sum(click) AS BIGINT) AS click,
  CAST(sum(transaction) AS BIGINT) AS transaction, CAST(sum(cents) AS BIGINT) AS cents
  FROM ad_days WHERE source = 'google' GROUP BY web_id, date, product_id""",
    ),
)
def daily_report(spark, sf):
    rows = reports.daily_report(ad_days(spark, sf), ["click", "transaction", "cents"])
    return rows.withColumn("date", F.col("date").cast("string"))


@query(
    "A27_hot_items",
    with_(AD_DAYS, select="SELECT title, CAST(sum(cents) AS BIGINT) AS cents FROM ad_days GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"),
)
def hot_items(spark, sf):
    return reports.hot_items(ad_days(spark, sf), "cents")


TREND_ROWS = f"""trends AS (SELECT 'kw' || {KEY_SQL} AS keyword, CAST(ts AS DATE) AS date, CAST(round(value) AS BIGINT) AS traffic FROM events)"""


def trend_rows(spark, sf):
    return table(spark, sf, "events").select(
        F.concat(F.lit("kw"), event_key().cast("string")).alias("keyword"),
        F.to_date("ts").alias("date"),
        F.round("value").cast("long").alias("traffic"),
    )


@query(
    "A16_top_trends",
    with_(
        TREND_ROWS,
        select="""SELECT keyword, CAST(sum(traffic) AS BIGINT) AS traffic_total FROM trends
  WHERE date BETWEEN DATE '2024-01-14' AND DATE '2024-01-15' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 40""",
    ),
)
def top_trends(spark, sf):
    return reports.top_trends(trend_rows(spark, sf), dt.date(2024, 1, 15), n=40)


@query("A17_bucket_stats", with_(TAGS, select="SELECT web_id, uuid, date, hour, count(*) AS num_usertag FROM tags GROUP BY ALL"))
def bucket_stats(spark, sf):
    return usertags.bucket_stats(tags(spark, sf))


@query(
    "A18_heavy_users",
    with_(TAGS, select="SELECT web_id, uuid, count(*) AS n FROM tags GROUP BY 1, 2 HAVING count(*) > 70"),
)
def heavy_users(spark, sf):
    return usertags.heavy_users(usertags.bucket_stats(tags(spark, sf)), 70)


@query(
    "A19_distinct_tags",
    with_(DOCS, select="SELECT DISTINCT trim(k) AS keyword FROM (SELECT unnest(string_split(keywords, ',')) AS k FROM docs) WHERE trim(k) <> ''"),
)
def distinct_tags(spark, sf):
    return sets.distinct_tags(docs(spark, sf), F.split("keywords", ","))


@query(
    "A20_most_common",
    with_(
        TAGS,
        "freqs AS (SELECT web_id, uuid, usertag, count(*) AS freq FROM tags GROUP BY ALL)",
        select="""SELECT web_id, uuid, usertag, freq, CAST(rk AS INTEGER) AS rk FROM (SELECT *, row_number() OVER (PARTITION BY web_id, uuid
  ORDER BY freq DESC, usertag) AS rk FROM freqs) WHERE rk <= 10""",
    ),
)
def most_common(spark, sf):
    from clickloom.operators.ranking import top_k

    counts = sets.term_counts(tags(spark, sf), ["web_id", "uuid"], "usertag")
    return top_k(counts, ["web_id", "uuid"], [F.desc("freq"), F.asc("usertag")], 10, rank="rk")


TOKENS = r"""terms AS (SELECT doc_id AS id, term, count(*) AS freq FROM (
  SELECT doc_id, unnest(string_split_regex(lower(text), '[^\p{L}\p{N}]+')) AS term FROM documents)
  WHERE length(term) >= 2 GROUP BY ALL)"""


def doc_terms(spark, sf, totals=False):
    rows = texts_by_id(spark, sf).select("id", "text")
    count = keywords.count_with_totals if totals else keywords.explode_tokens
    # counted once: document frequencies, totals and ranks all start from the stored counts
    return materialise(count(rows, "id", tx.latin_tokens(F.col("text"))), "doc-terms")


@query(
    "A21_idf",
    with_(
        TOKENS,
        select="""SELECT term, round(log10(CAST((SELECT count(DISTINCT id) FROM terms) AS DOUBLE) / count(*)), 6) + 0.0 AS idf
  FROM terms GROUP BY term""",
    ),
)
def idf(spark, sf):
    return keywords.train_idf(doc_terms(spark, sf)).withColumn("idf", F.round("idf", 6) + 0.0)


@query(
    "A22_idf_vocab",
    with_(
        TOKENS,
        select="""SELECT term, round(log10(CAST((SELECT count(DISTINCT term) FROM terms) AS DOUBLE) / sum(freq)), 6) + 0.0 AS idf
  FROM terms GROUP BY term""",
    ),
)
def idf_vocab(spark, sf):
    # a vocabulary's frequencies need no counts per document
    words = texts(spark, sf).select(F.explode(tx.latin_tokens(F.col("text"))).alias("term")).where(F.char_length("term") >= 2)
    counts = materialise(words.groupBy("term").agg(F.count("*").alias("freq")), "word-counts")
    return keywords.train_idf(counts, denominator="vocab").withColumn("idf", F.round("idf", 6) + 0.0)


@query(
    "A23_histogram",
    """WITH r AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
c AS (SELECT CAST(least(floor((value - lo) / ((hi - lo) / 20)), 19) AS BIGINT) AS bin, count(*) AS count FROM events, r GROUP BY 1),
b AS (SELECT unnest(range(20)) AS bin)
SELECT b.bin, round(lo + (b.bin + 0.5) * (hi - lo) / 20, 6) AS center, COALESCE(c.count, 0) AS count,
  round(COALESCE(c.count, 0) / (SELECT CAST(count(*) AS DOUBLE) FROM events) / ((hi - lo) / 20), 8) AS density
FROM b LEFT JOIN c USING (bin), r""",
)
def histogram(spark, sf):
    rows = stats.histogram(table(spark, sf, "events"), "value", 20)
    return rows.withColumns({"center": F.round("center", 6), "density": F.round("density", 8)})


@query(
    "A24_histogram_width",
    """WITH r AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
n AS (SELECT lo, CAST(ceil((hi + 1 - lo) / 5.0) - 2 AS BIGINT) AS last FROM r),
c AS (SELECT CASE WHEN value = lo + (last + 1) * 5.0 THEN last ELSE CAST(floor((value - lo) / 5.0) AS BIGINT) END AS bin, count(*) AS count
  FROM events, n GROUP BY 1),
k AS (SELECT * FROM c, n WHERE bin BETWEEN 0 AND last),
b AS (SELECT unnest(range(0, last + 1)) AS bin, lo FROM n)
SELECT b.bin, round(b.lo + (b.bin + 0.5) * 5.0, 6) AS center, COALESCE(k.count, 0) AS count,
  round(COALESCE(k.count, 0) / (SELECT CAST(sum(count) AS DOUBLE) FROM k) / 5.0, 8) AS density FROM b LEFT JOIN k USING (bin)""",
)
def histogram_width(spark, sf):
    rows = stats.histogram_width(table(spark, sf, "events"), "value", 5.0)
    return rows.withColumns({"center": F.round("center", 6), "density": F.round("density", 8)})


@query(
    "A25_linear_fit",
    """SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
  round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem GROUP BY 1""",
)
def linear_fit(spark, sf):
    fit = stats.linear_fit(table(spark, sf, "lineitem"), F.col("l_quantity"), F.col("l_extendedprice"), ["l_returnflag"])
    return fit.withColumns({c: F.round(c, 4) for c in ("slope", "intercept")})


@query("A26_interest_means", with_(TREND_ROWS, select="SELECT keyword, round(avg(traffic), 6) AS avg_traffic FROM trends GROUP BY 1"))
def interest_means(spark, sf):
    return reports.interest_means(trend_rows(spark, sf), value="traffic").withColumn("avg_traffic", F.round("avg_traffic", 6))


@query(
    "A28_mean_plus_std",
    "SELECT event_type, round(avg(value) + stddev_pop(value), 6) AS upper FROM events GROUP BY 1",
)
def mean_plus_std(spark, sf):
    return stats.mean_plus_std(table(spark, sf, "events"), ["event_type"], "value").withColumn("upper", F.round("upper", 6))


@query(
    "A29_short_share",
    """SELECT doc_id, round(CAST(len(list_filter(w, lambda x: length(x) <= 4)) AS DOUBLE) / len(w), 6) AS share FROM (
  SELECT doc_id, list_filter(string_split(replace(text, '，', ','), ','), lambda x: x <> '') AS w FROM documents) WHERE len(w) > 0""",
)
def short_share(spark, sf):
    rows = texts(spark, sf).select("doc_id", tx.short_share(tx.short_pieces(F.col("text"))).alias("share"))
    return rows.where(F.col("share").isNotNull()).withColumn("share", F.round("share", 6))


@query(
    "A30_label_batch",
    with_(
        TOKENS,
        """kw AS (SELECT d.source AS web_id, t.id, t.term FROM terms t JOIN documents d ON d.doc_id = t.id),
firsts AS (SELECT web_id, term, min(id) AS id FROM kw GROUP BY 1, 2),
fresh AS (SELECT k.web_id, k.id, COALESCE(f.n, 0) AS n FROM (SELECT DISTINCT web_id, id FROM kw) k
  LEFT JOIN (SELECT web_id, id, count(*) AS n FROM firsts GROUP BY 1, 2) f ON f.web_id = k.web_id AND f.id = k.id),
run AS (SELECT *, CAST(sum(n) OVER (PARTITION BY web_id ORDER BY id) AS BIGINT) AS distinct_keywords FROM fresh)""",
        select="SELECT web_id, id, distinct_keywords FROM run WHERE distinct_keywords - n <= 1000",
    ),
)
def label_batch(spark, sf):
    # rows of one id share their words and sources; both are at hand where the document is
    words = F.array_distinct(F.filter(tx.latin_tokens(F.col("text")), lambda w: F.char_length(w) >= 2))
    sources = F.collect_set(F.struct("web_id")).over(Window.partitionBy("id"))
    rows = texts_by_id(spark, sf).select("id", words.alias("words"), sources.alias("_sources")).where(F.size("words") > 0)
    rows = rows.select("id", "words", F.explode("_sources").alias("_s")).select("_s.web_id", "id", "words")
    terms = rows.select("web_id", "id", F.explode("words").alias("term"))
    return reports.label_batch(terms, "web_id", "id", "term", 1000, slice_size=100, articles=rows.select("web_id", "id"))


CONSOLE_SETS = (("l_returnflag", "l_linestatus"), ("l_returnflag", "month"), ("month",), ("l_linestatus", "month"))


@query(
    "A31_console_report",
    """SELECT l_returnflag, l_linestatus, month, CAST(grouping(l_returnflag, l_linestatus, month) AS BIGINT) AS grouping_set,
  CAST(sum(l_linenumber) AS BIGINT) AS clicks, CAST(sum(qty) AS BIGINT) AS impressions,
  round(CAST(sum(l_linenumber * qty) AS DOUBLE) / CAST(sum(qty) AS DOUBLE), 6) AS position
FROM (SELECT *, CAST(l_quantity AS BIGINT) AS qty, strftime(l_shipdate, '%Y-%m') AS month FROM lineitem)
GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag, month), (month), (l_linestatus, month))""",
)
def console_report(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_returnflag", "l_linestatus",
        F.date_format("l_shipdate", "yyyy-MM").alias("month"),
        F.col("l_linenumber").alias("clicks"),
        F.col("l_quantity").cast("long").alias("impressions"),
        F.col("l_linenumber").cast("double").alias("position"),
    )
    report = reports.console_report(rows, CONSOLE_SETS)
    return report.withColumn("position", F.round("position", 6))


@query(
    "UD1_split_article_ids",
    with_(
        *FACTS_BASE,
        select=f"SELECT web_id, date, article_id, source_domain, {MEASURE_SQL} FROM facts GROUP BY 1, 2, 3, 4",
    ),
)
def split_article_ids(spark, sf):
    """Article ids that carry an ``&`` suffix per hour meet again when they are cut."""
    suffixed = F.concat(F.col("article_id"), F.lit("&h="), F.col("hour").cast("string"))
    return rollups.day_pageviews(facts(spark, sf).withColumn("article_id", suffixed), split_ids=True)
