"""E*: end-to-end jobs over the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from clickloom.catalog import functions as fx
from clickloom.catalog.aggregates import SOURCES_SQL, TOKENS, TREND_ROWS, doc_terms, dated, trend_rows
from clickloom.catalog.forecasting import outlook_columns, outlook_sql
from clickloom.catalog.registry import query, with_
from clickloom.catalog.tables import (
    AD_DAYS, ARTICLES, BROWSE, DOCS, FACTS, KEY_SQL, ROWS_BASE, SESSIONS, ad_days, article_rows, articles, browse,
    docs, event_key, facts, table, word_vectors,
)
from clickloom.catalog.texts import IDF, SCORED, metric_rows
from clickloom.functions import text as tx
from clickloom.functions.dates import epoch_seconds
from clickloom.operators import keywords
from clickloom.plans import matching, pageviews, reporting, usertags
from clickloom.session import materialise, scratch_path
from clickloom.sinks import merge

DAY = dt.date(2024, 1, 10)


# --- E1 --------------------------------------------------------------------------------------------
def tracker(spark, sf):
    """Visits as raw tracker events: every third one carries a landing, the others a load record."""
    events = table(spark, sf, "events").select("event_id", "ts", "event_type", "value", F.col("user_id").alias("who"))
    rows = fx.visits(spark, sf).join(events, "event_id")
    landing = F.col("event_type") == "view"
    load = F.struct(F.col("cur").alias("un"), F.col("ref").alias("ul"))
    return rows.select(
        "event_id",
        F.concat(F.lit("shop"), (F.col("user_id") % 9).cast("string")).alias("web_id"),
        F.col("user_id").cast("string").alias("uuid"),
        F.when(landing, "landing").when(F.col("event_type") == "error", "noise").otherwise("tracking").alias("behavior_type"),
        F.when(landing, "view").otherwise("load").alias("event_type"),
        F.when(~landing, epoch_seconds(F.col("ts")) * 1000).alias("timestamp"),
        F.when(landing, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("datetime"),
        F.when(landing, F.col("cur")).otherwise("https://stale/").alias("current_url"),
        F.when(landing, F.col("ref")).otherwise("https://stale/").alias("referrer_url"),
        F.when(~landing, load).alias("load"),
        F.when(F.col("app") == "line", 10).alias("browser_type"),
        F.struct(F.when(F.col("value") >= 20, F.floor("value").cast("long")).alias("t_p")).alias("record_user"),
    )


E1_BROWSE = f"""browse AS (SELECT event_id, date_trunc('second', e.ts) AS ts, 'shop' || (s.user_id % 9) AS web_id, CAST(s.user_id AS VARCHAR) AS uuid,
  'shop' || (s.user_id % 9) || '_' || regexp_extract(cur, '/p/([0-9]{{1,2}})', 1) AS article_id,
  CASE WHEN s.user_id % 9 >= 7 THEN 'other'
    WHEN regexp_matches(lower('https://www.t.' || (s.user_id % 9) || '.co/x'), '\\W' || replace(lower(source), '.', '\\.')) OR contains('app.shops.example', lower(source)) THEN 'shop' || (s.user_id % 9)
    WHEN lower(source) IN ({fx.KNOWN_SQL}) THEN lower(source) WHEN contains(lower(source), 'blogs') THEN 'shop' || (s.user_id % 9) ELSE 'other' END AS source_domain,
  CASE WHEN value >= 20 THEN CAST(floor(value) AS BIGINT) ELSE 0 END AS time_on_page
  FROM sourced s JOIN events e USING (event_id) WHERE e.event_type <> 'error')"""


@query(
    "E1_pageview_hours",
    with_(fx.VISITS_SQL, fx.SOURCE_SQL, E1_BROWSE, SESSIONS, FACTS.replace("strftime(ts,", "strftime(ts + INTERVAL 8 HOUR,").replace("hour(ts)", "hour(ts + INTERVAL 8 HOUR)"),
          select="SELECT * FROM facts"),
)
def pageview_hours(spark, sf):
    shops = table(spark, sf, "customer").select((F.col("c_custkey") % 9).alias("n")).distinct()
    tenants = shops.select(F.concat(F.lit("shop"), F.col("n").cast("string")).alias("web_id"), "n")
    rules = tenants.select("web_id", F.lit("/p/([0-9]{1,2})").alias("pattern"), F.lit(1).alias("group"))
    address = F.when(F.col("n") < 7, F.concat(F.lit("https://www.t."), F.col("n").cast("string"), F.lit(".co/x")))
    domains = tenants.select("web_id", address.alias("domain"), address.alias("subdomain"))
    return pageviews.pageview_hours(tracker(spark, sf), tenants, rules, domains, **fx.OWN_HOSTS)


# --- E2 --------------------------------------------------------------------------------------------
@query(
    "E2_hot_report",
    with_(
        *ROWS_BASE,
        """k AS (SELECT web_id, date, keyword, sum(pageviews) AS pv FROM krows GROUP BY 1, 2, 3),
a AS (SELECT web_id, date, article_id, sum(pageviews) AS pv FROM arows GROUP BY 1, 2, 3),
l AS (SELECT web_id, date, keyword, pv AS lv FROM (SELECT web_id, date, keyword, sum(pageviews) AS pv FROM krows WHERE source = 'google' GROUP BY 1, 2, 3)),
la AS (SELECT web_id, date, article_id, sum(pageviews) AS lv FROM arows WHERE source = 'google' GROUP BY 1, 2, 3)""",
        select=f"""SELECT 'keyword' AS name, count(*) AS n, CAST(sum(pv) AS BIGINT) AS pageviews, round(sum(COALESCE(CAST(pv - lv AS DOUBLE) / lv, 0.0)), 4) AS trend FROM k LEFT JOIN l USING (web_id, date, keyword)
UNION ALL SELECT 'article', count(*), CAST(sum(pv) AS BIGINT), round(sum(COALESCE(CAST(pv - lv AS DOUBLE) / pv * 100, 0.0)), 4) FROM a LEFT JOIN la USING (web_id, date, article_id)
UNION ALL SELECT 'keyword_by_source', count(*), CAST(sum(pv) AS BIGINT), 0.0 FROM (SELECT sum(pageviews) AS pv FROM krows WHERE source IN {SOURCES_SQL} GROUP BY web_id, date, source, keyword)
UNION ALL SELECT 'article_by_source', count(*), CAST(sum(pv) AS BIGINT), 0.0 FROM (SELECT sum(pageviews) AS pv FROM arows WHERE source IN {SOURCES_SQL} GROUP BY web_id, date, source, article_id)
UNION ALL SELECT 'keyword_source_domain', count(*), CAST(sum(pv) AS BIGINT), 0.0 FROM k
UNION ALL SELECT 'article_source_domain', count(*), CAST(sum(pv) AS BIGINT), 0.0 FROM a
UNION ALL SELECT 'keyword_article', count(*), 0, 0.0 FROM (SELECT DISTINCT web_id, date, keyword, article_id, is_cut FROM krows)""",
    ),
)
def hot_report(spark, sf):
    """Size and totals of every table of the report; the tables themselves follow."""
    tables = report_tables(spark, sf)
    zero = F.lit(0).cast("long")
    sizes = [
        df.agg(
            F.lit(name).alias("name"),
            F.count("*").alias("n"),
            (F.sum("pageviews") if "pageviews" in df.columns else zero).alias("pageviews"),
            (F.round(F.sum("trend"), 4) if "trend" in df.columns else F.lit(0.0)).alias("trend"),
        )
        for name, df in tables.items()
    ]
    out = sizes[0]
    for more in sizes[1:]:
        out = out.unionByName(more)
    return out


def report_tables(spark, sf):
    """The report's tables; the google share stands in for the last snapshot."""
    named = articles(spark, sf).withColumn("keyword_list", F.split("keywords", ",")).drop("keywords")
    stored = materialise(facts(spark, sf), "hourly-facts")
    google = stored.where(F.col("source_domain") == "google search").groupBy("web_id", "date", "article_id")
    last = google.agg(F.sum("pageviews").alias("pageviews")).join(named, ["web_id", "article_id"])
    last_a = last.select("web_id", "date", "article_id", "pageviews")
    spread = last.withColumn("keyword", F.explode("keyword_list"))
    last_k = spread.groupBy("web_id", "date", "keyword").agg(F.sum("pageviews").alias("pageviews"))
    return pageviews.hot_report(stored, named, last_k, last_a)


LAST_SQL = """lk AS (SELECT web_id, date, keyword, CAST(sum(pageviews) AS BIGINT) AS lv FROM krows WHERE source = 'google' GROUP BY 1, 2, 3),
la AS (SELECT web_id, date, article_id, CAST(sum(pageviews) AS BIGINT) AS lv FROM arows WHERE source = 'google' GROUP BY 1, 2, 3)"""


def _measure_sql(prefix):
    return ", ".join(f"CAST(sum({prefix}{m}) AS BIGINT) AS {m}" for m in ("pageviews", "landings", "exits", "bounce", "time_on_page"))


BY_SIDE = """CAST(sum(CASE WHEN NOT internal THEN pageviews ELSE 0 END) AS BIGINT) AS external_source_count,
  CAST(sum(CASE WHEN internal THEN pageviews ELSE 0 END) AS BIGINT) AS internal_source_count"""


@query(
    "E2_keyword_table",
    with_(
        *ROWS_BASE, LAST_SQL,
        f"""k AS (SELECT web_id, date, keyword, {_measure_sql('')}, {BY_SIDE}, arg_min(is_cut, (-pageviews, article_id, source_domain)) AS is_cut
  FROM krows GROUP BY 1, 2, 3)""",
        select="""SELECT k.*, COALESCE(lv, 0) AS pageviews_last, round(COALESCE(CAST(pageviews - lv AS DOUBLE) / lv, 0.0), 6) AS trend
  FROM k LEFT JOIN lk USING (web_id, date, keyword)""",
    ),
)
def report_keywords(spark, sf):
    return report_tables(spark, sf)["keyword"].withColumn("trend", F.round("trend", 6))


@query(
    "E2_article_table",
    with_(
        *ROWS_BASE, LAST_SQL,
        f"a AS (SELECT web_id, date, article_id, {_measure_sql('')}, {BY_SIDE}, any_value(title) AS title FROM arows GROUP BY 1, 2, 3)",
        select="""SELECT a.*, COALESCE(lv, 0) AS pageviews_last, round(COALESCE(CAST(pageviews - lv AS DOUBLE) / pageviews * 100, 0.0), 6) AS trend
  FROM a LEFT JOIN la USING (web_id, date, article_id)""",
    ),
)
def report_articles(spark, sf):
    return report_tables(spark, sf)["article"].withColumn("trend", F.round("trend", 6))


@query(
    "E2_keyword_by_source",
    with_(*ROWS_BASE, select=f"SELECT web_id, date, source, keyword, {_measure_sql('')} FROM krows WHERE source IN {SOURCES_SQL} GROUP BY 1, 2, 3, 4"),
)
def report_keyword_sources(spark, sf):
    return report_tables(spark, sf)["keyword_by_source"]


@query(
    "E2_article_by_source",
    with_(*ROWS_BASE, select=f"SELECT web_id, date, source, article_id, {_measure_sql('')} FROM arows WHERE source IN {SOURCES_SQL} GROUP BY 1, 2, 3, 4"),
)
def report_article_sources(spark, sf):
    return report_tables(spark, sf)["article_by_source"]


def _domains_sql(rows, key):
    named = ("google", "facebook", "yahoo", "xuite", "youtube", "line", "feed_related", "dcard", "ptt", "edm", "own")
    listed = ", ".join(f"'{n}'" for n in named)
    sums = ", ".join(f"CAST(sum(CASE WHEN b = '{n}' THEN pageviews ELSE 0 END) AS BIGINT) AS {n}" for n in ("internal", *named, "other"))
    return f"""SELECT web_id, date, {key}, {sums}, CAST(sum(pageviews) AS BIGINT) AS pageviews FROM (SELECT *,
  CASE WHEN internal THEN 'internal' WHEN source IN ({listed}) THEN source ELSE 'other' END AS b FROM {rows}) GROUP BY 1, 2, 3"""


@query("E2_keyword_domains", with_(*ROWS_BASE, select=_domains_sql("krows", "keyword")))
def report_keyword_domains(spark, sf):
    return report_tables(spark, sf)["keyword_source_domain"]


@query("E2_article_domains", with_(*ROWS_BASE, select=_domains_sql("arows", "article_id")))
def report_article_domains(spark, sf):
    return report_tables(spark, sf)["article_source_domain"]


@query("E2_keyword_bridge", with_(*ROWS_BASE, select="SELECT DISTINCT web_id, date, keyword, article_id, is_cut FROM krows"))
def report_keyword_bridge(spark, sf):
    return report_tables(spark, sf)["keyword_article"]


@query(
    "E2_keyword_hours",
    with_(
        *ROWS_BASE[:4],
        """hours AS (SELECT f.web_id, date, hour, pageviews, unnest(string_split(a.keywords, ',')) AS keyword FROM facts f JOIN articles a USING (web_id, article_id)),
cum AS (SELECT *, CAST(sum(n) OVER (PARTITION BY web_id, keyword, date ORDER BY hour) AS BIGINT) AS pageviews
  FROM (SELECT web_id, keyword, date, hour, sum(pageviews) AS n FROM hours GROUP BY ALL)),
j AS (SELECT c.*, p.pageviews AS before FROM cum c LEFT JOIN cum p ON p.web_id = c.web_id AND p.keyword = c.keyword
  AND p.date = c.date AND p.hour = c.hour - 1)""",
        select="""SELECT web_id, keyword, date, hour, pageviews, CASE WHEN hour = 0 THEN pageviews
  WHEN COALESCE(before, 0) = 0 AND COALESCE(pageviews - before, 0) = 0 THEN pageviews ELSE COALESCE(pageviews - before, 0) END AS pageviews_hour,
  CAST(isodow(strptime(CAST(date AS VARCHAR), '%Y%m%d')) AS INTEGER) AS weekday FROM j""",
    ),
)
def keyword_hours(spark, sf):
    """Hour deltas per keyword, from the hourly fact with each article's keywords."""
    named = articles(spark, sf).select("web_id", "article_id", F.explode(F.split("keywords", ",")).alias("keyword"))
    hours = facts(spark, sf).join(named, ["web_id", "article_id"])
    rows = pageviews.hourly_increase(hours, "keyword")
    return rows.select("web_id", "keyword", "date", "hour", "pageviews", "pageviews_hour", F.col("weekday").cast("int").alias("weekday"))


@query(
    "E2_hourly_increase",
    with_(
        *ROWS_BASE[:3],
        """cum AS (SELECT *, CAST(sum(n) OVER (PARTITION BY web_id, article_id, date ORDER BY hour) AS BIGINT) AS pageviews
  FROM (SELECT web_id, article_id, date, hour, sum(pageviews) AS n FROM facts GROUP BY ALL)),
j AS (SELECT c.*, p.pageviews AS before FROM cum c LEFT JOIN cum p ON p.web_id = c.web_id AND p.article_id = c.article_id
  AND p.date = c.date AND p.hour = c.hour - 1)""",
        select="""SELECT web_id, CAST(isodow(strptime(CAST(date AS VARCHAR), '%Y%m%d')) AS INTEGER) AS weekday, hour,
  CAST(sum(CASE WHEN hour = 0 OR (COALESCE(before, 0) = 0 AND before IS NULL) THEN pageviews ELSE pageviews - before END) AS BIGINT) AS pageviews_hour FROM j GROUP BY 1, 2, 3""",
    ),
)
def hourly_increase(spark, sf):
    rows = pageviews.hourly_increase(facts(spark, sf))
    return rows.groupBy("web_id", "weekday", "hour").agg(F.sum("pageviews_hour").alias("pageviews_hour"))


# --- E3-E7 -----------------------------------------------------------------------------------------
def keyword_articles(spark, sf):
    return articles(spark, sf).select("web_id", "article_id", F.split("keywords", ",").alias("keyword_list"), "is_cut")


def tokens(spark, sf):
    """Orders as registrations of their customer."""
    return table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("uuid"), F.col("o_orderkey").cast("string").alias("token"),
        F.col("o_orderstatus").alias("os_platform"), (F.col("o_orderpriority") == "1-URGENT").alias("is_fcm"),
    )


TOKENS_SQL = """tok AS (SELECT CAST(o_custkey AS VARCHAR) AS uuid, CAST(o_orderkey AS VARCHAR) AS token,
  o_orderstatus || CAST(CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS VARCHAR) AS code FROM orders),
one AS (SELECT uuid, min(token) AS token, arg_min(code, token) AS code FROM tok GROUP BY 1)"""


@query(
    "E3_subscriber_tags",
    with_(
        BROWSE, ARTICLES, TOKENS_SQL,
        """pairs AS (SELECT DISTINCT web_id, uuid, article_id FROM browse WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'),
k AS (SELECT DISTINCT p.web_id, p.uuid, p.article_id, a.is_cut, unnest(string_split(a.keywords, ',')) AS usertag FROM pairs p JOIN articles a USING (web_id, article_id))""",
        select="SELECT k.web_id, k.uuid, k.article_id, k.is_cut, k.usertag, token, code, '2024-01-14' AS expired_date FROM k JOIN one USING (uuid)",
    ),
)
def subscriber_tags(spark, sf):
    rows = usertags.subscriber_tags(browse(spark, sf), keyword_articles(spark, sf), tokens(spark, sf), DAY)
    return rows.withColumn("expired_date", F.col("expired_date").cast("string"))


@query(
    "E4_shop_tags",
    with_(
        TOKENS_SQL,
        f"""seen AS (SELECT DISTINCT 'w' || ({KEY_SQL} % 5) AS web_id, CAST(user_id AS VARCHAR) AS uuid, CAST({KEY_SQL} AS VARCHAR) AS article_id FROM events
  WHERE event_type IN ('view', 'purchase')),
k AS (SELECT DISTINCT s.*, unnest(string_split(p_name, ' ')) AS usertag FROM seen s JOIN part ON CAST(p_partkey AS VARCHAR) = article_id)""",
        select="SELECT k.*, 1 AS is_cut, token, code FROM k JOIN one USING (uuid)",
    ),
)
def shop_tags(spark, sf):
    shown = table(spark, sf, "events").where(F.col("event_type").isin("view", "purchase"))
    tenant = F.concat(F.lit("w"), (event_key() % 5).cast("string")).alias("web_id")
    log = shown.select(tenant, F.col("user_id").cast("string").alias("uuid"), event_key().cast("string").alias("product_id"))
    items = table(spark, sf, "part").select(
        F.concat(F.lit("w"), (F.col("p_partkey") % 5).cast("string")).alias("web_id"),
        F.col("p_partkey").cast("string").alias("product_id"), F.split("p_name", " ").alias("keyword_list"),
    )
    return usertags.shop_tags(log, items, tokens(spark, sf), DAY).drop("expired_date")


@query(
    "E5_member_tags",
    """SELECT c_mktsegment AS web_id, CASE WHEN c_nationkey = 1 THEN 'new customer' ELSE 'old customer' END AS usertag, count(*) AS term_freq,
  count(DISTINCT c_name) AS token_count, count(DISTINCT c_custkey) AS uuid_count, 1 AS enable, '2024-01-17' AS expired_date
FROM customer WHERE c_nationkey <> 5 GROUP BY 1, 2""",
)
def member_tags(spark, sf):
    member = F.when(F.col("c_nationkey") == 5, "_").otherwise(F.col("c_nationkey").cast("string"))
    members = table(spark, sf, "customer").select(
        F.col("c_mktsegment").alias("web_id"), F.col("c_name").alias("token"), F.col("c_custkey").cast("string").alias("uuid"),
        F.lit("web").alias("os_platform"), F.lit(True).alias("is_fcm"), member.alias("member"),
    )
    counts = usertags.member_tags(members, DAY)[1]
    return counts.withColumn("expired_date", F.col("expired_date").cast("string"))


@query(
    "E6_bucket_tags",
    with_(
        BROWSE, ARTICLES,
        """st AS (SELECT DISTINCT web_id, uuid, article_id, CAST(ts AS DATE) AS date, CAST(hour(ts) // 2 * 2 AS INTEGER) AS hour FROM browse),
k AS (SELECT s.*, unnest(string_split(a.keywords, ',')) AS usertag FROM st s JOIN articles a USING (web_id, article_id)),
tags AS (SELECT web_id, uuid, usertag, date, hour, min(article_id) AS article_id FROM k GROUP BY 1, 2, 3, 4, 5),
stats AS (SELECT web_id, uuid, date, hour, count(*) AS num_usertag FROM tags GROUP BY 1, 2, 3, 4),
kept AS (SELECT * FROM (SELECT *, COALESCE(sum(num_usertag) OVER (PARTITION BY web_id, uuid ORDER BY date DESC, hour DESC
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM stats) WHERE before < 10)""",
        select="""SELECT t.web_id, t.uuid, t.usertag, strftime(t.date, '%Y-%m-%d') AS date, t.hour, t.article_id FROM tags t
  JOIN kept k ON k.web_id = t.web_id AND k.uuid = t.uuid AND k.date = t.date AND k.hour = t.hour""",
    ),
)
def bucket_tags(spark, sf):
    rows = usertags.bucket_tags(browse(spark, sf), keyword_articles(spark, sf), limit=10)[0]
    return rows.select("web_id", "uuid", "usertag", F.col("date").cast("string").alias("date"), "hour", "article_id")


@query(
    "E7_uuid_tags",
    with_(
        BROWSE, ARTICLES,
        select="""SELECT DISTINCT b.web_id, b.uuid, b.article_id, a.is_cut, unnest(string_split(a.keywords, ',')) AS usertag
  FROM browse b JOIN articles a USING (web_id, article_id) WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'""",
    ),
)
def uuid_tags(spark, sf):
    return usertags.uuid_tags(browse(spark, sf), keyword_articles(spark, sf), DAY).drop("expired_date")


# --- E8-E10 ----------------------------------------------------------------------------------------
def supplier_keywords(spark, sf):
    """Line items as keyword facts: suppliers are the words, return flags the tenants."""
    return table(spark, sf, "lineitem").groupBy(
        F.col("l_returnflag").alias("web_id"), F.concat(F.lit("word"), F.col("l_suppkey").cast("string")).alias("keyword")
    ).agg(F.sum(F.col("l_quantity").cast("long")).alias("pageviews"))


@query(
    "E8_related_keywords",
    """WITH f AS (SELECT l_returnflag AS web_id, 'word' || l_suppkey AS word, l_suppkey AS vec_id, sum(CAST(l_quantity AS BIGINT)) AS pv FROM lineitem GROUP BY 1, 2, 3),
hot AS (SELECT * FROM f WHERE pv > 10),
w AS (SELECT web_id, word, CAST(embedding AS DOUBLE[]) AS v FROM hot JOIN embeddings USING (vec_id)),
s AS (SELECT a.web_id, a.word AS keyword, b.word AS keyword_related,
  2 * list_cosine_similarity(a.v, b.v) - damerau_levenshtein(a.word, b.word) / CAST(length(a.word) AS DOUBLE) AS score FROM w a JOIN w b USING (web_id))
SELECT web_id, keyword, keyword_related, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY web_id, keyword
  ORDER BY round(score, 9) DESC, keyword_related) AS rk FROM s WHERE score > 0.09) WHERE rk <= 10""",
)
def related_keywords(spark, sf):
    rows = matching.related_keywords(supplier_keywords(spark, sf), word_vectors(spark, sf))
    return rows.withColumn("score", F.round("score", 6))


@query(
    "E9_trend_products",
    f"""WITH {TREND_ROWS.replace("'kw'", "'word'")}, hot AS (SELECT keyword FROM (SELECT keyword, sum(traffic) AS t FROM trends
  WHERE date BETWEEN DATE '2024-01-09' AND DATE '2024-01-10' GROUP BY 1)),
vecs AS (SELECT 'word' || vec_id AS word, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
items AS (SELECT l_returnflag AS web_id, 'word' || l_suppkey AS word, min(l_partkey) AS product_id FROM lineitem GROUP BY 1, 2),
p AS (SELECT h.keyword AS keyword_trend, i.word AS keyword_item, list_cosine_similarity(hv.v, iv.v) AS cs,
  damerau_levenshtein(h.keyword, i.word) / CAST(greatest(length(h.keyword), length(i.word)) AS DOUBLE) AS far
  FROM hot h JOIN vecs hv ON hv.word = h.keyword, (SELECT DISTINCT word FROM items) i JOIN vecs iv ON iv.word = i.word)
SELECT web_id, keyword_trend, keyword_item, product_id, round((cs - far + 0.5) / 1.5, 6) AS score, '2024-01-10' AS date
FROM p JOIN items ON items.word = keyword_item WHERE (cs - far + 0.5) / 1.5 > 0.1 AND cs > 0.25 AND keyword_trend <> keyword_item""",
)
def trend_products(spark, sf):
    items = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("web_id"), F.col("l_partkey").alias("product_id"),
        F.concat(F.lit("word"), F.col("l_suppkey").cast("string")).alias("keyword"),
    )
    trends = trend_rows(spark, sf).withColumn("keyword", F.concat(F.lit("word"), F.substring("keyword", 3, 9)))
    rows = matching.trend_products(trends, items, word_vectors(spark, sf), DAY, min_cosine=0.25)
    return rows.select(
        "web_id", "keyword_trend", "keyword_item", "product_id", F.round("score", 6).alias("score"), F.col("date").cast("string").alias("date")
    )


@query(
    "E10_ad_matches",
    """WITH art AS (SELECT 'a' || c_custkey AS id, unnest(['word' || (c_custkey % 600), 'word' || (c_custkey * 7 % 600), c_mktsegment[1:4]]) AS word FROM customer),
live AS (SELECT 'ad' || s_suppkey AS id, s_suppkey FROM supplier WHERE s_acctbal > 0 AND 'ad' || s_suppkey NOT IN (SELECT 'ad' || n_nationkey FROM nation)),
ad AS (SELECT id, unnest(['word' || (s_suppkey * 3 % 700), 'word' || s_suppkey]) AS word FROM live),
vecs AS (SELECT 'word' || vec_id AS word, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
av AS (SELECT art.id AS article_id, art.word, v FROM art LEFT JOIN vecs USING (word)), dv AS (SELECT ad.id AS ad_id, ad.word, v FROM ad LEFT JOIN vecs USING (word)),
s AS (SELECT article_id, ad_id, dv.word AS dw, COALESCE(list_cosine_similarity(av.v, dv.v), -1.0) AS c FROM av, dv),
u AS (SELECT article_id, ad_id, dw, avg(c) + stddev_pop(c) AS u FROM s GROUP BY 1, 2, 3),
sc AS (SELECT article_id, ad_id, avg(u) + stddev_pop(u) AS score FROM u GROUP BY 1, 2),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY round(score, 9) DESC, ad_id) AS rk FROM sc) WHERE rk = 1)
SELECT article_id, ad_id, round(score, 5) AS score FROM b""",
)
def ad_matches(spark, sf):
    """Customers as short article texts, suppliers as ads; ads named like a nation key are rejected."""

    def word(c):
        return F.concat(F.lit("word"), c.cast("string"))

    key, supp = F.col("c_custkey"), F.col("s_suppkey")
    text = F.concat_ws(",", word(key % 600), word(key * 7 % 600), F.substring("c_mktsegment", 1, 4))
    arts = table(spark, sf, "customer").select(F.concat(F.lit("a"), key.cast("string")).alias("id"), text.alias("text"))
    active = F.when(F.col("s_acctbal") > 0, F.lit(DAY)).otherwise(F.lit(DAY - dt.timedelta(days=9)))
    ads = table(spark, sf, "supplier").select(
        F.concat(F.lit("ad"), supp.cast("string")).alias("id"),
        F.concat_ws(",", word(supp * 3 % 700), word(supp)).alias("text"),
        F.lit(DAY - dt.timedelta(days=20)).alias("start_time"), active.alias("end_time"),
    )
    rejected = table(spark, sf, "nation").select(F.concat(F.lit("ad"), F.col("n_nationkey").cast("string")).alias("id"))

    def lists(rows):
        return rows.select("id", tx.short_pieces(F.col("text")).alias("keyword_list"))

    rows = matching.ad_matches(arts, ads, rejected, word_vectors(spark, sf), lists(arts), lists(ads), DAY, F.col("text"))
    return rows.select("article_id", "ad_id", F.round("score", 5).alias("score"))


# --- E11-E17 ---------------------------------------------------------------------------------------
TODAY = dt.date(2024, 1, 31)


@query(
    "E11_article_metrics",
    with_(
        *ROWS_BASE,
        """wins(types, days) AS (VALUES ('yesterday', 1), ('week', 7), ('month', 30)),
win AS (SELECT types, a.* FROM (SELECT *, strptime(CAST(date AS VARCHAR), '%Y%m%d')::DATE AS d FROM arows) a
  JOIN wins ON d >= DATE '2024-01-31' - CAST(days AS INTEGER) AND d <= DATE '2024-01-31')""",
        select="""SELECT types, web_id, CAST(sum(pageviews) AS BIGINT) AS pageviews, count(DISTINCT article_id) AS rated, 1.0 AS share, 20240131 AS date
  FROM win GROUP BY 1, 2""",
    ),
)
def article_metrics(spark, sf):
    """Tenant totals next to the shares of the rated articles, which must sum to one."""
    rows = dated(article_rows(spark, sf))
    published = docs(spark, sf).select("web_id", "article_id", F.lit(20240101).alias("published_time"))
    rates, totals = reporting.article_metrics(rows, published, TODAY)
    every = rates.where(F.col("domain") == "all").groupBy("types", "web_id").agg(
        F.count("*").alias("rated"), F.round(F.sum("total_pageviews_rate"), 6).alias("share")
    )
    return totals.join(every, ["types", "web_id"]).select("types", "web_id", "pageviews", "rated", "share", "date")


@query(
    "E11_article_rates",
    with_(
        *ROWS_BASE,
        """wins(types, days) AS (VALUES ('yesterday', 1), ('week', 7), ('month', 30)),
win AS (SELECT types, a.* FROM (SELECT *, strptime(CAST(date AS VARCHAR), '%Y%m%d')::DATE AS d FROM arows) a
  JOIN wins ON d >= DATE '2024-01-31' - CAST(days AS INTEGER) AND d <= DATE '2024-01-31')""",
        f"""dom AS (SELECT *, 'all' AS domain FROM win UNION ALL SELECT *, source AS domain FROM win WHERE source IN {SOURCES_SQL}),
sums AS (SELECT types, web_id, domain, article_id, max(title) AS title, sum(pageviews) AS pv, sum(landings) AS la, sum(bounce) AS bo FROM dom GROUP BY 1, 2, 3, 4)""",
        select="""SELECT types, web_id, domain, article_id, title, round(CAST(pv AS DOUBLE) / sum(pv) OVER (PARTITION BY types, web_id, domain), 8) AS total_pageviews_rate,
  round(CAST(la AS DOUBLE) / pv, 8) AS total_landings_rate, round(CAST(bo AS DOUBLE) / pv, 8) AS total_bounce_rate, 20240131 AS published_time, 20240131 AS date FROM sums""",
    ),
)
def article_rate_table(spark, sf):
    published = docs(spark, sf).select("web_id", "article_id", F.lit(20240101).alias("published_time"))
    rates = reporting.article_metrics(dated(article_rows(spark, sf)), published, TODAY)[0]
    return rates.withColumns({n: F.round(n, 8) for n in ("total_pageviews_rate", "total_landings_rate", "total_bounce_rate")})


@query(
    "E11_article_ids",
    with_(
        *ROWS_BASE,
        """wins(types, days) AS (VALUES ('yesterday', 1), ('week', 7), ('month', 30)),
b AS (SELECT DISTINCT web_id, keyword, article_id, strptime(CAST(date AS VARCHAR), '%Y%m%d')::DATE AS d FROM krows),
c AS (SELECT types, web_id, keyword, article_id, count(*) AS days FROM b
  JOIN wins ON d >= DATE '2024-01-31' - CAST(wins.days AS INTEGER) AND d <= DATE '2024-01-31' GROUP BY 1, 2, 3, 4),
t AS (SELECT types, web_id, keyword, CAST(sum(days) AS BIGINT) AS article_count FROM c GROUP BY 1, 2, 3)""",
        select="SELECT c.*, article_count, 20240131 AS date FROM c JOIN t USING (types, web_id, keyword)",
    ),
)
def article_id_table(spark, sf):
    bridge = report_tables(spark, sf)["keyword_article"].select("web_id", "keyword", "article_id", "date")
    return reporting.article_ids(dated(bridge), TODAY)


@query(
    "E12_daily_ads",
    with_(
        AD_DAYS,
        "items AS (SELECT p_name AS title, min(CAST(p_partkey AS VARCHAR)) AS pid FROM part GROUP BY 1)",
        select="""SELECT web_id, title, pid AS product_id, CAST(sum(cents) AS BIGINT) AS cents FROM ad_days JOIN items USING (title)
  WHERE date = DATE '1998-03-05' AND cents > 0 AND url <> '_' GROUP BY 1, 2, 3""",
    ),
)
def daily_ads(spark, sf):
    items = table(spark, sf, "part").select(F.col("p_name").alias("title"), F.col("p_partkey").cast("string").alias("product_id"))
    return reporting.daily_ads(ad_days(spark, sf), items, dt.date(1998, 3, 5), "cents").select("web_id", "title", "product_id", "cents")


@query("E12_revenue_outlook", outlook_sql("cents // 100 > 0 AND url <> '_'", "TRUE"))
def revenue_outlook(spark, sf):
    items = table(spark, sf, "part").select(F.col("p_name").alias("title"), F.col("p_partkey").cast("string").alias("product_id"))
    ads = ad_days(spark, sf).withColumn("revenue", F.floor(F.col("cents") / 100))
    return outlook_columns(reporting.revenue_outlook(ads, items, dt.date(1998, 1, 1), dt.date(1998, 3, 1)))


@query(
    "E13_console_tables",
    """WITH items AS (SELECT lower(split_part(url, '?', 1)) AS key, min('p' || page_id) AS product_id FROM pages GROUP BY 1)
SELECT 'page' AS name, p.page_id AS clicks, COALESCE(i.product_id, '_') AS product_id FROM pages p LEFT JOIN items i ON i.key = lower(split_part(p.url, '?', 1))
UNION ALL SELECT 'device', o_orderkey, '_' FROM orders""",
)
def console_tables(spark, sf):
    def response(keys, clicks, df):
        row = F.struct(F.array(*keys).alias("keys"), F.col(clicks).alias("clicks"))
        return df.select(F.to_json(F.struct(F.array(row).alias("rows"))).alias("value"))

    pages = table(spark, sf, "pages")
    page_id = F.concat(F.lit("p"), F.col("page_id").cast("string"))
    items = pages.select("url", page_id.alias("product_id"), F.lit("t").alias("title"), F.lit("d").alias("description"))
    tables = reporting.console_tables(
        {
            "page": response(["url"], "page_id", pages),
            "device": response(["o_orderpriority", "o_orderstatus"], "o_orderkey", table(spark, sf, "orders")),
        },
        {"page": ["page"], "device": ["device", "status"]},
        items,
    )
    page = tables["page"].select(F.lit("page").alias("name"), F.col("clicks").cast("long").alias("clicks"), "product_id")
    device = tables["device"].select(F.lit("device").alias("name"), F.col("clicks").cast("long").alias("clicks"), F.lit("_").alias("product_id"))
    return page.unionByName(device)


@query(
    "E13_console_products",
    """WITH c AS (SELECT regexp_extract(url, 'example\\.([a-z]+)', 1) AS web_id, 'q' || (page_id % 50) AS query, page_id AS clicks,
  regexp_extract(lower(url), '/[a-z]{2}/([0-9]+)', 1) AS product_id FROM pages),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY web_id, product_id ORDER BY clicks DESC, query) AS rk FROM c
  WHERE clicks > 1 AND product_id <> '') WHERE rk = 1),
alike AS (SELECT CAST(l_partkey AS VARCHAR) AS product_id, CAST(min(l_suppkey) AS VARCHAR) AS sim1, CAST(max(l_suppkey) AS VARCHAR) AS sim2 FROM lineitem GROUP BY 1)
SELECT web_id, query, product_id, clicks, sim1, sim2, CAST(row_number() OVER (PARTITION BY web_id ORDER BY clicks DESC, product_id) AS INTEGER) AS rank
FROM one JOIN alike USING (product_id)""",
)
def console_products(spark, sf):
    """Pages as a console report of three publishers, suppliers of a part as its similar products."""
    console = table(spark, sf, "pages").select(
        F.regexp_extract("url", r"example\.([a-z]+)", 1).alias("web_id"), F.concat(F.lit("q"), (F.col("page_id") % 50).cast("string")).alias("query"),
        F.col("url").alias("page"), F.col("page_id").alias("clicks"),
    )
    publishers = console.select("web_id").distinct()
    rules = publishers.select("web_id", F.lit("/[a-z]{2}/([0-9]+)").alias("pattern"), F.lit(1).alias("group"))
    suppliers = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").cast("string").alias("product_id")).agg(
        F.min("l_suppkey").cast("string").alias("sim1"), F.max("l_suppkey").cast("string").alias("sim2")
    )
    web_ids = F.array(F.lit("com"), F.lit("net"), F.lit("org"))
    similar = suppliers.select(F.explode(web_ids).alias("web_id"), "product_id", "sim1", "sim2")
    rows = reporting.console_products(console, rules, similar, DAY)
    return rows.select("web_id", "query", "product_id", "clicks", "sim1", "sim2", F.col("rank").cast("int").alias("rank"))


@query(
    "E14_new_keywords",
    """SELECT keyword_ask FROM (SELECT DISTINCT p_name AS keyword_ask FROM part UNION SELECT 'kw ' || c_custkey FROM customer)
WHERE keyword_ask NOT IN (SELECT 'kw ' || o_custkey FROM orders WHERE o_orderstatus <> 'P') ORDER BY 1 LIMIT 300""",
)
def new_keywords(spark, sf):
    trends = table(spark, sf, "part").select(F.col("p_name").alias("keyword_ask"))
    console = table(spark, sf, "customer").select(F.concat(F.lit("kw "), F.col("c_custkey").cast("string")).alias("keyword_ask"))
    history = metric_rows(spark, sf).where(F.col("google_available") == 1)
    return reporting.new_keywords([trends, console], history, 300)


@query(
    "E14_refresh_metrics",
    """WITH h AS (SELECT p_name AS keyword_ask, 2024 AS year, 3 AS month, CAST(sum(p_size) AS BIGINT) AS monthly_traffic, CAST(min(p_partkey) AS DOUBLE) AS low_price FROM part GROUP BY 1),
n AS (SELECT p_name AS keyword_ask, 2024 AS year, CAST(m AS INTEGER) AS month, CAST(count(*) * m AS BIGINT) AS monthly_traffic FROM part, (SELECT unnest(range(1, 13)) AS m)
  WHERE p_size > 25 GROUP BY p_name, m)
SELECT COALESCE(h.keyword_ask, n.keyword_ask) AS keyword_ask, 2024 AS year, COALESCE(h.month, n.month) AS month,
  COALESCE(n.monthly_traffic, h.monthly_traffic) AS monthly_traffic, CASE WHEN h.keyword_ask IS NULL THEN 0.5 ELSE h.low_price END AS low_price
FROM h FULL JOIN n ON h.keyword_ask = n.keyword_ask AND h.month = n.month""",
)
def refresh_metrics(spark, sf):
    part = table(spark, sf, "part")
    asked = part.where(F.col("p_size") > 25).groupBy(F.col("p_name").alias("keyword_ask")).agg(F.count("*").alias("n"))
    history = part.groupBy(F.col("p_name").alias("keyword_ask")).agg(
        F.lit(2024).alias("year"), F.lit(3).alias("month"), F.sum("p_size").alias("monthly_traffic"),
        F.min("p_partkey").cast("double").alias("low_price"),
    )
    volumes = F.transform(
        F.sequence(F.lit(1), F.lit(12)),
        lambda m: F.struct(F.lit(2024).alias("year"), (m + 1).alias("month"), (F.col("n") * m).alias("monthly_searches")),
    )
    ideas = asked.select(
        tx.blank_free(F.col("keyword_ask")).alias("keyword_join"), F.col("keyword_ask").alias("keyword_google"),
        F.lit(0.5).alias("low_price"), volumes.alias("volumes"),
    )
    return reporting.refresh_metrics(history, asked, ideas, TODAY, first_time=False)


@query(
    "E15_load_trends",
    """SELECT p_name AS keyword, CAST(p_size AS BIGINT) * 10000 AS traffic, CASE WHEN p_size > 25 THEN '2024-01-02' ELSE '2024-01-03' END AS date, min(p_type) AS related_queries FROM part GROUP BY 1, 2, 3
UNION ALL SELECT n_name, 1, CASE WHEN n_regionkey > 2 THEN '2024-01-01' ELSE '2023-12-31' END, 'old' FROM nation""",
)
def load_trends(spark, sf):
    search = F.struct(
        F.struct(F.col("p_name").alias("query")).alias("title"),
        F.concat(F.col("p_size").cast("string"), F.lit("萬+")).alias("formattedTraffic"),
        F.array(F.struct(F.col("p_type").alias("query"))).alias("relatedQueries"),
    )
    body = F.struct(F.struct(F.array(F.struct(F.array(search).alias("trendingSearches"))).alias("trendingSearchesDays")).alias("default"))
    landed = table(spark, sf, "part").select(F.when(F.col("p_size") > 25, "2024-01-02").otherwise("2024-01-03").alias("date"), F.to_json(body).alias("value"))
    stored = table(spark, sf, "nation").select(
        F.col("n_name").alias("keyword"), F.lit(1).cast("long").alias("traffic"), F.when(F.col("n_regionkey") > 2, "2024-01-01").otherwise("2023-12-31").alias("date"), F.lit("old").alias("related_queries")
    )
    return reporting.load_trends(stored, landed)


@query(
    "E16_corpus_idf",
    with_(
        DOCS,
        r"""ed AS (SELECT DISTINCT id, trim(k) AS term FROM (SELECT id, unnest(string_split(keywords, ',')) AS k FROM docs WHERE keywords <> '_')),
cut AS (SELECT DISTINCT id, term FROM (SELECT id, unnest(string_split_regex(lower(content), '[^\p{L}\p{N}]+')) AS term FROM docs WHERE keywords = '_')
  WHERE length(term) >= 2 AND NOT regexp_full_match(term, '[0-9]{2}|[0-9.]*|[a-z]{1,4}|[A-Z]{2}')
  AND NOT regexp_full_match(term, '[0-9.]*(萬|萬元|點|元|億|億元|百萬|千萬|分|分鐘|樓|成|吋|天|號|日|月|年|輛|種|次|人|%|g|cc|ml|克糖|倍|個|招|kg|jpg|JPG|折|度|公尺|大|例)')),
every AS (SELECT * FROM ed UNION ALL SELECT * FROM cut)""",
        select="SELECT term, round(log10(CAST((SELECT count(DISTINCT id) FROM every) AS DOUBLE) / count(*)), 6) + 0.0 AS idf FROM every GROUP BY 1",
    ),
)
def corpus_idf(spark, sf):
    rows = docs(spark, sf)
    editorial, rest = rows.where(F.col("keywords") != "_"), rows.where(F.col("keywords") == "_")
    idf = reporting.corpus_idf(editorial, rest, tx.latin_tokens(F.col("content")))
    return idf.withColumn("idf", F.round("idf", 6) + 0.0)


@query(
    "E16_label_set",
    with_(
        TOKENS, IDF, SCORED,
        """top AS (SELECT d.source AS web_id, r.id, r.term FROM ranked r JOIN documents d ON d.doc_id = r.id WHERE rk <= 10),
firsts AS (SELECT web_id, term, min(id) AS id FROM top GROUP BY 1, 2),
fresh AS (SELECT web_id, id, count(*) AS n FROM firsts GROUP BY 1, 2),
every AS (SELECT t.web_id, t.id, COALESCE(n, 0) AS n FROM (SELECT DISTINCT web_id, id FROM top) t LEFT JOIN fresh f ON f.web_id = t.web_id AND f.id = t.id),
run AS (SELECT *, sum(n) OVER (PARTITION BY web_id ORDER BY id) - n AS before FROM every)""",
        select="SELECT DISTINCT t.web_id, t.term FROM top t JOIN run r ON r.web_id = t.web_id AND r.id = t.id WHERE before <= 200",
    ),
)
def label_set(spark, sf):
    terms = doc_terms(spark, sf, totals=True)
    ranked = keywords.tfidf_keywords(terms, keywords.train_idf(terms, rows=True), 10)
    return reporting.label_set(docs(spark, sf), ranked, n=200)


@query("E17_copy_table", "SELECT n_name AS web_id, n_regionkey FROM nation")
def copy_table(spark, sf):
    root = scratch_path(spark, "config")
    config = table(spark, sf, "nation").withColumnRenamed("n_name", "web_id")
    merge.write_table(reporting.copy_table(config, ["web_id", "n_regionkey"]), root)
    return spark.read.parquet(root)
