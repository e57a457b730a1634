"""W*: window and sequence operators."""

from __future__ import annotations



from pyspark.sql import functions as F

from clickloom.catalog.registry import query, with_
from clickloom.catalog.tables import (
    BROWSE, FACTS_BASE, KEY_SQL, ROWS_BASE, SESSIONS, TAGS, AD_DAYS, ad_days, browse, event_key, facts,
    keyword_rows, session_rows, table, tags,
)
from clickloom.operators import ranking, rollups, sessions, trends, usertags

SESSION_COLUMNS = (
    "event_id", "web_id", "uuid", "source_domain", "time_on_page", "landings", "exits", "bounce",
)


@query("W1_session_metrics", with_(BROWSE, SESSIONS, select=f"SELECT {', '.join(SESSION_COLUMNS)} FROM sess"))
def session_metrics(spark, sf):
    return session_rows(spark, sf).select(*SESSION_COLUMNS)


@query(
    "W1b_true_sessions",
    with_(
        BROWSE,
        select="""SELECT web_id, uuid, count(*) AS views, min(ts) AS first_view, max(ts) AS last_view FROM (
  SELECT *, sum(is_new) OVER (PARTITION BY web_id, uuid ORDER BY ts, event_id) AS sid FROM (
    SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY web_id, uuid ORDER BY ts, event_id)
              < 1800000000 THEN 0 ELSE 1 END AS is_new FROM browse)) GROUP BY web_id, uuid, sid""",
    ),
)
def true_sessions(spark, sf):
    return sessions.true_sessions(browse(spark, sf))


@query(
    "W2_sticky_source",
    with_(
        BROWSE, SESSIONS,
        select="SELECT web_id, source_domain, count(*) AS views, count(DISTINCT uuid) AS users FROM sess GROUP BY ALL",
    ),
)
def sticky_source(spark, sf):
    return (
        session_rows(spark, sf)
        .groupBy("web_id", "source_domain")
        .agg(F.count("*").alias("views"), F.countDistinct("uuid").alias("users"))
    )


STATS = """stats AS (SELECT web_id, uuid, date, CAST(hour // 2 * 2 AS INTEGER) AS hour, count(*) AS num_usertag
  FROM tags GROUP BY ALL),
kept AS (SELECT * FROM (SELECT *, COALESCE(sum(num_usertag) OVER (PARTITION BY web_id, uuid ORDER BY date DESC, hour DESC
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM stats) WHERE before < 50)"""


def bucketed(spark, sf):
    return tags(spark, sf).withColumn("hour", F.floor(F.col("hour") / 2).cast("int") * 2)


@query(
    "W3_retention_buckets",
    with_(TAGS, STATS, select="SELECT web_id, uuid, date, hour, num_usertag FROM kept"),
)
def retention_buckets(spark, sf):
    return usertags.retained_buckets(usertags.bucket_stats(bucketed(spark, sf)), 50)


@query(
    "W3_retained_tags",
    with_(
        TAGS, STATS,
        select="""SELECT t.web_id, t.uuid, t.usertag, t.event_id FROM tags t
  WHERE EXISTS (SELECT 1 FROM kept k WHERE k.web_id = t.web_id AND k.uuid = t.uuid AND k.date = t.date
                AND k.hour = t.hour // 2 * 2)""",
    ),
)
def retained_tags(spark, sf):
    rows = bucketed(spark, sf)
    kept = usertags.retain_recent(rows, usertags.bucket_stats(rows), 50)
    return kept.select("web_id", "uuid", "usertag", "event_id")


@query(
    "W4_moving_average",
    """SELECT event_id, event_type, round(avg(value) OVER (PARTITION BY event_type ORDER BY ts, event_id
         ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS average FROM events""",
)
def moving_average(spark, sf):
    day = F.to_date("ts")
    rows = ranking.moving_average(
        table(spark, sf, "events"), ["event_type"], [F.col("ts"), F.col("event_id")], "value", 7, day, block=256
    )
    return rows.select("event_id", "event_type", F.round("average", 6).alias("average"))


@query(
    "W5_block_average",
    """SELECT event_type, CAST((rn - 1) // 7 AS BIGINT) AS block, round(avg(value), 6) AS average FROM (
         SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events)
       GROUP BY 1, 2 HAVING count(*) = 7""",
)
def block_average(spark, sf):
    rows = ranking.moving_average(
        table(spark, sf, "events"), ["event_type"], [F.col("ts"), F.col("event_id")], "value", 7,
        F.to_date("ts"), mode="fixing",
    )
    return rows.withColumn("average", F.round("average", 6))


SNAPSHOTS = """now AS (SELECT web_id, keyword, CAST(sum(pageviews) AS BIGINT) AS pageviews FROM krows GROUP BY ALL),
last AS (SELECT web_id, keyword, CAST(sum(pageviews) AS BIGINT) AS pageviews FROM krows WHERE date <= 20240102 GROUP BY ALL)"""


def snapshots(spark, sf):
    rows = keyword_rows(spark, sf)
    total = F.sum("pageviews").alias("pageviews")
    now = rows.groupBy("web_id", "keyword").agg(total)
    last = rows.where(F.col("date") <= 20240102).groupBy("web_id", "keyword").agg(total)
    return now, last


@query(
    "W6_keyword_trend",
    with_(
        *ROWS_BASE, SNAPSHOTS,
        select="""SELECT web_id, keyword, n.pageviews, COALESCE(l.pageviews, 0) AS pageviews_last,
  round(COALESCE(CAST(n.pageviews - l.pageviews AS DOUBLE) / l.pageviews, 0.0), 6) AS trend
  FROM now n LEFT JOIN last l USING (web_id, keyword)""",
    ),
)
def keyword_trend(spark, sf):
    now, last = snapshots(spark, sf)
    return trends.trend(now, last, ["web_id", "keyword"]).withColumn("trend", F.round("trend", 6))


@query(
    "W7_article_trend",
    with_(
        *ROWS_BASE,
        """now AS (SELECT web_id, article_id, CAST(sum(pageviews) AS BIGINT) AS pageviews FROM arows GROUP BY ALL),
last AS (SELECT web_id, article_id, CAST(sum(pageviews) AS BIGINT) AS pageviews FROM arows WHERE date <= 20240102 GROUP BY ALL)""",
        select="""SELECT web_id, article_id, n.pageviews, COALESCE(l.pageviews, 0) AS pageviews_last,
  round(COALESCE(CAST(n.pageviews - l.pageviews AS DOUBLE) / n.pageviews * 100, 0.0), 6) AS trend
  FROM now n LEFT JOIN last l USING (web_id, article_id)""",
    ),
)
def article_trend(spark, sf):
    rows = rollups.attach_articles(rollups.day_pageviews(facts(spark, sf)), _articles(spark, sf))
    total = F.sum("pageviews").alias("pageviews")
    now = rows.groupBy("web_id", "article_id").agg(total)
    last = rows.where(F.col("date") <= 20240102).groupBy("web_id", "article_id").agg(total)
    return trends.trend(now, last, ["web_id", "article_id"], base="now").withColumn("trend", F.round("trend", 6))


def _articles(spark, sf):
    from clickloom.catalog.tables import articles

    return articles(spark, sf)


@query(
    "W8_hour_delta",
    with_(
        *FACTS_BASE,
        """cum AS (SELECT *, CAST(sum(n) OVER (PARTITION BY web_id, article_id, date ORDER BY hour) AS BIGINT) AS pageviews
  FROM (SELECT web_id, article_id, date, hour, sum(pageviews) AS n FROM facts GROUP BY ALL)),
joined AS (SELECT c.web_id, c.article_id, c.date, c.hour, c.pageviews, p.pageviews AS before FROM cum c
  LEFT JOIN cum p ON p.web_id = c.web_id AND p.article_id = c.article_id AND p.date = c.date AND p.hour = c.hour - 1)""",
        select="""SELECT web_id, article_id, date, hour, pageviews, CASE WHEN hour = 0 THEN pageviews
  WHEN COALESCE(before, 0) = 0 AND COALESCE(pageviews - before, 0) = 0 THEN pageviews
  ELSE COALESCE(pageviews - before, 0) END AS pageviews_hour FROM joined""",
    ),
)
def hour_delta(spark, sf):
    keys = ["web_id", "article_id", "date"]
    return trends.hour_delta(trends.cumulative_by_hour(facts(spark, sf), keys), keys)


@query(
    "W9_top_k_per_group",
    """SELECT o_orderpriority, o_orderkey, o_totalprice, CAST(rk AS INTEGER) AS rk FROM (
         SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rk FROM orders)
       WHERE rk <= 1500""",
)
def top_k_per_group(spark, sf):
    rows = ranking.top_k(
        table(spark, sf, "orders"), ["o_orderpriority"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 1500, rank="rk"
    )
    return rows.select("o_orderpriority", "o_orderkey", "o_totalprice", "rk")


@query(
    "W10_rank_column",
    """SELECT o_orderpriority, o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey)
       AS position FROM orders""",
)
def rank_column(spark, sf):
    rows = ranking.add_position(
        table(spark, sf, "orders"), ["o_orderpriority"], [F.col("o_orderdate"), F.col("o_orderkey")],
        F.trunc("o_orderdate", "month"),
    )
    return rows.select("o_orderpriority", "o_orderkey", "position")


@query(
    "W11_keep_first",
    """SELECT o_custkey, o_orderkey, o_orderpriority FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate, o_orderkey) AS rn
         FROM orders) WHERE rn = 1""",
)
def keep_first(spark, sf):
    rows = ranking.keep_first(
        table(spark, sf, "orders"), ["o_custkey", "o_orderpriority"], [F.asc("o_orderdate"), F.asc("o_orderkey")]
    )
    return rows.select("o_custkey", "o_orderkey", "o_orderpriority")


@query(
    "W15_rank_user_tags",
    with_(
        TAGS,
        """freqs AS (SELECT web_id, uuid, usertag AS keyword, count(*) AS freq FROM tags GROUP BY ALL),
prices AS (SELECT 't' || p_partkey AS keyword, CAST(floor(p_retailprice) AS BIGINT) * 7 % 101 AS price FROM part),
ranked AS (SELECT f.*, COALESCE(price, 0) AS price,
    row_number() OVER (PARTITION BY web_id, uuid ORDER BY freq DESC, f.keyword) AS rk
  FROM freqs f LEFT JOIN prices USING (keyword)),
kept AS (SELECT *, row_number() OVER (PARTITION BY web_id, uuid ORDER BY md5(keyword)) AS pick FROM ranked WHERE rk <= 20),
slots AS (SELECT *, row_number() OVER (PARTITION BY web_id, uuid ORDER BY price, keyword) AS slot FROM kept WHERE pick <= 4),
offers AS (SELECT *, row_number() OVER (PARTITION BY web_id, uuid ORDER BY price DESC, keyword) AS slot
  FROM ranked WHERE rk BETWEEN 21 AND 30),
swaps AS (SELECT s.web_id, s.uuid, s.keyword, o.keyword AS rival, o.freq AS rival_freq
  FROM slots s JOIN offers o USING (web_id, uuid, slot) WHERE o.price > s.price)""",
        select="""SELECT k.web_id, k.uuid, COALESCE(rival, k.keyword) AS keyword, COALESCE(rival_freq, k.freq) AS freq
  FROM kept k LEFT JOIN swaps s ON s.web_id = k.web_id AND s.uuid = k.uuid AND s.keyword = k.keyword""",
    ),
)
def rank_user_tags(spark, sf):
    rows = tags(spark, sf).withColumnRenamed("usertag", "keyword")
    freq = F.count("*").alias("freq")
    keys = ["web_id", "uuid", "keyword"]
    old = rows.where(F.col("date") < 20240115).groupBy(*keys).agg(freq)
    new = rows.where(F.col("date") >= 20240115).groupBy(*keys).agg(freq)
    prices = table(spark, sf, "part").select(
        F.concat(F.lit("t"), F.col("p_partkey").cast("string")).alias("keyword"),
        (F.floor("p_retailprice").cast("long") * 7 % 101).alias("price"),
    )
    return usertags.rank_user_tags(old, new, prices, limit=20, challengers=10)
