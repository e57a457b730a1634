"""P*: predicates and projections."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from clickloom.catalog.registry import query, with_
from clickloom.catalog.tables import BROWSE, DOCS, KEY_SQL, browse, docs, event_key, table
from clickloom.functions.dates import epoch_seconds
from clickloom.operators import filters


@query(
    "P1_filter_by",
    f"""SELECT event_id, event_type FROM events WHERE event_type = 'click' AND props IS NOT NULL AND {KEY_SQL} = 9""",
)
def filter_by(spark, sf):
    rows = table(spark, sf, "events").withColumn("k", event_key())
    return filters.filter_by(rows, {"event_type": "click", "props": None, "k": 9}).select("event_id", "event_type")


@query(
    "P1_filter_bag",
    f"""SELECT event_id FROM events WHERE {KEY_SQL} = 7""",
)
def filter_bag(spark, sf):
    rows = table(spark, sf, "events").withColumn("bag", F.from_json("props", "map<string,string>"))
    return filters.filter_by(rows, {"k": "7"}, bag="bag").select("event_id")


@query("P2_filter_fuzzy", "SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'old') AND contains(p_type, 'AL')")
def filter_fuzzy(spark, sf):
    return filters.filter_by(table(spark, sf, "part"), {"p_name": "old", "p_type": "AL"}, fuzzy=True).select("p_partkey", "p_name")


@query(
    "P3_valid_events",
    with_(
        f"""raw AS (SELECT event_id, user_id, {KEY_SQL} AS k, value, event_type, ts FROM events),
tracker AS (SELECT event_id, 'w' || (k % 7) AS web_id,
    CASE WHEN user_id % 11 = 0 THEN '_' ELSE CAST(user_id AS VARCHAR) END AS uuid,
    CASE event_type WHEN 'view' THEN 'landing' WHEN 'error' THEN 'noise' ELSE 'tracking' END AS behavior_type,
    CASE WHEN event_type = 'click' THEN 'click' ELSE 'load' END AS ev,
    CASE WHEN k % 3 = 0 THEN NULL ELSE CAST(epoch_ms(ts) AS BIGINT) END AS stamp, k, value FROM raw),
urls AS (SELECT *, CASE WHEN stamp IS NOT NULL AND ev = 'load' THEN (CASE WHEN value < 10 THEN '' ELSE 'https://h/' || k END) ELSE 'https://c/' || k END AS current_url,
    CASE WHEN stamp IS NOT NULL AND ev = 'load' THEN 'https://h/' || CAST(floor(value) AS BIGINT) ELSE 'https://r/' || k END AS referrer_url FROM tracker)""",
        select="""SELECT event_id, web_id, current_url, referrer_url FROM urls
  WHERE behavior_type IN ('landing', 'tracking') AND (behavior_type = 'landing' OR ev = 'load') AND uuid <> '_'
    AND (stamp IS NULL OR value >= 2) AND current_url <> '' AND current_url <> referrer_url
    AND web_id IN (SELECT 'w' || r_regionkey FROM region)""",
    ),
)
def valid_events(spark, sf):
    k = event_key()
    kind = F.col("event_type")
    page = F.concat(F.lit("https://h/"), k.cast("string"))
    load = F.when(
        F.col("value") >= 2,
        F.struct(
            F.when(F.col("value") < 10, "").otherwise(page).alias("un"),
            F.concat(F.lit("https://h/"), F.floor("value").cast("string")).alias("ul"),
        ),
    )
    tracker = table(spark, sf, "events").select(
        "event_id",
        F.concat(F.lit("w"), (k % 7).cast("string")).alias("web_id"),
        F.when(F.col("user_id") % 11 == 0, "_").otherwise(F.col("user_id").cast("string")).alias("uuid"),
        F.when(kind == "view", "landing").when(kind == "error", "noise").otherwise("tracking").alias("behavior_type"),
        F.when(kind == "click", "click").otherwise("load").alias("event_type"),
        F.when(k % 3 != 0, epoch_seconds(F.col("ts")) * 1000).alias("timestamp"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("datetime"),
        F.concat(F.lit("https://c/"), k.cast("string")).alias("current_url"),
        F.concat(F.lit("https://r/"), k.cast("string")).alias("referrer_url"),
        load.alias("load"),
    )
    tenants = table(spark, sf, "region").select(F.concat(F.lit("w"), F.col("r_regionkey").cast("string")).alias("web_id"))
    return filters.valid_events(tracker, tenants).select("event_id", "web_id", "current_url", "referrer_url")


@query(
    "P4_day_window",
    "SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12'",
)
def day_window(spark, sf):
    return filters.day_window(table(spark, sf, "events"), "ts", dt.date(2024, 1, 10), 2).select("event_id", "user_id")


@query(
    "P4_day_window_epoch",
    "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'",
)
def day_window_epoch(spark, sf):
    rows = table(spark, sf, "events").withColumn("session_id", epoch_seconds(F.col("ts")))
    return filters.day_window(rows, "session_id", dt.date(2024, 1, 10)).select("event_id")


@query("P5_drop_sentinels", with_(DOCS, select="SELECT article_id, keywords FROM docs WHERE keywords NOT IN ('', '_')"))
def drop_sentinels(spark, sf):
    return filters.drop_sentinels(docs(spark, sf), ["keywords"]).select("article_id", "keywords")


@query("P6_caps", "SELECT p_partkey, p_name FROM part WHERE length(p_name) <= 8 AND p_size < 30")
def caps(spark, sf):
    rows = filters.cap_length(table(spark, sf, "part"), "p_name", 8)
    return filters.cap_number(rows, "p_size", 30).select("p_partkey", "p_name")


@query(
    "P7_recode",
    with_(
        BROWSE,
        select="""SELECT event_id, CASE source_domain WHEN 'google search' THEN 'google' WHEN 'fb' THEN 'facebook' ELSE source_domain END AS source,
  CASE source_domain WHEN 'youtube' THEN 'yt' ELSE source_domain END AS table_name,
  source_domain || CAST(CAST(time_on_page > 0 AS INTEGER) AS VARCHAR) AS code,
  CASE WHEN uuid = '1' THEN 'new' ELSE 'old' END AS member FROM browse""",
    ),
)
def recode(spark, sf):
    return browse(spark, sf).select(
        "event_id",
        filters.recode("source_domain", filters.SOURCE_NAMES).alias("source"),
        filters.recode("source_domain", filters.TABLE_NAMES).alias("table_name"),
        filters.platform_code(F.col("source_domain"), F.col("time_on_page") > 0).alias("code"),
        filters.member_tag(F.col("uuid"), "new", "old").alias("member"),
    )


@query(
    "P8_active_on",
    "SELECT o_orderkey FROM orders WHERE DATE '1998-06-01' BETWEEN CAST(o_orderdate AS DATE) AND CAST(o_orderdate AS DATE) + 30",
)
def active_on(spark, sf):
    ads = table(spark, sf, "orders").withColumns(
        {"start_time": F.col("o_orderdate"), "end_time": F.date_add(F.to_date("o_orderdate"), 30)}
    )
    return filters.active_on(ads, dt.date(1998, 6, 1)).select("o_orderkey")


@query(
    "P9_nulls",
    """SELECT d.doc_id, COALESCE(quality, 0) AS quality, COALESCE(toxic, 1) AS toxic,
  CAST(quality IS NOT NULL AS INTEGER) AS complete FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def nulls(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    done = filters.complete_rows(rows).select("doc_id", F.lit(1).alias("complete"))
    filled = filters.fill(filters.fill(rows, 0, ["quality"]), 1, ["toxic"])
    return filters.fill(filled.join(done, "doc_id", "left"), 0, ["complete"])


@query(
    "P10_shape_columns",
    "SELECT replace(p_name || '''s', '''', '\"') AS title_clean, p_partkey AS product_id, p_size * 2 AS double_size FROM part",
)
def shape_columns(spark, sf):
    from clickloom.functions.text import title_key

    titled = table(spark, sf, "part").withColumn("title", F.concat(F.col("p_name"), F.lit("'s")))
    return filters.shape_columns(
        titled,
        add={"title_clean": title_key(F.col("title")), "double_size": F.col("p_size") * 2},
        drop=("p_brand", "title"),
        rename={"p_partkey": "product_id"},
        order=("title_clean", "product_id", "double_size"),
    )


@query("P11_or_missing", "SELECT d.doc_id, COALESCE(CAST(quality AS VARCHAR), '_') AS quality FROM documents d LEFT JOIN labels USING (doc_id)")
def or_missing(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return rows.select("doc_id", filters.or_missing(F.col("quality").cast("string")).alias("quality"))
