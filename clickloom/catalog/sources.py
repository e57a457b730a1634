"""S*: readers. Logs and landed files are first written from the given tables to the shared folder."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from clickloom.catalog.registry import query
from clickloom.catalog.tables import KEY_SQL, table
from clickloom.operators.sets import union_all
from clickloom.session import scratch_path
from clickloom.sources import increments, landed, logs, words


@query("S1_table_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
def table_scan(spark, sf):
    where = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000)
    return logs.read_table(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_totalprice"], where)


def _log(spark, sf):
    root = scratch_path(spark, "hourly-log")
    logs.dump_log(table(spark, sf, "events"), root)
    return root


@query(
    "S2_read_hours",
    """SELECT 'range' AS scope, event_id FROM events WHERE ts >= TIMESTAMP '2024-01-09 22:00:00' AND ts < TIMESTAMP '2024-01-11 03:00:00'
UNION ALL SELECT 'day', event_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-12'
UNION ALL SELECT 'hour', event_id FROM events WHERE date_trunc('hour', ts) = TIMESTAMP '2024-01-12 13:00:00'
UNION ALL SELECT 'minute', event_id FROM events WHERE date_trunc('minute', ts) = TIMESTAMP '2024-01-12 12:59:00'""",
)
def read_hours(spark, sf):
    """Hour range, day, latest hour and latest minute of one hourly log."""
    root = _log(spark, sf)
    scopes = {
        "range": logs.read_hours(spark, root, dt.datetime(2024, 1, 9, 22), dt.datetime(2024, 1, 11, 3)),
        "day": logs.read_day(spark, root, dt.date(2024, 1, 12)),
        "hour": logs.read_latest_hour(spark, root, dt.datetime(2024, 1, 12, 13, 44)),
        "minute": logs.read_latest_minute(spark, root, dt.datetime(2024, 1, 12, 13, 0)),
    }
    return union_all(*[rows.select(F.lit(name).alias("scope"), "event_id") for name, rows in scopes.items()])


OBJECT = "event_id bigint, user_id bigint, event_type string, value double"


@query(
    "S3_glued_json",
    """SELECT event_id, user_id, event_type, value FROM events WHERE event_type <> 'error' UNION ALL
  SELECT event_id + 1000000, user_id, event_type, value FROM events WHERE event_type <> 'error'""",
)
def glued_json(spark, sf):
    """Two objects per text, glued in four ways; error events are written as broken text."""
    first = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    second = F.to_json(F.struct((F.col("event_id") + 1000000).alias("event_id"), "user_id", "event_type", "value"))
    mark = F.lit('"landing"')
    kind = F.col("event_type")
    glued = (
        F.when(kind == "view", F.concat(first, second))
        .when(kind == "click", F.concat(first, mark, mark, second))
        .when(kind == "purchase", F.concat(mark, first, second, mark))
        .when(kind == "signup", F.concat(mark, first, mark, second))
        .otherwise(F.concat(F.lit("{oops"), first))
    )
    root = scratch_path(spark, "glued")
    table(spark, sf, "events").select(glued.alias("value")).write.text(root)
    return logs.read_glued_json(spark, root, OBJECT, whole=False)


@query(
    "S4_json_documents",
    f"""SELECT event_id, CAST({KEY_SQL} AS INTEGER) AS k, 1 AS readable FROM events WHERE event_type <> 'error'
UNION ALL SELECT event_id, -1, 0 FROM events WHERE event_type = 'error'""",
)
def json_documents(spark, sf):
    from pyspark.sql import types as T

    broken = F.when(F.col("event_type") == "error", F.concat(F.lit("<"), F.col("props"))).otherwise(F.col("props"))
    rows = table(spark, sf, "events").select("event_id", broken.alias("text"))
    parsed = logs.parse_document(rows, "text", T.StructType([T.StructField("k", T.IntegerType())]))
    return parsed.select(
        "event_id", F.coalesce("document.k", F.lit(-1)).alias("k"), F.col("readable").cast("int").alias("readable")
    )


@query(
    "S5_filter_and_dump",
    "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, CAST(hour(ts) AS INTEGER) AS hour FROM events WHERE event_type = 'purchase'",
)
def filter_and_dump(spark, sf):
    root = scratch_path(spark, "filtered-log")
    logs.dump_filtered(table(spark, sf, "events"), root, {"event_type": "purchase", "props": None})
    rows = spark.read.parquet(root)
    return rows.select("event_id", F.date_format(F.col("date").cast("date"), "yyyy-MM-dd").alias("day"), F.col("hour").cast("int").alias("hour"))


@query("S6_count_objects", "SELECT count(DISTINCT o_orderstatus) AS folders, 1 AS non_empty FROM orders")
def count_objects(spark, sf):
    """Files of a table written by order status: every one of its folders holds data."""
    root = scratch_path(spark, "objects")
    table(spark, sf, "orders").select("o_orderkey", "o_orderstatus").write.partitionBy("o_orderstatus").parquet(root)
    objects = logs.count_objects(spark, root)
    folders = spark.read.parquet(root).agg(F.countDistinct("o_orderstatus").alias("folders"))
    enough = objects.select((F.col("objects") > 0).cast("int").alias("n")).scalar()
    return folders.select("folders", enough.alias("non_empty"))


@query(
    "S7_word_list",
    r"SELECT DISTINCT lower(w) AS word FROM (SELECT unnest(string_split_regex(text, '[\s,.]+')) AS w FROM benchmark) WHERE w <> ''",
)
def word_list(spark, sf):
    root = scratch_path(spark, "words")
    listed = table(spark, sf, "benchmark").select(F.explode(F.split("text", r"[\s,.]+")).alias("value"))
    listed.where(F.col("value") != "").distinct().write.text(root)
    return words.read_word_list(spark, root, lower=True).distinct()


@query(
    "S8_incremental",
    """WITH marks AS (SELECT d.source AS web_id, max(l.doc_id) AS id_record FROM labels l JOIN documents d USING (doc_id) WHERE toxic = 1 GROUP BY 1),
f AS (SELECT d.source AS web_id, doc_id AS id, row_number() OVER (PARTITION BY d.source ORDER BY doc_id) AS rn FROM documents d
  LEFT JOIN marks m ON m.web_id = d.source WHERE doc_id > COALESCE(id_record, -1))
SELECT web_id, max(id) AS id_record, count(*) AS n FROM f WHERE rn <= 20 GROUP BY 1""",
)
def incremental(spark, sf):
    documents = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("web_id"))
    toxic = table(spark, sf, "labels").where(F.col("toxic") == 1).select(F.col("doc_id").alias("id"))
    marks = increments.high_water(documents.join(toxic, "id"))
    batch = increments.incremental(documents, marks, n=20)
    counts = batch.groupBy("web_id").agg(F.count("*").alias("n"))
    return increments.high_water(batch).join(counts, "web_id")


@query(
    "S9_latest_n",
    "SELECT source, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) AS rn FROM documents) WHERE rn <= 10",
)
def latest_n(spark, sf):
    rows = table(spark, sf, "documents").select("source", "doc_id")
    return increments.latest_n(rows, ["source"], [F.desc("doc_id")], 10)


@query(
    "S10_flatten_trends",
    """SELECT DISTINCT p_name AS keyword, p_brand || ',' || p_type AS related_queries, CAST(p_size AS BIGINT) * 10000 AS traffic, '2024-01-01' AS date FROM (
  SELECT *, row_number() OVER (PARTITION BY p_name, p_size ORDER BY p_brand || ',' || p_type) AS rn FROM part) WHERE rn = 1""",
)
def flatten_trends(spark, sf):
    search = F.struct(
        F.struct(F.col("p_name").alias("query")).alias("title"),
        F.concat(F.col("p_size").cast("string"), F.lit("萬+")).alias("formattedTraffic"),
        F.array(F.struct(F.col("p_brand").alias("query")), F.struct(F.col("p_type").alias("query"))).alias("relatedQueries"),
    )
    day = F.struct(F.struct(F.array(F.struct(F.array(search).alias("trendingSearches"))).alias("trendingSearchesDays")).alias("default"))
    raw = table(spark, sf, "part").select(F.lit("2024-01-01").alias("date"), F.concat(F.lit(")]}',\n"), F.to_json(day)).alias("value"))
    return landed.flatten_trends(raw)


@query(
    "S11_flatten_timeline",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS time, o_orderkey AS value_a, o_custkey AS value_b,
  o_orderstatus AS "formattedValue_a", o_orderpriority AS "formattedValue_b" FROM orders""",
)
def flatten_timeline(spark, sf):
    point = F.struct(
        F.date_format("o_orderdate", "yyyyMMdd").alias("time"),
        F.array("o_orderkey", "o_custkey").alias("value"),
        F.array(F.lit(True), F.lit(True)).alias("hasData"),
        F.array("o_orderstatus", "o_orderpriority").alias("formattedValue"),
    )
    body = F.to_json(F.struct(F.struct(F.array(point).alias("timelineData")).alias("default")))
    raw = table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit(")]}',\n"), body).alias("value"))
    flat = landed.flatten_timeline(raw, names=["a", "b"])
    return flat.select("o_orderkey", "time", "value_a", "value_b", "formattedValue_a", "formattedValue_b")


@query(
    "S11_flatten_geo",
    "SELECT n_nationkey, n_name AS \"geoName\", CAST(n_regionkey AS BIGINT) AS value FROM nation",
)
def flatten_geo(spark, sf):
    spot = F.struct(F.col("n_name").alias("geoName"), F.array(F.col("n_regionkey")).alias("value"))
    body = F.to_json(F.struct(F.struct(F.array(spot).alias("geoMapData")).alias("default")))
    raw = table(spark, sf, "nation").select("n_nationkey", body.alias("value"))
    return landed.flatten_geo(raw).select("n_nationkey", "geoName", "value")


@query(
    "S11_flatten_ranked",
    """SELECT p_partkey, 'hot' AS kind, p_name AS query, CAST(p_size AS BIGINT) AS value FROM part
UNION ALL SELECT p_partkey, 'up', p_type, CAST(p_size AS BIGINT) * 2 FROM part""",
)
def flatten_ranked(spark, sf):
    hot = F.struct(F.col("p_name").alias("query"), F.col("p_size").alias("value"))
    rising = F.struct(F.col("p_type").alias("query"), (F.col("p_size") * 2).alias("value"))
    lists = F.array(F.struct(F.array(hot).alias("rankedKeyword")), F.struct(F.array(rising).alias("rankedKeyword")))
    body = F.to_json(F.struct(F.struct(lists.alias("rankedList")).alias("default")))
    raw = table(spark, sf, "part").select("p_partkey", body.alias("value"))
    return landed.flatten_ranked(raw).select("p_partkey", "kind", "query", "value")


@query(
    "S12_flatten_console",
    """SELECT l_orderkey, l_linenumber, l_returnflag AS query, l_linestatus AS device, l_quantity AS clicks, l_extendedprice AS impressions
FROM lineitem""",
)
def flatten_console(spark, sf):
    row = F.struct(
        F.array("l_returnflag", "l_linestatus").alias("keys"), F.col("l_quantity").alias("clicks"),
        F.col("l_extendedprice").alias("impressions"), F.col("l_discount").alias("position"),
    )
    raw = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.to_json(F.struct(F.array(row).alias("rows"))).alias("value")
    )
    flat = landed.flatten_console(raw, ["query", "device"])
    return flat.select("l_orderkey", "l_linenumber", "query", "device", "clicks", "impressions")


@query(
    "S13_flatten_ideas",
    """WITH asked AS (SELECT replace(p_name, ' ', '') AS keyword_join, min(p_name) AS keyword_ask FROM part WHERE p_size > 25 GROUP BY 1)
SELECT p_partkey AS avg_monthly_traffic, p_name AS keyword_google, keyword_ask, CAST(p_size AS DOUBLE) / 100 AS low_price, 2024 AS year, CAST(m AS INTEGER) AS month,
  '2024-' || lpad(CAST(m AS VARCHAR), 2, '0') || '-01' AS date, p_size * m AS monthly_traffic
FROM part JOIN asked ON keyword_join = replace(p_name, ' ', ''), (SELECT unnest(range(1, 13)) AS m)""",
)
def flatten_ideas(spark, sf):
    part = table(spark, sf, "part")
    volumes = F.transform(
        F.sequence(F.lit(1), F.lit(12)),
        lambda m: F.struct(F.lit(2024).alias("year"), (m + 1).alias("month"), (F.col("p_size") * m).alias("monthly_searches")),
    )
    metrics = F.struct(
        F.lit("LOW").alias("competition"), (F.col("p_size") * 10000).alias("low_top_of_page_bid_micros"),
        F.col("p_partkey").alias("avg_monthly_searches"), volumes.alias("monthly_search_volumes"),
    )
    raw = part.select(F.to_json(F.struct(F.col("p_name").alias("text"), metrics.alias("keyword_idea_metrics"))).alias("value"))
    asked = part.where(F.col("p_size") > 25).select(F.col("p_name").alias("keyword_ask"))
    flat = landed.flatten_ideas(landed.parse_ideas(raw), asked)
    return flat.select(
        "avg_monthly_traffic", "keyword_google", "keyword_ask", "low_price", "year", "month",
        F.date_format("date", "yyyy-MM-dd").alias("date"), "monthly_traffic",
    )
