"""The given tables read as the engine's logical tables, in Spark and in SQL.

``browse``: events as page views (tenant and article from the event's key, user as visitor).
``articles``: parts as articles (two-word names as keywords). ``docs``: documents as articles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.dates import date_int
from clickloom.operators import rollups, sessions
from clickloom.session import materialise
from clickloom.sources.logs import spread_by, spread_small


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(spark: SparkSession, sf: str, name: str = "documents") -> DataFrame:
    """A text table whose rows are shared out to all cores."""
    return spread_small(table(spark, sf, name))


def texts_by_id(spark: SparkSession, sf: str) -> DataFrame:
    """Documents (id, text, web_id), shared out by id: what is counted per document needs no further shuffle."""
    rows = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text", F.col("source").alias("web_id"))
    return spread_by(rows, "id")


def event_key() -> F.Column:
    return F.get_json_object("props", "$.k").cast("long")


def browse(spark: SparkSession, sf: str) -> DataFrame:
    key = event_key()
    tenant = F.concat(F.lit("w"), (key % 5).cast("string"))
    kind = F.col("event_type")
    source = (
        F.when(kind == "view", tenant)
        .when(kind == "click", "google search")
        .when(kind == "purchase", "fb")
        .when(kind == "signup", "youtube")
        .otherwise("None")
    )
    return table(spark, sf, "events").select(
        "event_id",
        "ts",
        tenant.alias("web_id"),
        F.col("user_id").cast("string").alias("uuid"),
        F.concat(F.lit("a"), key.cast("string")).alias("article_id"),
        source.alias("source_domain"),
        F.when(F.col("value") >= 20, F.floor("value").cast("long")).otherwise(F.lit(0).cast("long")).alias("time_on_page"),
    )


KEY_SQL = "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"

BROWSE = f"""browse AS (
  SELECT event_id, ts, 'w' || (k % 5) AS web_id, CAST(user_id AS VARCHAR) AS uuid, 'a' || k AS article_id,
         CASE event_type WHEN 'view' THEN 'w' || (k % 5) WHEN 'click' THEN 'google search'
              WHEN 'purchase' THEN 'fb' WHEN 'signup' THEN 'youtube' ELSE 'None' END AS source_domain,
         CASE WHEN value >= 20 THEN CAST(floor(value) AS BIGINT) ELSE 0 END AS time_on_page
  FROM (SELECT *, {KEY_SQL} AS k FROM events))"""

SESSIONS = """ordered AS (
  SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS sec,
         lead(CAST(floor(epoch(ts)) AS BIGINT)) OVER w AS next_sec,
         row_number() OVER w AS rn, first_value(source_domain) OVER w AS first_source
  FROM browse WINDOW w AS (PARTITION BY web_id, uuid ORDER BY ts, event_id)),
sess AS (
  SELECT event_id, ts, web_id, uuid, article_id,
         CASE WHEN first_source = 'None' THEN source_domain ELSE first_source END AS source_domain,
         CASE WHEN next_sec - sec > 1800 THEN 0 WHEN next_sec IS NULL OR time_on_page <> 0 THEN time_on_page
              ELSE next_sec - sec END AS time_on_page,
         CAST(rn = 1 AS BIGINT) AS landings, CAST(next_sec IS NULL AS BIGINT) AS exits,
         CAST(COALESCE(next_sec - sec > 1800, FALSE) OR (rn = 1 AND next_sec IS NULL) AS BIGINT) AS bounce
  FROM ordered)"""

FACTS = """facts AS (
  SELECT web_id, article_id, source_domain,
         CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date, CAST(hour(ts) AS INTEGER) AS hour,
         count(*) AS pageviews, CAST(sum(landings) AS BIGINT) AS landings, CAST(sum(exits) AS BIGINT) AS exits,
         CAST(sum(bounce) AS BIGINT) AS bounce, CAST(sum(time_on_page) AS BIGINT) AS time_on_page
  FROM sess WHERE source_domain <> 'None' GROUP BY ALL)"""

ARTICLES = """articles AS (
  SELECT 'w' || (p_partkey % 5) AS web_id, 'a' || p_partkey AS article_id, p_name AS title,
         replace(p_name, ' ', ',') AS keywords, CAST(p_size % 2 AS INTEGER) AS is_cut FROM part)"""

DAYS = """days AS (
  SELECT web_id, date, article_id, source_domain, CAST(sum(pageviews) AS BIGINT) AS pageviews,
         CAST(sum(landings) AS BIGINT) AS landings, CAST(sum(exits) AS BIGINT) AS exits,
         CAST(sum(bounce) AS BIGINT) AS bounce, CAST(sum(time_on_page) AS BIGINT) AS time_on_page
  FROM facts GROUP BY ALL)"""

ROWS = """arows AS (
  SELECT h.*, a.title, a.keywords, a.is_cut,
         CASE h.source_domain WHEN 'google search' THEN 'google' WHEN 'fb' THEN 'facebook'
              ELSE h.source_domain END AS source, h.source_domain = h.web_id AS internal
  FROM days h JOIN articles a USING (web_id, article_id)),
krows AS (SELECT r.*, unnest(string_split(r.keywords, ',')) AS keyword FROM arows r)"""

ROWS_BASE = (BROWSE, SESSIONS, FACTS, ARTICLES, DAYS, ROWS)
FACTS_BASE = (BROWSE, SESSIONS, FACTS)


def session_rows(spark: SparkSession, sf: str) -> DataFrame:
    return sessions.session_metrics(browse(spark, sf))


def facts(spark: SparkSession, sf: str) -> DataFrame:
    return sessions.pageview_facts(session_rows(spark, sf), F.col("ts"))


def articles(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.concat(F.lit("w"), (F.col("p_partkey") % 5).cast("string")).alias("web_id"),
        F.concat(F.lit("a"), F.col("p_partkey").cast("string")).alias("article_id"),
        F.col("p_name").alias("title"),
        F.translate("p_name", " ", ",").alias("keywords"),
        (F.col("p_size") % 2).alias("is_cut"),
    )


def article_rows(spark: SparkSession, sf: str) -> DataFrame:
    # the hourly fact is a stored table; the roll-ups start from it
    days = rollups.day_pageviews(materialise(facts(spark, sf), "hourly-facts"))
    rows = rollups.attach_articles(days, articles(spark, sf))
    return rollups.with_source(rows).withColumn("keyword_list", F.split("keywords", ","))


def keyword_rows(spark: SparkSession, sf: str) -> DataFrame:
    return rollups.explode_keywords(article_rows(spark, sf))


def tags(spark: SparkSession, sf: str) -> DataFrame:
    """One tag row per event: the key is the tag, the event type the token."""
    return table(spark, sf, "events").select(
        F.concat(F.lit("w"), (F.col("user_id") % 3).cast("string")).alias("web_id"),
        F.concat(F.lit("t"), event_key().cast("string")).alias("usertag"),
        F.col("user_id").cast("string").alias("uuid"),
        F.concat_ws("-", F.col("event_type"), F.col("user_id").cast("string")).alias("token"),
        "event_id",
        date_int(F.col("ts")).alias("date"),
        F.hour("ts").alias("hour"),
    )


TAGS = f"""tags AS (
  SELECT 'w' || (user_id % 3) AS web_id, 't' || {KEY_SQL} AS usertag, CAST(user_id AS VARCHAR) AS uuid,
         event_type || '-' || user_id AS token, event_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date,
         CAST(hour(ts) AS INTEGER) AS hour FROM events)"""


def docs(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as articles; labelled ones carry editorial keywords."""
    labels = table(spark, sf, "labels")
    text = table(spark, sf, "documents")
    editorial = F.concat_ws(
        " , ",
        F.col("source"),
        F.concat(F.lit("quality"), F.col("quality").cast("string")),
        F.concat(F.lit("toxic"), F.col("toxic").cast("string")),
    )
    return text.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("web_id"),
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("article_id"),
        F.col("text").alias("content"),
        "lang",
        F.when(F.col("quality").isNull(), "_").otherwise(editorial).alias("keywords"),
    )


DOCS = """docs AS (
  SELECT d.doc_id AS id, d.source AS web_id, 'd' || d.doc_id AS article_id, d.text AS content, d.lang,
         CASE WHEN l.quality IS NULL THEN '_'
              ELSE d.source || ' , quality' || l.quality || ' , toxic' || l.toxic END AS keywords
  FROM documents d LEFT JOIN labels l USING (doc_id))"""


def ad_days(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as daily ad revenue per product title."""
    lines = table(spark, sf, "lineitem")
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand")
    return lines.join(parts, "l_partkey").select(
        F.col("p_brand").alias("web_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("title"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_quantity").cast("long").alias("click"),
        F.lit(1).cast("long").alias("transaction"),
        F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")) * 100).cast("long").alias("cents"),
        F.when(F.col("l_returnflag") == "A", "google").otherwise("other").alias("source"),
        F.when(F.col("l_linestatus") == "F", "_").otherwise(F.col("p_name")).alias("url"),
    )


AD_DAYS = """ad_days AS (
  SELECT p_brand AS web_id, CAST(l_partkey AS VARCHAR) AS product_id, p_name AS title, CAST(l_shipdate AS DATE) AS date,
         CAST(l_quantity AS BIGINT) AS click, CAST(1 AS BIGINT) AS transaction,
         CAST(round(l_extendedprice * (1 - l_discount) * 100) AS BIGINT) AS cents,
         CASE WHEN l_returnflag = 'A' THEN 'google' ELSE 'other' END AS source,
         CASE WHEN l_linestatus = 'F' THEN '_' ELSE p_name END AS url
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def word_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings as word vectors; every label is a tenant."""
    return table(spark, sf, "embeddings").select(
        F.concat(F.lit("t"), F.col("label").cast("string")).alias("web_id"),
        F.concat(F.lit("word"), F.col("vec_id").cast("string")).alias("word"),
        F.col("embedding").alias("vector"),
    )
