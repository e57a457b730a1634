"""O* and U*: ordering, paging, set operations, dictionaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.catalog.registry import query, with_
from clickloom.catalog.tables import KEY_SQL, event_key, table
from clickloom.functions import text as tx
from clickloom.operators import ranking, sets

WORD_SQL = r"string_split_regex(lower(text), '[^\p{L}\p{N}]+')"


@query("O1_top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def top_n(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return ranking.top_n(rows, [F.desc("o_totalprice"), F.asc("o_orderkey")], 100)


@query("O2_page", "SELECT doc_id, lang FROM documents WHERE lang IN ('en', 'fr') ORDER BY doc_id DESC LIMIT 50 OFFSET 100")
def page(spark, sf):
    rows = table(spark, sf, "documents").where(F.col("lang").isin("en", "fr")).select("doc_id", "lang")
    return ranking.top_n(rows, [F.desc("doc_id")], 50, offset=100)


@query(
    "U1_union_all",
    """SELECT 'customer' AS kind, c_name AS name, c_acctbal AS balance, -1 AS size FROM customer
UNION ALL SELECT 'supplier', s_name, s_acctbal, -1 FROM supplier UNION ALL SELECT 'part', p_name, -1.0, p_size FROM part""",
)
def union_all(spark, sf):
    return sets.union_all(
        table(spark, sf, "customer").select(F.lit("customer").alias("kind"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")),
        table(spark, sf, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")),
        table(spark, sf, "part").select(F.lit("part").alias("kind"), F.col("p_name").alias("name"), F.col("p_size").alias("size")),
    ).fillna(-1)


@query(
    "U2_keyword_dictionary",
    rf"""WITH w AS (SELECT DISTINCT unnest({WORD_SQL}) AS word FROM benchmark),
trends AS (SELECT 'kw' || {KEY_SQL} AS keyword, event_type AS r FROM events WHERE value > 1)
SELECT DISTINCT * FROM (SELECT '*' AS web_id, word AS keyword FROM w WHERE word <> ''
UNION ALL SELECT '*', keyword FROM trends UNION ALL SELECT '*', r FROM trends
UNION ALL SELECT '*', p_name FROM part WHERE p_size <> 1
UNION ALL SELECT CASE WHEN toxic = 1 THEN '*' ELSE 'w' || doc_id % 3 END, 'doc' || doc_id FROM labels WHERE quality = 1)""",
)
def keyword_dictionary(spark, sf):
    added = table(spark, sf, "benchmark").select(F.explode(tx.latin_tokens(F.col("text"))).alias("word"))
    events = table(spark, sf, "events")
    related = F.when(F.col("value") > 1, F.array("event_type")).otherwise(F.array().cast("array<string>"))
    trends = events.select(
        F.concat(F.lit("kw"), event_key().cast("string")).alias("keyword"), related.alias("related_queries")
    )
    priced = table(spark, sf, "part").select(F.col("p_name").alias("keyword"), (F.col("p_size") - 1).alias("low_price"))
    return sets.keyword_dictionary(added, trends, priced, bw_rows(spark, sf))


def bw_rows(spark, sf):
    """Labels as a black/white list: quality is the property, toxic rows hold for every tenant."""
    tenant = F.concat(F.lit("w"), (F.col("doc_id") % 3).cast("string"))
    return table(spark, sf, "labels").select(
        F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("name"),
        F.when(F.col("toxic") == 1, "all").otherwise(tenant).alias("web_id"),
        F.col("quality").alias("property"),
    )


@query("U3_minus", "SELECT c_custkey AS custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 300000")
def minus(spark, sf):
    rich = table(spark, sf, "orders").where(F.col("o_totalprice") > 300000).select(F.col("o_custkey").alias("custkey"))
    return sets.minus(table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey")), rich)


@query(
    "U4_intersect_ordered",
    """SELECT p_partkey, array_to_string(list_filter(string_split(p_name || ' ' || p_name, ' '),
  lambda w: list_contains(['old', 'ring', 'red', 'gear'], w)), ',') AS kept FROM part""",
)
def intersect_ordered(spark, sf):
    words = F.split(F.concat_ws(" ", "p_name", "p_name"), " ")
    allowed = F.array(*[F.lit(w) for w in ("old", "ring", "red", "gear")])
    kept = F.array_join(sets.intersect_ordered(words, allowed), ",")
    return table(spark, sf, "part").select("p_partkey", kept.alias("kept"))


@query("U5_distinct_words", rf"SELECT DISTINCT word FROM (SELECT unnest({WORD_SQL}) AS word FROM benchmark) WHERE word <> ''")
def distinct_words(spark, sf):
    return sets.distinct_words(table(spark, sf, "benchmark").select(F.explode(tx.latin_tokens(F.col("text"))).alias("word")))


@query(
    "U6_bw_lists",
    """SELECT DISTINCT * FROM (SELECT CASE WHEN toxic = 1 THEN 'all' ELSE 'w' || doc_id % 3 END AS web_id, 'doc' || doc_id AS keyword,
  quality AS property FROM labels
UNION ALL SELECT n_name, r_name, 0 FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT n_name, n_name, 0 FROM nation)""",
)
def bw_lists(spark, sf):
    regions = table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    tenants = table(spark, sf, "nation").join(regions, "n_regionkey").select(
        F.col("n_name").alias("web_id"), F.to_json(F.array("r_name", "n_name")).alias("name")
    )
    return sets.bw_lists(bw_rows(spark, sf), tenants)
