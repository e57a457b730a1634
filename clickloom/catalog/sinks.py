"""K*: table changes; queries that write read the written table back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from clickloom.catalog.registry import query, with_
from clickloom.catalog.tables import ROWS_BASE, DOCS, docs, keyword_rows, table
from clickloom.operators import sets
from clickloom.session import materialise, scratch_path
from clickloom.sinks import merge


def halves(spark, sf):
    """Customers as a stored table and a change set that overlaps it."""
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    old = rows.where(F.col("c_acctbal") < 6000)
    blank = F.when(F.col("c_acctbal") < 4000, F.lit("_")).otherwise(F.concat(F.lit("new "), F.col("c_name")))
    new = rows.where(F.col("c_acctbal") > 3000).select("c_custkey", blank.alias("c_name"), (F.col("c_acctbal") + 1).alias("c_acctbal"))
    return old, new


HALVES = """old AS (SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal < 6000),
new AS (SELECT c_custkey, CASE WHEN c_acctbal < 4000 THEN '_' ELSE 'new ' || c_name END AS c_name, c_acctbal + 1 AS c_acctbal
  FROM customer WHERE c_acctbal > 3000)"""


@query(
    "K1_replace_into",
    with_(HALVES, select="SELECT * FROM old WHERE c_custkey NOT IN (SELECT c_custkey FROM new) UNION ALL SELECT * FROM new"),
)
def replace_into(spark, sf):
    return merge.replace_into(*halves(spark, sf), ["c_custkey"])


@query(
    "K2_upsert_columns",
    with_(
        HALVES,
        select="""SELECT COALESCE(o.c_custkey, n.c_custkey) AS c_custkey, CASE WHEN n.c_custkey IS NULL THEN o.c_name ELSE n.c_name END AS c_name,
  CASE WHEN o.c_custkey IS NULL THEN n.c_acctbal ELSE o.c_acctbal END AS c_acctbal FROM old o FULL JOIN new n ON o.c_custkey = n.c_custkey""",
    ),
)
def upsert_columns(spark, sf):
    return merge.upsert(*halves(spark, sf), ["c_custkey"], ["c_name"])


@query(
    "K2_merge_into",
    with_(HALVES, select="SELECT * FROM old WHERE c_custkey NOT IN (SELECT c_custkey FROM new) UNION ALL SELECT * FROM new"),
)
def merge_into(spark, sf):
    root = scratch_path(spark, "merged-table")
    old, new = halves(spark, sf)
    merge.merge_into(old, root, ["c_custkey"])
    merge.merge_into(new, root, ["c_custkey"])
    return merge.read_merged(spark, root)


@query(
    "K3_update_where",
    with_(HALVES, select="SELECT o.c_custkey, COALESCE(n.c_name, o.c_name) AS c_name, o.c_acctbal FROM old o LEFT JOIN new n ON o.c_custkey = n.c_custkey"),
)
def update_where(spark, sf):
    return merge.update_where(*halves(spark, sf), ["c_custkey"], ["c_name"])


@query("K4_drop_expired", "SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1999-05-01' AND NOT (o_orderstatus = 'P')")
def drop_expired(spark, sf):
    rows = table(spark, sf, "orders").withColumn("expired_date", F.to_date("o_orderdate"))
    kept = merge.drop_expired(rows, dt.date(1999, 5, 1))
    return merge.delete_where(kept, F.col("o_orderstatus") == "P").select("o_orderkey")


@query("K4_keep_days", "SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '2001-07-01' - 90")
def keep_days(spark, sf):
    rows = table(spark, sf, "orders").withColumn("date", F.to_date("o_orderdate"))
    return merge.keep_days(rows, dt.date(2001, 7, 1)).select("o_orderkey")


@query(
    "K5_overwrite_partitions",
    """SELECT o_orderkey, CAST(isodow(o_orderdate) AS INTEGER) AS weekday, CASE WHEN isodow(o_orderdate) = 3 THEN 'second' ELSE 'first' END AS run FROM orders""",
)
def overwrite_partitions(spark, sf):
    """A weekday ring: the second run replaces Wednesday only."""
    root = scratch_path(spark, "ring")
    ring = table(spark, sf, "orders").select("o_orderkey", (F.weekday("o_orderdate") + 1).alias("weekday"))
    merge.overwrite_partitions(ring.withColumn("run", F.lit("first")), root, ["weekday"])
    merge.overwrite_partitions(ring.where(F.col("weekday") == 3).withColumn("run", F.lit("second")), root, ["weekday"])
    return spark.read.parquet(root)


@query("K6_chunked_write", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def chunked_write(spark, sf):
    root = scratch_path(spark, "chunks")
    merge.write_table(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), root, max_rows=100_000)
    return spark.read.parquet(root)


@query("K7_insert_ignore", with_(HALVES, select="SELECT * FROM new WHERE c_custkey NOT IN (SELECT c_custkey FROM old)"))
def insert_ignore(spark, sf):
    return merge.insert_ignore(*halves(spark, sf), ["c_custkey"])


@query(
    "K8_write_tables",
    with_(
        *ROWS_BASE,
        select="""SELECT 'keyword' AS name, keyword AS key, CAST(sum(pageviews) AS BIGINT) AS pageviews FROM krows GROUP BY 2
  UNION ALL SELECT 'source', source, CAST(sum(pageviews) AS BIGINT) FROM krows GROUP BY 2""",
    ),
)
def write_tables(spark, sf):
    """Several tables from one stored exploded fact."""
    root = scratch_path(spark, "tables")
    rows = materialise(keyword_rows(spark, sf).select("keyword", "source", "pageviews"), "keyword-fact")
    total = F.sum("pageviews").alias("pageviews")
    merge.write_tables({n: rows.groupBy(F.col(n).alias("key")).agg(total) for n in ("keyword", "source")}, root)
    parts = [spark.read.parquet(f"{root}/{n}").withColumn("name", F.lit(n)) for n in ("keyword", "source")]
    return sets.union_all(*parts)


@query("K9_snapshot", with_(DOCS, select="SELECT DISTINCT trim(k) AS keyword FROM (SELECT unnest(string_split(keywords, ',')) AS k FROM docs WHERE keywords <> '_')"))
def snapshot(spark, sf):
    root = scratch_path(spark, "snapshot")
    merge.write_table(sets.distinct_tags(docs(spark, sf).where(F.col("keywords") != "_"), F.split("keywords", ",")), root)
    return spark.read.parquet(root)
