"""J*: join shapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.catalog.registry import query, with_
from clickloom.catalog.tables import AD_DAYS, ARTICLES, BROWSE, ad_days, articles, browse, table
from clickloom.functions.urls import url_key
from clickloom.operators import joins


@query(
    "J1_natural_join",
    with_(BROWSE, ARTICLES, select="SELECT web_id, article_id, event_id, uuid, title FROM browse JOIN articles USING (web_id, article_id)"),
)
def natural_join(spark, sf):
    joined = joins.natural_join(browse(spark, sf), articles(spark, sf), spread=8)
    return joined.select("web_id", "article_id", "event_id", "uuid", "title")


@query(
    "J2_three_way_join",
    with_(
        BROWSE, ARTICLES,
        select="""SELECT event_id, title, c_mktsegment FROM browse JOIN articles USING (web_id, article_id)
  JOIN customer ON CAST(c_custkey AS VARCHAR) = uuid WHERE c_acctbal > 0 AND is_cut = 1 AND source_domain <> 'None'""",
    ),
)
def three_way_join(spark, sf):
    people = table(spark, sf, "customer").where(F.col("c_acctbal") > 0)
    people = people.select(F.col("c_custkey").cast("string").alias("uuid"), "c_mktsegment")
    views = browse(spark, sf).where(F.col("source_domain") != "None")
    cut = articles(spark, sf).where(F.col("is_cut") == 1)
    joined = joins.salted_join(views, cut, ["web_id", "article_id"])
    return joins.salted_join(joined, people, ["uuid"]).select("event_id", "title", "c_mktsegment")


@query(
    "J3_join_complete",
    """SELECT d.doc_id, d.lang, l.quality FROM documents d JOIN labels l USING (doc_id) WHERE quality IS NOT NULL AND lang IS NOT NULL""",
)
def join_complete(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "lang")
    return joins.join_complete(documents, table(spark, sf, "labels").select("doc_id", "quality"), ["doc_id"])


@query("J4_lookup_default", "SELECT d.doc_id, COALESCE(quality, -1) AS quality FROM documents d LEFT JOIN labels USING (doc_id)")
def lookup_default(spark, sf):
    return joins.lookup_default(
        table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels"), ["doc_id"], {"quality": F.lit(-1)}
    )


@query(
    "J5_align_now_last",
    """WITH now AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY 1),
last AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1)
SELECT now.o_custkey, now.n, COALESCE(last.n, -1) AS n_last FROM now LEFT JOIN last USING (o_custkey)""",
)
def align_now_last(spark, sf):
    orders = table(spark, sf, "orders")
    split = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    count = F.count("*").alias("n")
    now = orders.where(split).groupBy("o_custkey").agg(count)
    last = orders.where(~split).groupBy("o_custkey").agg(count)
    return joins.align_now_last(now, last, ["o_custkey"], "n").fillna(-1, ["n_last"])


@query("J6_left_semi", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def left_semi(spark, sf):
    buyers = table(spark, sf, "orders").where(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("c_custkey"))
    return joins.keep_in(table(spark, sf, "customer"), buyers, ["c_custkey"]).select("c_custkey")


@query(
    "J7_left_anti",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')",
)
def left_anti(spark, sf):
    urgent = table(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    urgent = urgent.select(F.col("o_custkey").alias("c_custkey"))
    return joins.keep_not_in(table(spark, sf, "customer"), urgent, ["c_custkey"]).select("c_custkey", "c_name")


PAGE_KEY = "lower(split_part(url, '?', 1))"


@query(
    "J11_enrich_by_url",
    f"""WITH items AS (SELECT {PAGE_KEY} AS key, min('p' || page_id) AS product_id FROM pages WHERE contains(url, 'blog.') GROUP BY 1)
SELECT p.page_id, COALESCE(i.product_id, '_') AS product_id FROM pages p LEFT JOIN items i ON i.key = lower(split_part(p.url, '?', 1))""",
)
def enrich_by_url(spark, sf):
    pages = table(spark, sf, "pages")
    items = pages.where(F.col("url").contains("blog.")).select(
        F.col("url").alias("item_url"), F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("product_id")
    )
    rows = pages.select("page_id", "url")
    found = joins.enrich_by_url(rows, items, url_key(F.col("url")), url_key(F.col("item_url")), ["product_id"])
    return found.select("page_id", "product_id")


@query(
    "J12_enrich_by_title",
    with_(
        AD_DAYS,
        "items AS (SELECT p_name AS title, min(CAST(p_partkey AS VARCHAR)) AS pid FROM part WHERE p_size > 45 GROUP BY 1)",
        select="""SELECT web_id, title, COALESCE(pid, '_') AS product_id, CAST(sum(cents) AS BIGINT) AS cents
  FROM ad_days LEFT JOIN items USING (title) GROUP BY 1, 2, 3""",
    ),
)
def enrich_by_title(spark, sf):
    items = table(spark, sf, "part").where(F.col("p_size") > 45)
    items = items.select(F.col("p_name").alias("title"), F.col("p_partkey").cast("string").alias("product_id"))
    sums = ad_days(spark, sf).groupBy("web_id", "title").agg(F.sum("cents").alias("cents"))
    return joins.enrich_by_title(sums, items).select("web_id", "title", "product_id", "cents")


@query(
    "J14_top_similar",
    """WITH sim AS (SELECT l_returnflag AS web_id, l_partkey AS main, l_suppkey AS other, max(l_discount) * 10 AS score
  FROM lineitem GROUP BY 1, 2, 3),
ranked AS (SELECT *, row_number() OVER (PARTITION BY web_id, main ORDER BY score DESC, other) AS rk FROM sim WHERE score <> 1),
wide AS (SELECT web_id, main AS main_product_id, max(CASE WHEN rk = 1 THEN other END) AS sim1, max(CASE WHEN rk = 2 THEN other END) AS sim2,
  max(CASE WHEN rk = 3 THEN other END) AS sim3 FROM ranked WHERE rk <= 3 GROUP BY 1, 2)
SELECT web_id, main_product_id, sim1, sim2, sim3 FROM wide WHERE sim3 IS NOT NULL""",
)
def top_similar(spark, sf):
    return joins.top_similar(similar_items(spark, sf))


def similar_items(spark, sf):
    """Line items as an item-similarity table: the best discount of a supplier for a part."""
    return (
        table(spark, sf, "lineitem")
        .groupBy(
            F.col("l_returnflag").alias("web_id"), F.col("l_partkey").alias("main_product_id"),
            F.col("l_suppkey").alias("similarity_product_id"),
        )
        .agg((F.max("l_discount") * 10).alias("text_similarity"))
    )
