"""Similarity and embedding operators over the embeddings table."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.catalog.registry import query
from clickloom.catalog.tables import table, texts, word_vectors
from clickloom.functions.edits import damerau
from clickloom.functions.vectors import cosine
from clickloom.operators import ml, similarity

VECTORS = """vecs AS (SELECT vec_id, 't' || label AS web_id, 'word' || vec_id AS word,
  CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"""


@query(
    "X4_keyword_similarity",
    f"""WITH {VECTORS}, scored AS (
  SELECT a.web_id, a.word AS keyword, b.word AS keyword_related,
    2 * list_cosine_similarity(a.v, b.v) - damerau_levenshtein(a.word, b.word) / CAST(length(a.word) AS DOUBLE) AS score
  FROM vecs a JOIN vecs b USING (web_id)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY web_id, keyword ORDER BY round(score, 9) DESC, keyword_related) AS rk
  FROM scored WHERE score > 0.09)
SELECT web_id, keyword, keyword_related, round(score, 6) AS score FROM ranked WHERE rk <= 10""",
)
def keyword_similarity(spark, sf):
    return similarity.keyword_similarity(word_vectors(spark, sf)).withColumn("score", F.round("score", 6))


TRENDS_SQL = """trends AS (SELECT web_id, 'word' || (vec_id * 10) AS word, v FROM vecs)"""


def trend_words(spark, sf):
    """All vectors under another spelling, as trend keywords."""
    words = word_vectors(spark, sf).withColumn("_id", F.substring("word", 5, 12).cast("long"))
    return words.select("web_id", F.concat(F.lit("word"), (F.col("_id") * 10).cast("string")).alias("word"), "vector")


@query(
    "X5_trend_catalogue_match",
    f"""WITH {VECTORS}, {TRENDS_SQL}, pairs AS (
  SELECT c.web_id, t.word AS keyword_trend, c.word AS keyword_item, list_cosine_similarity(t.v, c.v) AS cs,
    damerau_levenshtein(t.word, c.word) / CAST(greatest(length(t.word), length(c.word)) AS DOUBLE) AS far
  FROM vecs c JOIN trends t USING (web_id)),
scored AS (SELECT *, (cs - far + 0.5) / 1.5 AS score FROM pairs)
SELECT web_id, keyword_trend, keyword_item, round(score, 6) AS score, round(cs, 6) AS score_cosine, round(far, 6) AS score_edit
FROM scored WHERE score > 0.1 AND cs > 0.2 AND keyword_trend <> keyword_item""",
)
def trend_catalogue(spark, sf):
    matches = similarity.trend_catalogue_match(word_vectors(spark, sf), trend_words(spark, sf), min_cosine=0.2)
    return matches.withColumns({c: F.round(c, 6) for c in ("score", "score_cosine", "score_edit")})


@query(
    "J13_first_product",
    f"""WITH {VECTORS}, {TRENDS_SQL}, pairs AS (
  SELECT c.web_id, t.word AS keyword_trend, c.word AS keyword_item, list_cosine_similarity(t.v, c.v) AS cs,
    damerau_levenshtein(t.word, c.word) / CAST(greatest(length(t.word), length(c.word)) AS DOUBLE) AS far
  FROM vecs c JOIN trends t USING (web_id)),
kept AS (SELECT web_id, keyword_trend, keyword_item FROM pairs WHERE (cs - far + 0.5) / 1.5 > 0.1 AND cs > 0.2
  AND keyword_trend <> keyword_item),
products AS (SELECT web_id, 'word' || vec_id AS keyword_item, min(l_partkey) AS product_id
  FROM vecs JOIN lineitem ON l_suppkey = vec_id GROUP BY 1, 2)
SELECT web_id, keyword_trend, keyword_item, product_id FROM kept JOIN products USING (web_id, keyword_item)""",
)
def first_product(spark, sf):
    words = word_vectors(spark, sf)
    matches = similarity.trend_catalogue_match(words, trend_words(spark, sf), min_cosine=0.2)
    carried = table(spark, sf, "lineitem").select(
        F.concat(F.lit("word"), F.col("l_suppkey").cast("string")).alias("word"), F.col("l_partkey").alias("product_id")
    ).distinct()
    items = words.select("web_id", "word").join(carried, "word").withColumnRenamed("word", "keyword")
    found = similarity.attach_first_product(matches, items)
    return found.select("web_id", "keyword_trend", "keyword_item", "product_id")


@query(
    "X7_match_ads",
    """WITH vecs AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
arts AS (SELECT 'a' || (vec_id // 4) AS article_id, 'word' || vec_id AS aw, CASE WHEN vec_id % 17 = 0 THEN NULL ELSE v END AS av FROM vecs),
ads AS (SELECT 'ad' || (vec_id // 3) AS ad_id, 'word' || vec_id AS dw, v AS dv FROM vecs),
sims AS (SELECT article_id, ad_id, dw, COALESCE(list_cosine_similarity(av, dv), -1.0) AS s FROM arts, ads),
upper AS (SELECT article_id, ad_id, dw, avg(s) + stddev_pop(s) AS u FROM sims GROUP BY ALL),
scores AS (SELECT article_id, ad_id, avg(u) + stddev_pop(u) AS score FROM upper GROUP BY ALL),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY round(score, 9) DESC, ad_id) AS rk FROM scores)
  WHERE rk = 1),
words AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY article_id, ad_id ORDER BY round(u, 9) DESC, dw) AS rk FROM upper)
  WHERE rk = 1)
SELECT b.article_id, b.ad_id, w.dw AS keyword, round(b.score, 6) AS score, b.ad_id || '_' || w.dw AS keyword_ad
FROM best b JOIN words w ON w.article_id = b.article_id AND w.ad_id = b.ad_id""",
)
def match_ads(spark, sf):
    vec = table(spark, sf, "embeddings")
    word = F.concat(F.lit("word"), F.col("vec_id").cast("string")).alias("word")

    def owner(prefix, size):
        return F.concat(F.lit(prefix), F.floor(F.col("vec_id") / size).cast("string"))

    known = F.when(F.col("vec_id") % 17 != 0, F.col("embedding"))
    articles = vec.select(owner("a", 4).alias("article_id"), word, known.alias("vector"))
    ads = vec.select(owner("ad", 3).alias("ad_id"), word, F.col("embedding").alias("vector"))
    return similarity.match_ads(articles, ads).withColumn("score", F.round("score", 6))


@query(
    "X11_nearest_words",
    f"""WITH {VECTORS}, sims AS (SELECT a.word, b.word AS other, round(list_cosine_similarity(a.v, b.v), 9) AS s
  FROM vecs a JOIN vecs b ON a.word <> b.word),
ranked AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY s DESC, other) AS rk FROM sims)
SELECT word, other, round(s, 6) AS similarity FROM ranked WHERE rk <= 5""",
)
def nearest_words(spark, sf):
    words = word_vectors(spark, sf).select("word", "vector")
    return similarity.nearest(words, words, k=5).withColumn("similarity", F.round("similarity", 6))


@query(
    "J9_scored_pairs",
    f"""WITH {VECTORS} SELECT a.word, b.word AS other,
  round(list_cosine_similarity(a.v, b.v), 4) AS similarity FROM vecs a JOIN vecs b ON a.web_id = b.web_id
  AND a.word <> b.word WHERE round(list_cosine_similarity(a.v, b.v), 9) >= 0.3""",
)
def scored_pairs(spark, sf):
    return similarity.close_pairs(word_vectors(spark, sf), 0.3).select(
        "word", "other", F.round("similarity", 4).alias("similarity")
    )


@query(
    "X10_mean_vector",
    """WITH words AS (SELECT doc_id AS id, quality + 2 * toxic + 10 * (doc_id % 60) AS vec_id FROM labels
  UNION ALL SELECT doc_id, n_chars % 700 FROM documents),
dims AS (SELECT vec_id, unnest(embedding) AS x, unnest(range(64)) AS dim FROM embeddings),
means AS (SELECT id, dim, avg(CAST(x AS DOUBLE)) AS m FROM words JOIN dims USING (vec_id) GROUP BY ALL),
ids AS (SELECT DISTINCT id FROM words)
SELECT i.id, CAST(d.dim AS INTEGER) AS dim, round(COALESCE(m, 0.0), 5) + 0.0 AS value FROM ids i JOIN (SELECT unnest(range(64)) AS dim) d ON TRUE
LEFT JOIN means ON means.id = i.id AND means.dim = d.dim""",
)
def mean_vector(spark, sf):
    labels, documents = table(spark, sf, "labels"), table(spark, sf, "documents")
    ref = F.col("quality") + 2 * F.col("toxic") + 10 * (F.col("doc_id") % 60)
    words = labels.select(F.col("doc_id").alias("id"), ref.cast("long").alias("_v")).unionByName(
        documents.select(F.col("doc_id").alias("id"), (F.col("n_chars") % 700).alias("_v"))
    )
    named = words.select("id", F.concat(F.lit("word"), F.col("_v").cast("string")).alias("word"))
    means = similarity.mean_vector(named, word_vectors(spark, sf))
    return means.select("id", F.posexplode("vector").alias("dim", "value")).withColumn("value", F.round("value", 5) + 0.0)


@query(
    "X12_cosine_default",
    """SELECT a.vec_id, round(COALESCE(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), -1.0), 6)
  AS similarity FROM embeddings a LEFT JOIN embeddings b ON b.vec_id = a.vec_id * 2""",
)
def cosine_default(spark, sf):
    left = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("a"))
    right = table(spark, sf, "embeddings").select(F.col("vec_id").alias("_other"), F.col("embedding").alias("b"))
    joined = left.join(right, F.col("vec_id") * 2 == F.col("_other"), "left")
    return joined.select("vec_id", F.round(cosine(F.col("a"), F.col("b")), 6).alias("similarity"))


@query(
    "UD4_edit_distance",
    "SELECT p_partkey, CAST(damerau_levenshtein(p_name, p_type) AS INTEGER) AS distance FROM part",
)
def edit_distances(spark, sf):
    return table(spark, sf, "part").select("p_partkey", damerau("p_name", "p_type").alias("distance"))


@query("X13_cluster_items")
def cluster_items(spark, sf):
    rows, _ = ml.cluster_items(table(spark, sf, "embeddings"), "embedding", dims=10)
    return rows.select("vec_id", F.col("cluster").cast("long").alias("cluster"))


@query("X9_train_embedding")
def train_embedding(spark, sf):
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    docs = texts(spark, sf, "conversations").select(words.alias("tokens"))
    partitions = ml.training_partitions(docs)
    model = ml.train_embedding(docs, size=16, min_count=20, epochs=1, partitions=partitions)
    return model.getVectors().select("word")
