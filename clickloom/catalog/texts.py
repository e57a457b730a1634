"""Keyword extraction and keyword reports over whole texts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from clickloom.catalog.aggregates import TOKENS, doc_terms
from clickloom.catalog.functions import PAGES_SQL, tenant_pages, url_rules
from clickloom.catalog.joins import similar_items
from clickloom.catalog.registry import ORACLES, query, with_
from clickloom.catalog.tables import DOCS, docs, table, texts
from clickloom.functions import text as tx
from clickloom.functions import urls
from clickloom.operators import joins, keywords, reports
from clickloom.operators.similarity import catalogue_text
from clickloom.sources.logs import spread_by

TODAY = dt.date(2024, 1, 31)


@query(
    "X1_tokens",
    r"""SELECT doc_id, len(w) AS tokens, md5(array_to_string(w, ' ')) AS digest FROM (SELECT doc_id,
  list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents)""",
)
def tokens(spark, sf):
    words = tx.latin_tokens(F.col("text"))
    return texts(spark, sf).select(
        "doc_id", F.size(words).cast("long").alias("tokens"), F.md5(F.array_join(words, " ")).alias("digest")
    )


def benchmark_words(spark, sf):
    """Benchmark words as a dictionary with their counts."""
    words = table(spark, sf, "benchmark").select(F.explode(tx.latin_tokens(F.col("text"))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("freq"))


def turns(spark, sf):
    return texts(spark, sf, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("id"), F.lower("text").alias("text"))


RUNS = r"""dict AS (SELECT DISTINCT unnest(string_split_regex(lower(text), '[^\p{L}\p{N}]+')) AS word FROM benchmark),
turns AS (SELECT concat_ws('-', conv_id, turn) AS id, regexp_extract_all(lower(text), '\p{L}+') AS runs FROM conversations),
placed AS (SELECT id, unnest(runs) AS run, unnest(range(len(runs))) AS run_no FROM turns)"""


@query(
    "X1_segment",
    with_(RUNS, select="SELECT id, CAST(run_no AS INTEGER) AS run_no, run, TRUE AS all_known FROM placed"),
)
def segment(spark, sf):
    """Dictionary segmentation of whole texts, its words put together again; letters stand in for Han."""
    dictionary = benchmark_words(spark, sf)
    words = keywords.segment(turns(spark, sf), "id", "text", dictionary, run=r"\p{L}+")
    listed = dictionary.select("word", F.lit(True).alias("listed"))
    known = F.coalesce("listed", F.char_length("word") == 1)
    ordered = F.sort_array(F.collect_list(F.struct("word_no", "word")))
    runs = joins.salted_join(words, listed, ["word"], "left").withColumn("known", known).groupBy("id", "run_no").agg(
        F.array_join(F.transform(ordered, lambda w: w.word), "").alias("run"), F.bool_and("known").alias("all_known")
    )
    return runs.select("id", "run_no", "run", "all_known")


@query(
    "X1_segment_whole_words",
    with_(
        RUNS,
        select="""SELECT p.id, CAST(p.run_no AS INTEGER) AS run_no, p.run AS word FROM placed p JOIN dict d ON d.word = p.run""",
    ),
)
def segment_whole_words(spark, sf):
    """Runs that the best split leaves whole. A word of the dictionary always is: it has more weight than any split of
    itself, as every part has at most all of the weight."""
    dictionary = benchmark_words(spark, sf).withColumn("freq", F.lit(1))
    words = keywords.segment(turns(spark, sf), "id", "text", dictionary, run=r"\p{L}+")
    whole = words.groupBy("id", "run_no").agg(F.count("*").alias("n"), F.min("word").alias("word")).where("n = 1")
    return joins.salted_join(whole.drop("n"), dictionary.select("word"), ["word"], "left_semi").select("id", "run_no", "word")


LETTERS, HAN_LETTERS = "abcdefghijklmnopqrstuvwxyz", "".join(chr(0x4E00 + 97 * i) for i in range(26))


@query("X2_han_keywords")
def han_keywords(spark, sf):
    """Conversations and a dictionary written in 26 Han characters: cut by the dictionary, then ranked by TF-IDF."""

    def in_han(text):
        return F.translate(text, LETTERS, HAN_LETTERS)

    words = benchmark_words(spark, sf).where(F.col("word").rlike("^[a-z]+$")).withColumn("word", in_han("word"))
    rows = turns(spark, sf).withColumn("text", in_han("text"))
    terms = keywords.explode_tokens(rows, "id", keywords.han_terms(rows, "id", "text", words))
    return keywords.tfidf_keywords(terms, keywords.train_idf(terms), 10, keep_term=~tx.is_noise(F.col("term"))).select("id", "term", "rank")


IDF = """idf AS (SELECT term, log10(CAST((SELECT count(DISTINCT id) FROM terms) AS DOUBLE) / count(*)) AS idf FROM terms GROUP BY term)"""
SCORED = """tot AS (SELECT id, sum(freq) AS total FROM terms GROUP BY 1),
scored AS (SELECT t.id, t.term, CAST(freq AS DOUBLE) / CAST(total AS DOUBLE) * i.idf AS score FROM terms t JOIN tot USING (id) JOIN idf i USING (term)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(score, 9) DESC, term) AS rk FROM scored)"""


@query(
    "X2_tfidf_keywords",
    with_(TOKENS, IDF, SCORED, select="SELECT id, term, CAST(rk AS INTEGER) AS rank FROM ranked WHERE rk <= 10"),
)
def tfidf_keywords(spark, sf):
    terms = doc_terms(spark, sf, totals=True)
    return keywords.tfidf_keywords(terms, keywords.train_idf(terms, rows=True), 10).select("id", "term", "rank")


def extracted_lists(spark, sf, keep=5):
    """Terms are cleaned first and ranked then; inverse frequencies and totals are those of all terms."""
    terms = doc_terms(spark, sf, totals=True)
    ranked = keywords.tfidf_keywords(terms, keywords.train_idf(terms, rows=True), keep, keep_term=~tx.is_noise(F.col("term")))
    return keywords.keyword_lists(ranked, "id", keep)


LISTS = r"""noise AS (SELECT * FROM ranked WHERE NOT regexp_full_match(term, '[0-9]{2}|[0-9.]*|[a-z]{1,4}|[A-Z]{2}')
  AND NOT regexp_full_match(term, '[0-9.]*(萬|萬元|點|元|億|億元|百萬|千萬|分|分鐘|樓|成|吋|天|號|日|月|年|輛|種|次|人|%|g|cc|ml|克糖|倍|個|招|kg|jpg|JPG|折|度|公尺|大|例)')),
lists AS (SELECT id, string_agg(term, ',' ORDER BY rk) AS kws FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY rk) AS n FROM noise)
  WHERE n <= 5 GROUP BY id)"""


@query(
    "X3_article_keywords",
    with_(
        DOCS, TOKENS, IDF, SCORED, LISTS,
        select="""SELECT d.article_id, CASE WHEN keywords IN ('', '_') THEN 1 ELSE 0 END AS is_cut,
  CASE WHEN keywords IN ('', '_') THEN COALESCE(kws, '') ELSE replace(keywords, ' , ', ',') END AS keywords FROM docs d LEFT JOIN lists USING (id)""",
    ),
)
def article_keywords(spark, sf):
    rows = keywords.article_keywords(docs(spark, sf), extracted_lists(spark, sf))
    return rows.select("article_id", "is_cut", F.array_join("keyword_list", ",").alias("keywords"))


@query(
    "X3_article_keywords_v1",
    with_(
        DOCS, TOKENS, IDF, SCORED, LISTS,
        select="""SELECT d.article_id, CASE WHEN keywords IN ('', '_') THEN 1 ELSE 0 END AS is_cut,
  CASE WHEN keywords IN ('', '_') THEN COALESCE(kws, '') ELSE COALESCE(e.kept, '') END AS keywords FROM docs d LEFT JOIN lists USING (id)
  LEFT JOIN (SELECT id, string_agg(k, ',' ORDER BY pos) AS kept FROM (
    SELECT id, web_id, pos, trim(string_split(keywords, ',')[pos]) AS k FROM docs, (SELECT unnest(range(1, 4)) AS pos) WHERE keywords <> '_')
    WHERE k IN ('quality1', 'toxic0') OR (k = web_id AND k IN (SELECT 'src' || n_nationkey FROM nation)) GROUP BY id) e USING (id)""",
    ),
)
def article_keywords_v1(spark, sf):
    named = table(spark, sf, "nation").select(F.concat(F.lit("src"), F.col("n_nationkey").cast("string")).alias("keyword"))
    own = named.select(F.col("keyword").alias("web_id"), "keyword")
    common = table(spark, sf, "labels").select(
        F.lit("*").alias("web_id"), F.explode(F.array(F.lit("quality1"), F.lit("toxic0"))).alias("keyword")
    ).distinct()
    dictionary = own.unionByName(common)
    rows = keywords.article_keywords(docs(spark, sf), extracted_lists(spark, sf), policy="v1", dictionary=dictionary)
    return rows.select("article_id", "is_cut", F.array_join("keyword_list", ",").alias("keywords"))


def by_language(spark, sf, *langs):
    rows = table(spark, sf, "documents").where(F.col("lang").isin(*langs))
    return spread_by(rows.select(F.col("doc_id").alias("id"), "text"), "id")


STOP = r"stop AS (SELECT DISTINCT unnest(string_split_regex(lower(text), '[^\p{L}\p{N}]+')) AS word FROM benchmark)"


def stop_rows(spark, sf):
    return table(spark, sf, "benchmark").select(F.explode(tx.latin_tokens(F.col("text"))).alias("word"))


@query(
    "X3b_frequent_phrases",
    with_(
        STOP,
        r"""w AS (SELECT doc_id AS id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS ws FROM documents WHERE lang = 'en'),
pos AS (SELECT id, unnest(ws) AS word, unnest(range(len(ws))) AS p FROM w),
ok AS (SELECT * FROM pos WHERE word NOT IN (SELECT word FROM stop)),
cand AS (SELECT id, word AS term, 1 AS words FROM ok UNION ALL
  SELECT a.id, a.word || ' ' || b.word, 2 FROM ok a JOIN ok b ON a.id = b.id AND b.p = a.p + 1),
cnt AS (SELECT id, term, words, count(*) * words AS score FROM cand GROUP BY 1, 2, 3)""",
        select="""SELECT id, term, CAST(rk AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, term) AS rk FROM cnt)
  WHERE rk <= 20""",
    ),
)
def frequent_phrases(spark, sf):
    return keywords.frequent_phrases(by_language(spark, sf, "en"), "id", tx.latin_tokens(F.col("text")), stop_rows(spark, sf))


@query(
    "X3b_frequent_words",
    with_(
        STOP,
        r"""cnt AS (SELECT id, term, count(*) AS freq FROM (SELECT doc_id AS id, unnest(string_split_regex(lower(text), '[^\p{L}\p{N}]+')) AS term
  FROM documents WHERE lang IN ('de', 'es')) WHERE length(term) >= 2 AND term NOT IN (SELECT word FROM stop) GROUP BY 1, 2)""",
        select="""SELECT id, term, CAST(rk AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY freq DESC, term) AS rk FROM cnt)
  WHERE rk <= 10""",
    ),
)
def frequent_words(spark, sf):
    return keywords.frequent_words(by_language(spark, sf, "de", "es"), "id", tx.latin_tokens(F.col("text")), stop_rows(spark, sf))


@query(
    "X3b_distinct_terms",
    with_(
        STOP,
        select=r"""SELECT DISTINCT id, term FROM (SELECT doc_id AS id, unnest(string_split_regex(lower(text), '[^\p{L}\p{N}]+')) AS term
  FROM documents WHERE lang = 'fr') WHERE term <> '' AND term NOT IN (SELECT word FROM stop)""",
    ),
)
def distinct_terms(spark, sf):
    return keywords.distinct_terms(by_language(spark, sf, "fr"), "id", tx.latin_tokens(F.col("text")), stop_rows(spark, sf))


@query(
    "X6_catalogue_keywords",
    """SELECT web_id, product_id, keyword, count(*) AS n FROM (SELECT p_brand AS web_id, CAST(p_partkey AS VARCHAR) AS product_id,
  unnest(string_split(replace(translate(p_name || '-' || p_partkey || ' ' || p_type, '-!.~&+_～:，/', ''), CAST(p_partkey AS VARCHAR), ''), ' ')) AS keyword FROM part)
  WHERE length(keyword) > 1 AND lower(keyword) NOT IN (SELECT lower(p_type) FROM part WHERE p_size > 48) GROUP BY 1, 2, 3""",
)
def catalogue_keywords(spark, sf):
    part = table(spark, sf, "part")
    product = F.col("p_partkey").cast("string")
    title = F.concat(F.col("p_name"), F.lit("-"), product, F.lit(" "), F.col("p_type"))
    split = part.select(
        F.col("p_brand").alias("web_id"), product.alias("product_id"),
        F.explode(F.split(catalogue_text(title, product), " ")).alias("keyword"),
    )
    split = split.where(F.char_length("keyword") > 1)
    stop = part.where(F.col("p_size") > 48).select(F.lower("p_type").alias("_low")).distinct()
    kept = split.withColumn("_low", F.lower("keyword")).join(stop, "_low", "left_anti")
    return kept.groupBy("web_id", "product_id", "keyword").agg(F.count("*").alias("n"))


@query(
    "X8_flexible_keywords",
    with_(
        TOKENS, IDF, SCORED,
        """top6 AS (SELECT id, string_agg(term, ',' ORDER BY rk) AS kws FROM ranked WHERE rk <= 6 GROUP BY id),
pieces AS (SELECT doc_id AS id, list_filter(string_split(replace(lang || ',' || source || (CASE WHEN doc_id % 2 = 0 THEN '' ELSE ',' || text END), '，', ','), ','),
  lambda x: x <> '') AS w FROM documents)""",
        select="""SELECT id, md5(CASE WHEN CAST(len(list_filter(w, lambda x: length(x) <= 4)) AS DOUBLE) / len(w) > 0.8 THEN array_to_string(w, ',')
  ELSE COALESCE(kws, 'xxx找不到xxx') END) AS digest FROM pieces LEFT JOIN top6 USING (id)""",
    ),
)
def flexible_keywords(spark, sf):
    rows = table(spark, sf, "documents").withColumnRenamed("doc_id", "id")
    body = F.when(F.col("id") % 2 == 0, F.lit("")).otherwise(F.concat(F.lit(","), F.col("text")))
    text = F.concat(F.col("lang"), F.lit(","), F.col("source"), body)
    terms = doc_terms(spark, sf, totals=True)
    six = keywords.keyword_lists(keywords.tfidf_keywords(terms, keywords.train_idf(terms, rows=True), 6), "id", 6)
    found = keywords.flexible_keywords(rows, "id", text, six)
    return found.select("id", F.md5(F.array_join("keyword_list", ",")).alias("digest"))


@query(
    "X17_query_product_rank",
    f"""WITH {PAGES_SQL}, signed AS (SELECT page_id, p.web_id, CASE WHEN r.web_id IS NULL THEN '_'
  WHEN length(p.web_id) % 3 = 0 AND regexp_matches(url, '/([a-z]{{2}})/([0-9]+)') THEN regexp_extract(url, '/([a-z]{{2}})/([0-9]+)', 2)
  WHEN length(p.web_id) % 3 = 2 THEN CASE WHEN octet_length(encode(lower(url))) > 60 THEN sha256(lower(url)) ELSE lower(url) END
  ELSE p.web_id END AS product_id, length(html) AS clicks FROM p LEFT JOIN rules r USING (web_id)),
sim AS (SELECT l_partkey AS main, l_suppkey AS other, max(l_discount) * 10 AS score FROM lineitem GROUP BY 1, 2),
rs AS (SELECT *, row_number() OVER (PARTITION BY main ORDER BY score DESC, other) AS rk FROM sim WHERE score <> 1),
wide AS (SELECT CAST(main AS VARCHAR) AS product_id, max(CASE WHEN rk = 1 THEN other END) AS sim1, max(CASE WHEN rk = 2 THEN other END) AS sim2,
  max(CASE WHEN rk = 3 THEN other END) AS sim3 FROM rs WHERE rk <= 3 GROUP BY 1 HAVING count(*) = 3),
one AS (SELECT * FROM (SELECT *, 'q' || page_id AS query, row_number() OVER (PARTITION BY web_id, product_id ORDER BY clicks DESC, 'q' || page_id) AS n
  FROM signed WHERE clicks > 1 AND product_id NOT IN ('_', web_id)) WHERE n = 1)
SELECT web_id, product_id, query, clicks, sim1, sim2, sim3,
  CAST(row_number() OVER (PARTITION BY web_id ORDER BY clicks DESC, product_id) AS INTEGER) AS rank FROM one JOIN wide USING (product_id)""",
)
def query_product_rank(spark, sf):
    sizes = table(spark, sf, "pages").select(
        "page_id", F.char_length("html").cast("long").alias("clicks"), F.concat(F.lit("q"), F.col("page_id").cast("string")).alias("query")
    )
    signed = urls.url_signature(
        tenant_pages(spark, sf), url_rules(spark, sf), out="product_id", ignore_case=True, prefix=False
    ).join(sizes, "page_id")
    pages = signed.select("web_id", "query", "product_id", "clicks")
    everywhere = similar_items(spark, sf).groupBy("main_product_id", "similarity_product_id").agg(
        F.max("text_similarity").alias("text_similarity")
    )
    similar = joins.top_similar(everywhere.withColumn("web_id", F.lit("all")), products=None)
    similar = similar.select(F.col("main_product_id").cast("string").alias("product_id"), "sim1", "sim2", "sim3")
    tenants = signed.select("web_id").distinct()
    every = similar.join(pages.select("web_id", "product_id").distinct(), "product_id")
    return reports.query_product_rank(pages, every.join(tenants, "web_id", "left_semi"))


@query(
    "X18_merge_vocab",
    """SELECT DISTINCT array_to_string(string_split(line, ' ')[1:2], ' ') AS line FROM (
  SELECT p_name || ' ' || p_size AS line FROM part UNION ALL SELECT p_type || ' ' || p_size || ' n' FROM part
  UNION ALL SELECT n_name || ' ' || n_regionkey || ' place' FROM nation) WHERE len(string_split(line, ' ')) = 3""",
)
def merge_vocab(spark, sf):
    part, nation = table(spark, sf, "part"), table(spark, sf, "nation")
    return reports.merge_vocab(
        part.select(F.concat_ws(" ", "p_name", "p_size").alias("line")),
        part.select(F.concat_ws(" ", "p_type", "p_size", F.lit("n")).alias("line")),
        nation.select(F.concat_ws(" ", "n_name", "n_regionkey", F.lit("place")).alias("line")),
    ).distinct()


def metric_rows(spark, sf):
    """Orders as keyword metrics: the customer is the keyword, the order month the metric month."""
    day = F.to_date("o_orderdate")
    return table(spark, sf, "orders").select(
        F.concat(F.lit("kw "), F.col("o_custkey").cast("string")).alias("keyword_ask"),
        F.concat(F.lit("kw"), F.col("o_custkey").cast("string")).alias("keyword_join"),
        F.floor("o_totalprice").cast("long").alias("monthly_traffic"),
        F.year(day).alias("year"), F.month(day).alias("month"), day.alias("date"),
        F.when(F.col("o_orderstatus") == "P", 0).otherwise(1).alias("google_available"),
    )


@query(
    "X19_backfill_missing",
    """WITH got AS (SELECT DISTINCT 'kw ' || o_custkey AS keyword_ask, 'kw' || o_custkey AS keyword_join FROM orders),
asked AS (SELECT DISTINCT 'kw ' || c_custkey AS keyword_ask FROM customer)
SELECT keyword_ask, keyword_join, 1 AS google_available FROM got UNION ALL
SELECT keyword_ask, replace(keyword_ask, ' ', ''), 0 FROM asked WHERE keyword_ask NOT IN (SELECT keyword_ask FROM got)""",
)
def backfill_missing(spark, sf):
    asked = table(spark, sf, "customer").select(F.concat(F.lit("kw "), F.col("c_custkey").cast("string")).alias("keyword_ask"))
    returned = metric_rows(spark, sf).select("keyword_ask", "keyword_join").distinct()
    rows = reports.backfill_missing(asked, returned, TODAY)
    return rows.select("keyword_ask", "keyword_join", "google_available")


@query(
    "X20_refresh_due",
    """WITH h AS (SELECT 'kw ' || o_custkey AS keyword_ask, CAST(floor(o_totalprice) AS BIGINT) AS t, CAST(o_orderdate AS DATE) AS d
  FROM orders WHERE o_orderstatus <> 'P')
SELECT keyword_ask, max(t) AS monthly_traffic FROM h WHERE d < DATE '2000-10-15' AND keyword_ask NOT IN
  (SELECT keyword_ask FROM h WHERE year(d) = 2000 AND month(d) = 11) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50""",
)
def refresh_due(spark, sf):
    return reports.refresh_due(metric_rows(spark, sf), dt.date(2001, 1, 15), 50)


def _language_sql():
    parts = [ORACLES[n] for n in ("X3b_frequent_phrases", "X3b_frequent_words", "X3b_distinct_terms")]
    return " UNION ALL ".join(f"SELECT id, term FROM ({sql})" for sql in parts)


@query("UD3_language_extractors", _language_sql())
def language_extractors(spark, sf):
    """The extractor registry with the languages of the given documents."""
    table_of = {
        "en": keywords.frequent_phrases, "de": keywords.frequent_words, "es": keywords.frequent_words,
        "fr": keywords.distinct_terms,
    }
    rows = spread_by(table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text", "lang"), "id")
    return keywords.keywords_by_language(
        rows, "id", tx.latin_tokens(F.col("text")), stop_rows(spark, sf), extractors=table_of
    )
