"""The operators of this folder as queries over the given tables, with equivalent SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import ann, bpe, language_model, middle, ngram_join, packing, quality, secrets, spelling, token_output, tokens, url_filter, warc, winnow
from clickloom.llm.common import keyed, read, whole_text
from clickloom.session import materialise

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return wrap


@query("op1_byte_bpe")
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = keyed(read(spark, sf_dir, "documents"), "doc_id").select("doc_id", whole_text().alias("text"))
    coded = docs.select("doc_id", bpe.encode(F.col("text"), path, public_tokenizers.PATTERN).alias("ids"))
    return coded.select("doc_id", "ids", bpe.decode(F.col("ids"), path).alias("data")).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )


@query("op7_sum_of_squares_packing")
def op7_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(read(spark, sf_dir, "documents"))


END_MARK = (1).to_bytes(4, "little")


def end_marked_ids(docs: DataFrame) -> DataFrame:
    """(doc_id, ids): ids of the word vocabulary, then the end mark 1."""
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = keyed(docs, "doc_id").select("doc_id", tokens.token_ids(whole_text(), path).alias("ids"))
    return docs.select("doc_id", F.concat("ids", F.lit(END_MARK)).alias("ids"))


def packed_documents(docs: DataFrame, capacity: int = 4096) -> DataFrame:
    """Where every piece of every document goes."""
    pieces = packing.cut(end_marked_ids(docs), F.col("ids"), capacity, "doc_id")
    lengths = pieces.select("doc_id", "piece", "start", "length", F.crc32("piece_ids").alias("ids_crc32"))
    return packing.pack(lengths, capacity)


@query("op4_packed_token_rows")
def op4_packed_token_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = keyed(read(spark, sf_dir, "documents"), "doc_id").select("doc_id", whole_text().alias("text"))

    def encode(text: object) -> bytes:
        return tokens.tokenizer(path)(text) + END_MARK

    rows = materialise(token_output.pack_rows(docs, content="text", encode=encode), "token-rows")
    return token_output.segments(rows).select(
        "doc_id", "piece", "start", "length", F.crc32("segment_ids").alias("ids_crc32"), "sequence_id", "offset"
    )


@query("op3_byte_convolution_quality")
def op3_byte_convolution_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = keyed(read(spark, sf_dir, "documents"), "doc_id").select("doc_id", "text")
    model = quality.trained(docs, read(spark, sf_dir, "labels"))
    rated = docs.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), quality.score(F.col("text"), model).alias("score"))
    return rated.withColumn("predicted", (F.col("score") >= quality.KEEP).cast("int"))


def count_of(kind: str) -> F.Column:
    return F.size(F.filter("found", lambda s: s.kind == kind)).cast("long")


def span_list(spans: F.Column) -> F.Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))))


@query("op9_secret_spans")
def op9_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = keyed(read(spark, sf_dir, "documents"), "doc_id")
    found = docs.select("doc_id", secrets.secret_spans(F.col("text")).alias("found"))
    base = F.filter("found", lambda s: s.kind.isin(*secrets.BASE))
    counts = [count_of(kind).alias(f"n_{kind}") for kind in secrets.BASE]
    return found.select("doc_id", *counts, F.sha2(span_list(base), 256).alias("base_sha256"), span_list(F.col("found")).alias("spans"))


URL_RULES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
)

# no page of the given tables holds a canonical link or a refresh; tests/llm hold the aliases against brute force
URL_SQL = """
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages WHERE page_id IS NOT NULL),
h AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
rules(action, rule, rhost, rpath) AS (VALUES
  ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
  ('allow', 'www.example.com/en/', 'www.example.com', '/en/'), ('block', 'net/es/', 'net', '/es/'), ('block', 'net/fr/', 'net', '/fr/')),
f AS (
  SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(action, length(rule)) AS action
  FROM h JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
SELECT h.page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM h LEFT JOIN f USING (page_id)"""


@query("op5_url_aliases", URL_SQL)
def op5_url_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = keyed(read(spark, sf_dir, "pages"), "page_id").select("page_id", "url", "html")
    return url_filter.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages WHERE page_id IS NOT NULL),
d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND first <> page_id THEN first END AS refers_to FROM m"""


@query("op8_warc_round_trip", WARC_SQL)
def op8_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(read(spark, sf_dir, "pages"))
    records = warc.verified(warc.read_archives(archives, with_payload=False)).where("record_type in ('response', 'revisit')")
    return records.select(
        warc.page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.page_of(F.col("refers_to_id")).alias("refers_to"),
    )


@query("op10_winnowing")
def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = winnow.edited_pairs(read(spark, sf_dir, "documents"))
    rows = pairs.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        "entries", "edited_entries", F.col("next_hashes").alias("_next"),
        *(winnow.hashes(F.col(c)).cast("array<int>").alias(f"_{c}") for c in ("entries", "edited_entries")),
    )
    return rows.select(
        "doc_id", "n_chars", "edited_sha256",
        winnow.readable(F.col("entries")).alias("fingerprint"),
        winnow.readable(F.col("edited_entries")).alias("edited_fingerprint"),
        winnow.likeness(F.col("_entries"), F.col("_edited_entries")).alias("near_edited"),
        winnow.likeness(F.col("_entries"), F.col("_next")).alias("near_next"),
    )


@query("op2_kmeans_tree_neighbours")
def op2_kmeans_tree_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@query("op6_shingle_jaccard_join")
def op6_shingle_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(read(spark, sf_dir, "documents"))


@query("op11_letter_count_variants")
def op11_letter_count_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = keyed(read(spark, sf_dir, "documents"), "doc_id")
    return spelling.variant_groups(spelling.corpus_words(docs, F.col("text"), F.col("doc_id")))


MIDDLE_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id) AS s FROM documents WHERE doc_id IS NOT NULL),
u AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units,
         list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(s, CAST(i AS INTEGER), 8) AS BIGINT)) AS h FROM d),
c AS (
  SELECT *, len(units) AS n, least(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS a,
         greatest(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS b FROM u),
p AS (
  SELECT doc_id, text, n, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:n], '') AS suffix,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
              WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256 FROM p"""


@query("op12_fill_in_middle", MIDDLE_SQL)
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = keyed(read(spark, sf_dir, "documents"), "doc_id")
    cut = docs.select("doc_id", middle.fill_in_middle(F.col("text"), F.col("doc_id")).alias("cut")).select("doc_id", "cut.*")
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(middle.restore(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


@query("op13_recurrent_scores")
def op13_recurrent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = keyed(read(spark, sf_dir, "documents"), "doc_id")
    return language_model.document_scores(docs, F.col("text"), F.col("doc_id"))
