"""Keyword extraction from text: tokens, document frequencies, TF-IDF and language variants."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions import text as tx
from clickloom.operators.joins import salted_join
from clickloom.operators.ranking import top_k
from clickloom.session import materialise

NOT_FOUND = "xxx找不到xxx"

Tokens = Column | DataFrame
Extractor = Callable[[DataFrame, str, Tokens, DataFrame | None], DataFrame]


def explode_tokens(df: DataFrame, key: str, tokens: Tokens, stopwords: DataFrame | None = None, min_chars: int = 2) -> DataFrame:
    """(key, term, freq): term counts per document after short words and stopwords.

    ``tokens`` is an array column of ``df`` or a frame (key, term) with a row per word, as :func:`han_terms` gives.
    Counting starts inside the map task that holds the document, so only its distinct terms travel;
    stopwords are dropped from those.
    """
    listed = tokens.select(key, "term") if isinstance(tokens, DataFrame) else df.select(key, F.explode(tokens).alias("term"))
    words = listed.where(F.char_length("term") >= min_chars)
    counts = words.groupBy(key, "term").agg(F.count("*").alias("freq"))
    if stopwords is None:
        return counts
    # a frequent word is a hot key here: salted
    return salted_join(counts, stopwords.select(F.lower("word").alias("term")).distinct(), ["term"], "left_anti")


def count_with_totals(df: DataFrame, key: str, tokens: Column, min_chars: int = 2) -> DataFrame:
    """(key, term, freq, total): :func:`explode_tokens` and the sum of ``freq`` of the whole document.

    Totals are summed over the documents' rows, before these are taken apart.
    """
    words = df.select(key, F.filter(tokens, lambda w: F.char_length(w) >= min_chars).alias("_words"))
    sized = words.withColumn("total", F.sum(F.greatest(F.size("_words"), F.lit(0)).cast("long")).over(Window.partitionBy(key)))
    return sized.select(key, "total", F.explode("_words").alias("term")).groupBy(key, "total", "term").agg(F.count("*").alias("freq"))


def train_idf(terms: DataFrame, key: str = "id", denominator: str = "docs", rows: bool = False) -> DataFrame:
    """Inverse document frequency from (key, term, freq) rows.

    ``docs``: log10(documents / documents with the term). ``vocab``: log10(vocabulary size / term
    frequency). Terms with a blank are counted but not returned. With ``rows`` the count that IDF comes from stays.
    """
    if denominator == "docs":
        counts = terms.groupBy("term").agg(F.count("*").alias("_n"))
        top = terms.agg(F.countDistinct(key)).scalar()
    elif denominator == "vocab":
        counts = terms.groupBy("term").agg(F.sum("freq").alias("_n"))
        top = counts.agg(F.count("term")).scalar()  # the same shuffle serves both
    else:
        raise ValueError("denominator is 'docs' or 'vocab'")
    weighted = counts.withColumn("idf", F.log10(top / F.col("_n")))
    return weighted.where(~F.col("term").contains(" ")).select("term", "idf", *([F.col("_n").alias("rows")] if rows else []))


FREQUENT_TERMS = 1 << 17  # at most so many terms travel to the tasks (about 10 MB)


def _promising(scored: DataFrame, key: str, k: int) -> DataFrame:
    """Rows (key, term, score) without those that ``k`` better ones of the same document and batch rule out, unsorted.

    A row stays if its score is not clearly below the batch's k-th of the document, so ties are left to the ranking.
    """

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = batch.column(0).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            score = batch.column(2).to_numpy(zero_copy_only=False)
            order = np.lexsort((-score, groups))
            groups, score = groups[order], score[order]
            starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]) if len(order) else np.zeros(0, int)
            sizes = np.diff(np.r_[starts, len(order)])
            floor = np.repeat(np.where(sizes >= k, score[np.minimum(starts + k, starts + sizes) - 1], -np.inf), sizes)
            keep = np.zeros(len(order), bool)
            keep[order] = ~(score < floor - 2e-9)
            yield batch.filter(pa.array(keep))

    return scored.mapInArrow(prune, scored.schema)


def tfidf_keywords(
    terms: DataFrame, idf: DataFrame, k: int, key: str = "id", keep_term: Column | None = None
) -> DataFrame:
    """Top ``k`` terms of each document by share of the document times IDF, with their rank.

    Only terms for which ``keep_term`` (over ``term``) holds are ranked; the document's total counts all. ``terms`` is
    read several times: best is a stored table with totals (:func:`count_with_totals`), and an ``idf`` with ``rows``.

    Terms without an IDF get the upper median. Terms in at least rows / ``FREQUENT_TERMS`` rows, of which there are at
    most that many, travel to the tasks: their rows are scored in place and only a document's best go on. All others
    have few rows each and meet their IDF in a plain join.
    """
    if "total" not in terms.columns:
        terms = materialise(terms.withColumn("total", F.sum("freq").over(Window.partitionBy(key))), "terms")
    kept = F.lit(True) if keep_term is None else keep_term
    known = idf if "rows" in idf.columns else terms.groupBy("term").agg(F.count("*").alias("rows")).join(idf, "term")
    known = materialise(known.select("term", "idf", "rows", kept.alias("_kept")), "idf")  # terms are judged once
    median = known.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY idf DESC)")).scalar()
    if "rows" not in idf.columns:
        median = idf.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY idf DESC)")).scalar()
    often = F.col("rows") * FREQUENT_TERMS >= terms.agg(F.count("*")).scalar()
    frequent, rest = known.where(often).drop("rows"), known.where(~often).drop("rows")

    def scored(rows: DataFrame, weight: Column) -> DataFrame:
        return rows.select(key, "term", (F.col("freq") / F.col("total") * weight).alias("score"))

    in_place = scored(terms.join(F.broadcast(frequent), "term").where("_kept"), F.col("idf"))
    others = terms.join(F.broadcast(frequent.select("term")), "term", "left_anti").join(rest, "term", "left")
    others = scored(others.where(F.coalesce("_kept", kept)), F.coalesce("idf", median))
    # dealt before they are sorted: a sort ahead of the shuffle would prune next to nothing more
    dealt = _promising(in_place, key, k).unionByName(others).repartition(key)
    # scores are compared at nine digits so that equal terms tie and the term itself decides
    return top_k(dealt, [key], [F.desc(F.round("score", 9)), F.asc("term")], k, rank="rank")


def clean_tokens(
    tokens: DataFrame,
    word: str = "term",
    stopwords: Sequence[DataFrame] = (),
    tenant_black: DataFrame | None = None,
    quantifiers: Sequence[str] = tx.QUANTIFIERS,
) -> DataFrame:
    """Keyword cleaner on a token column: stopwords without case, blacklist, then noise shapes.

    ``tenant_black`` is (web_id, keyword).
    """
    kept = tokens.where(~tx.is_noise(F.col(word), quantifiers)).withColumn("_low", F.lower(word))
    for words in stopwords:
        kept = salted_join(kept, words.select(F.lower("word").alias("_low")).distinct(), ["_low"], "left_anti")
    if tenant_black is not None:
        black = tenant_black.select("web_id", F.lower("keyword").alias("_low")).distinct()
        kept = salted_join(kept, black, ["web_id", "_low"], "left_anti")
    return kept.drop("_low")


def in_dictionary(tokens: DataFrame, dictionary: DataFrame, word: str = "term") -> DataFrame:
    """Tokens listed for every tenant (``*``) or for their own tenant."""
    common = dictionary.where(F.col("web_id") == "*").select(F.col("keyword").alias(word)).distinct()
    own = dictionary.where(F.col("web_id") != "*").select("web_id", F.col("keyword").alias(word)).distinct()
    if "web_id" not in tokens.columns:
        return salted_join(tokens, common, [word], "left_semi")
    marked = salted_join(tokens, common.withColumn("_all", F.lit(True)), [word], "left")
    marked = salted_join(marked, own.withColumn("_own", F.lit(True)), ["web_id", word], "left")
    return marked.where(F.col("_all") | F.col("_own")).drop("_all", "_own")


def keyword_lists(ranked: DataFrame, key: str, k: int, word: str = "term", rank: str = "rank") -> DataFrame:
    """At most ``k`` keywords per document as an array, in rank order."""
    best = top_k(ranked, [key], [F.asc(rank)], k, rank="_r")
    ordered = F.sort_array(F.collect_list(F.struct("_r", word)))
    return best.groupBy(key).agg(ordered.alias("_s")).select(key, F.col(f"_s.{word}").alias("keyword_list"))


def article_keywords(
    articles: DataFrame, extracted: DataFrame, key: str = "id", policy: str = "v2", dictionary: DataFrame | None = None
) -> DataFrame:
    """Editorial keywords where an article has them (``is_cut`` 0), extracted ones otherwise (1).

    ``v1`` also extracts when the editorial list has fewer than two parts, and keeps only editorial
    keywords that the dictionary lists and the cleaner accepts.
    """
    editorial = tx.split_list(F.col("keywords"))
    cut = F.col("keywords").isNull() | F.col("keywords").isin("", "_")
    if policy == "v1":
        cut = cut | (F.size(F.split("keywords", ",")) < 2)
    elif policy != "v2":
        raise ValueError("policy is 'v1' or 'v2'")
    joined = (
        articles.withColumns({"_cut": cut, "_editorial": editorial})
        .join(extracted.select(key, "keyword_list"), key, "left")
        .withColumn("is_cut", F.col("_cut").cast("int"))
    )
    nothing = F.array().cast("array<string>")
    found = F.coalesce("keyword_list", nothing)
    if policy == "v1" and dictionary is not None:
        named = joined.where(~F.col("_cut")).select(key, "web_id", F.posexplode("_editorial").alias("rank", "term"))
        named = in_dictionary(named.where(~tx.is_noise(F.col("term"))), dictionary)
        ordered = F.sort_array(F.collect_list(F.struct("rank", "term")))
        checked = named.groupBy(key).agg(ordered.alias("_s")).select(key, F.col("_s.term").alias("_checked"))
        joined = joined.drop("_editorial").join(checked, key, "left")
        joined = joined.withColumn("_editorial", F.coalesce("_checked", nothing)).drop("_checked")
    return joined.withColumn("keyword_list", F.when(F.col("_cut"), found).otherwise(F.col("_editorial"))).drop(
        "_cut", "_editorial"
    )


def ngram_terms(df: DataFrame, key: str, tokens: Column, stopwords: DataFrame | None = None, n: int = 2) -> DataFrame:
    """Counted candidate phrases of 1..n words without stopwords inside."""
    words = df.select(key, tokens.alias("_w"))
    # a word travels with the one behind it: pairs need no join of positions
    placed = F.transform("_w", lambda w, i: F.struct(w.alias("_word"), F.get("_w", i + 1).alias("_next")))
    terms = words.select(key, F.explode(placed).alias("_p")).select(key, "_p.*").withColumn("_stop", F.lit(None).cast("boolean"))
    if stopwords is not None:
        listed = stopwords.select(F.lower("word").alias("_word")).distinct()
        terms = salted_join(terms.drop("_stop"), listed, ["_word"], "left_anti")
        terms = salted_join(terms, listed.select(F.col("_word").alias("_next"), F.lit(True).alias("_stop")), ["_next"], "left")
    single = F.struct(F.col("_word").alias("term"), F.lit(1).alias("words"))
    pair = F.struct(F.concat_ws(" ", "_word", "_next").alias("term"), F.lit(2).alias("words"))
    paired = F.col("_next").isNotNull() & F.col("_stop").isNull() & F.lit(n > 1)
    found = F.when(paired, F.array(single, pair)).otherwise(F.array(single))
    phrases = terms.select(key, F.explode(found).alias("_f")).select(key, "_f.*")
    return phrases.groupBy(key, "term", "words").agg(F.count("*").alias("freq"))


def frequent_phrases(df: DataFrame, key: str, tokens: Column, stopwords: DataFrame | None = None, n: int = 2, k: int = 20) -> DataFrame:
    """English variant: candidate phrases by count times length."""
    counted = ngram_terms(df, key, tokens, stopwords, n).withColumn("score", F.col("freq") * F.col("words"))
    return top_k(counted, [key], [F.desc("score"), F.asc("term")], k, rank="rank").select(key, "term", "rank")


def frequent_words(df: DataFrame, key: str, tokens: Tokens, stopwords: DataFrame | None = None, k: int = 10) -> DataFrame:
    """Indonesian variant: the most frequent words that are no stopwords."""
    counted = explode_tokens(df, key, tokens, stopwords)
    return top_k(counted, [key], [F.desc("freq"), F.asc("term")], k, rank="rank").select(key, "term", "rank")


def distinct_terms(df: DataFrame, key: str, tokens: Tokens, stopwords: DataFrame | None = None) -> DataFrame:
    """Vietnamese and Thai variant: every distinct word that is no stopword, in word order."""
    counted = explode_tokens(df, key, tokens, stopwords, min_chars=1)
    return counted.select(key, "term")


def han_terms(df: DataFrame, key: str, text: str, dictionary: DataFrame) -> DataFrame:
    """(key, term): the words of texts in Han script, cut by a dictionary (word, freq)."""
    return segment(df, key, text, dictionary).select(key, F.col("word").alias("term"))


def han_extractor(dictionary: DataFrame, text: str = "text", k: int = 10) -> Extractor:
    """Chinese variant for the registry: the most frequent dictionary words of two characters and more."""
    known = dictionary.select(F.lit("*").alias("web_id"), F.col("word").alias("keyword"))

    def extract(df: DataFrame, key: str, tokens: Tokens, stopwords: DataFrame | None = None) -> DataFrame:
        counted = in_dictionary(explode_tokens(df, key, han_terms(df, key, text, dictionary), stopwords), known)
        return top_k(counted, [key], [F.desc("freq"), F.asc("term")], k, rank="rank").select(key, "term", "rank")

    return extract


# extractor per language code; a caller adds or replaces entries to plug in its own, ``*`` is for all others
EXTRACTORS: dict[str, Extractor] = {
    "en": frequent_phrases,
    "id": frequent_words,
    "vi": distinct_terms,
    "th": distinct_terms,
    "*": frequent_words,
}


def keywords_by_language(
    df: DataFrame, key: str, tokens: Tokens, stopwords: DataFrame | None = None, lang: str = "lang",
    extractors: Mapping[str, Extractor] = EXTRACTORS,
) -> DataFrame:
    """(key, term) of every document by the extractor of its language, or by the one of ``*``."""
    named = [code for code in extractors if code != "*"]
    other = ~F.coalesce(F.col(lang).isin(*named), F.lit(False))
    parts = [
        extract(df.where(other if code == "*" else F.col(lang) == code), key, tokens, stopwords).select(key, "term")
        for code, extract in extractors.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def flexible_keywords(df: DataFrame, key: str, text: Column, extracted: DataFrame, limit: float = 0.8) -> DataFrame:
    """Short comma pieces as they are when most are short, else extracted keywords, else a placeholder."""
    pieces = tx.short_pieces(text)
    joined = df.withColumn("_pieces", pieces).join(extracted.select(key, "keyword_list"), key, "left")
    empty = F.array().cast("array<string>")
    chosen = F.when(tx.short_share(F.col("_pieces")) > limit, F.col("_pieces")).otherwise(
        F.coalesce("keyword_list", empty)
    )
    placed = joined.withColumn("keyword_list", F.when(F.size(chosen) > 0, chosen).otherwise(F.array(F.lit(NOT_FOUND))))
    return placed.drop("_pieces")


TRIE_WORDS = 1 << 19  # a dictionary of so many words (about 100 MB in a worker) is walked as a trie
TRIE_TEXTS = 64  # texts whose words are Python strings at the same time


def _best_split(run: str, options: list[list[tuple[int, float]]]) -> list[str]:
    """Most probable split of one run; ``options`` has (size, log) of the words that start at each character."""
    best = [0.0] * (len(run) + 1)
    step = [1] * len(run)
    for i in range(len(run) - 1, -1, -1):
        best[i], step[i] = max((log + best[i + size], size) for size, log in options[i])
    words, i = [], 0
    while i < len(run):
        words.append(run[i : i + step[i]])
        i += step[i]
    return words


class DictionaryTrie:
    """Words with their log shares; a run is walked once, whatever the lengths of the words.

    The trie is built once per worker process and dictionary. An unknown single character weighs ``unknown``.
    """

    built: dict[str, ahocorasick.Automaton] = {}

    def __init__(self, logs: dict[str, float], unknown: float) -> None:
        self.logs, self.unknown = logs, unknown
        self.name = hashlib.md5(repr(sorted(logs.items())).encode()).hexdigest()

    def automaton(self) -> ahocorasick.Automaton:
        found = self.built.get(self.name)
        if found is None:
            found = ahocorasick.Automaton()
            for word, log in self.logs.items():
                found.add_word(word, (len(word), log))
            if self.logs:
                found.make_automaton()
            self.built.clear()
            self.built[self.name] = found
        return found

    def split(self, run: str) -> list[str]:
        options: list[list[tuple[int, float]]] = [[] for _ in run]
        for last, (size, log) in self.automaton().iter(run) if self.logs else ():
            options[last + 1 - size].append((size, log))
        for i, character in enumerate(run):
            if character not in self.logs:
                options[i].append((1, self.unknown))
        return _best_split(run, options)


def _by_trie(df: DataFrame, key: str, runs: Column, trie: DictionaryTrie) -> DataFrame:
    """Every text's runs are split where they are: nothing is shuffled. A worker holds the words of a few texts at a time."""
    kind = T.StructType([df.schema[key], T.StructField("_words", T.ArrayType(T.ArrayType(T.StringType())))])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TRIE_TEXTS):
                some = batch.slice(at, TRIE_TEXTS)
                words = [[trie.split(run) for run in found] for found in some.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(words, pa.list_(pa.list_(pa.string())))], names=[key, "_words"])

    found = df.select(key, F.coalesce(runs, F.array().cast("array<string>")).alias("_runs"))
    split_runs = found.mapInArrow(split, kind).select(key, F.posexplode("_words").alias("run_no", "_words"))
    return split_runs.select(key, "run_no", F.posexplode("_words").alias("word_no", "word"))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _split_candidates(run: pd.Series, start: pd.Series, size: pd.Series, log: pd.Series) -> pd.Series:
    def split(run: str, starts: list[int], sizes: list[int], logs: list[float]) -> list[str]:
        options: list[list[tuple[int, float]]] = [[] for _ in run]
        for at, length, value in zip(starts, sizes, logs):
            options[at - 1].append((length, value))
        return _best_split(run, options)

    return pd.Series([split(*row) for row in zip(run, start, size, log)], dtype=object)


def _by_join(df: DataFrame, key: str, runs: Column, weighted: DataFrame, unknown: float) -> DataFrame:
    """For dictionaries of any size: substrings of distinct runs meet the dictionary in a join.

    Substrings carry the number of their run, and frequent ones are salted.
    """
    placed = df.select(key, F.posexplode(runs).alias("run_no", "_run"))
    distinct = materialise(placed.select("_run").distinct().withColumn("_id", F.monotonically_increasing_id()), "runs")
    sizes = sorted({1, *(r[0] for r in weighted.select(F.char_length("word")).distinct().collect())})  # lengths, not words
    length = F.char_length("_run")
    starts = distinct.withColumn("_start", F.explode(F.sequence(F.lit(1), length)))
    pieces = starts.withColumn("_size", F.explode(F.array(*map(F.lit, sizes)))).where(F.col("_size") <= length - F.col("_start") + 1)
    pieces = pieces.select("_id", "_start", "_size", F.substring(F.col("_run"), F.col("_start"), F.col("_size")).alias("word"))
    found = salted_join(pieces, weighted, ["word"], "left").where(F.col("_log").isNotNull() | (F.col("_size") == 1))
    candidates = F.sort_array(F.collect_list(F.struct("_start", "_size", F.coalesce("_log", F.lit(unknown)).alias("_log"))))
    grouped = distinct.join(found.groupBy("_id").agg(candidates.alias("_c")), "_id")
    split = grouped.select("_run", _split_candidates("_run", "_c._start", "_c._size", "_c._log").alias("_words"))
    return placed.join(split, "_run").select(key, "run_no", F.posexplode("_words").alias("word_no", "word"))


def segment(
    df: DataFrame, key: str, text: str, dictionary: DataFrame, run: str = tx.HAN, trie_words: int = TRIE_WORDS
) -> DataFrame:
    """Maximum-probability dictionary segmentation, one row (key, run_no, word_no, word) per word.

    ``dictionary`` is (word, freq); words may have any length, and of several equally probable splits the one with
    the longer word first counts. Up to ``trie_words`` words travel to the tasks as a trie; a larger dictionary is
    joined, with the same result. Null and empty texts have no rows.
    """
    runs = F.regexp_extract_all(text, F.lit(f"({run})"), 1)
    total = dictionary.agg(F.sum("freq")).first()[0] or 1
    known = dictionary.where(F.col("freq") > 0).groupBy("word").agg(F.max("freq").alias("freq"))
    weighted = known.select("word", F.ln(F.col("freq") / total).alias("_log")).where("word <> ''")
    some = weighted.limit(trie_words + 1).collect()
    if len(some) > trie_words:
        return _by_join(df, key, runs, weighted, -math.log(total))
    return _by_trie(df, key, runs, DictionaryTrie({r["word"]: r["_log"] for r in some}, -math.log(total)))
