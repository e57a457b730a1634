"""Log-likelihood of whole documents under a recurrent language model of the corpus (the network is in ``recurrent``).

Words are what white space separates, A-Z in lower case; every document ends with one end, which counts as a token.

1. All training documents are counted: one row per distinct word of the corpus.
2. The ``SYMBOLS`` that the network predicts are the end, the most frequent words and ``ENDINGS`` groups of all other
   words by their last two characters. Within its group a word has the share ``(c + 1) / (N + V + 1)`` of the group's
   occurrences and distinct words, so unseen words of any number share one place.
3. Every document is stored as symbols, and training goes over every training document once: in rounds of falling
   rate, in which each task goes on from the last round's weights with its own documents. Between rounds the changes
   are averaged by how often a task met what they belong to.
4. Every document is scored with the state carried through it to its end.

Counts of the ``KNOWN`` most frequent words (of at most ``KNOWN_BYTES`` bytes) travel to the tasks; all other words of a
document meet their counts in a join, so results cover the whole vocabulary. Known words, weights and the group table
have fixed sizes; counts, stored symbols, joined words and weights per task grow with the corpus.

Edge cases: null counts as empty; an empty text is one end; rows that repeat are scored each; without training documents
all counts are zero and the network stays as it was drawn; rows without an id are left out by the query.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm import recurrent
from clickloom.session import materialise

END = "\n"  # no word holds white space
SYMBOLS, ENDINGS = 4096, 256
KNOWN, KNOWN_BYTES = 1 << 17, 64
SHARD = 1 << 22  # tokens that a task trains on or scores at once
ROUNDS = ((0, 1, 0.06), (1, 3, 0.04), (3, 8, 0.03))  # eighths of the training documents, and the rate
FAN_IN = 32
FLUSH = 1 << 18


def words_of(text: bytes) -> list[bytes]:
    """Bytes have white space and letter case in ASCII only, which are the two that count here."""
    return text.lower().split()


def held_out(key: Column) -> Column:
    """The seventh of the documents that nothing is learned from."""
    return F.crc32(key.cast("string").cast("binary")) % 7 == 2


def utf8(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")


# counts


def word_counts(texts: DataFrame, text: Column) -> DataFrame:
    """(word, n) of all texts; the end has a row of its own."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for data in batch.column(0):
                found.update(words_of(data.as_py()))
                if len(found) > FLUSH:
                    yield rows()
                    found.clear()
            found[END.encode()] += batch.num_rows
        if found:
            yield rows()

    counted = texts.select(utf8(text).alias("text")).mapInArrow(count, "word binary, n long")
    return counted.where("n > 0").groupBy(F.col("word").cast("string").alias("word")).agg(F.sum("n").alias("n"))


def ending(word: Column) -> Column:
    return F.crc32(F.substring(word, -2, 2).cast("binary")) % ENDINGS


def ending_of(word: bytes) -> int:
    return zlib.crc32(word[-8:].decode("utf-8", "ignore")[-2:].encode()) % ENDINGS


def least_known(counts: DataFrame, known: int) -> Column:
    """The words whose counts travel: at most ``known`` short ones, by a histogram of the counts' magnitudes."""
    short = F.octet_length("word") <= KNOWN_BYTES
    size = F.floor(F.log2("n") * 16).alias("size")
    sizes = counts.where(short).groupBy(size).agg(F.count("*").alias("words")).orderBy(F.desc("size")).collect()
    least, total = None, 0
    for row in sizes:
        total += row["words"]
        if total > known:
            break
        least = row["size"]
    return (short & (F.floor(F.log2("n") * 16) >= least)) if least is not None else F.lit(False)


@dataclass
class Vocabulary:
    """What every task knows; of bounded size."""

    index: dict[bytes, int]  # known words
    symbol: np.ndarray  # by index
    log_count: np.ndarray  # by index: log10(c + 1)
    in_group: np.ndarray  # by index: log10 of the share within its group; 0 for words that are symbols
    group_symbol: np.ndarray  # by ending
    group_log: np.ndarray  # by ending: log10 of the denominator of the shares
    counts: np.ndarray  # by symbol, falling
    end: int
    end_log: float
    tokens: int
    distinct: int

    @classmethod
    def of(cls, known: pd.DataFrame, groups: pd.DataFrame, tokens: int, distinct: int, end_count: int) -> Vocabulary:
        known = known.sort_values(["n", "word"], ascending=[False, True])
        words = [w.encode() for w in known["word"]]
        n = known["n"].to_numpy(np.int64)
        named = min(len(words), SYMBOLS - ENDINGS - 1)
        endings = np.array([ending_of(w) for w in words], np.int64)
        inside, kinds = np.zeros(ENDINGS, np.int64), np.zeros(ENDINGS, np.int64)
        inside[groups["ending"]], kinds[groups["ending"]] = groups["n"], groups["words"]
        inside -= np.bincount(endings[:named], n[:named], ENDINGS).astype(np.int64)
        kinds -= np.bincount(endings[:named], minlength=ENDINGS)
        all_counts = np.concatenate([n[:named], inside, [end_count]])
        order = np.argsort(-all_counts, kind="stable")
        place = np.empty(len(order), np.uint16)
        place[order] = np.arange(len(order))
        group_symbol, group_log = place[named : named + ENDINGS], np.log10(inside + kinds + 1)
        rest = np.arange(len(words)) >= named
        symbol = np.where(rest, group_symbol[endings], np.r_[place[:named], np.zeros(len(words) - named, np.uint16)])
        log_count = np.log10(n + 1.0)
        return cls(
            {w: i for i, w in enumerate(words)}, symbol.astype(np.uint16), log_count, np.where(rest, log_count - group_log[endings], 0.0),
            group_symbol, group_log, all_counts[order], int(place[-1]), float(np.log10(end_count + 1)), tokens, distinct,
        )

    @property
    def base_log(self) -> float:
        return float(np.log10(self.tokens + self.distinct + 1))


def vocabulary(counts: DataFrame, known: Column) -> Vocabulary:
    """From stored counts: the known words, and sums over all words."""
    words = counts.where(F.col("word") != END)
    groups = words.groupBy(ending(F.col("word")).cast("int").alias("ending")).agg(F.sum("n").alias("n"), F.count("*").alias("words")).toPandas()
    ends = counts.where(F.col("word") == END).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    tokens, distinct = int(groups["n"].sum()) + ends, int(groups["words"].sum()) + (ends > 0)
    return Vocabulary.of(words.where(known).toPandas(), groups, tokens, distinct, ends)


# documents as symbols

CODED = "n_tokens long, n_known long, base_log double, group_log double, symbols binary, others array<string>"


def coded(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Documents (text binary and others) with symbols, and the words that are not known in ``others``.

    ``base_log`` sums log10(c + 1) over known words and the end, ``group_log`` what known and other words have within
    their groups, but for log10(c + 1) of the others.
    """
    kept = [f for f in docs.schema.fields if f.name != "text"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, end = vocab.index.get, np.array([vocab.end], np.uint16)
        for batch in batches:
            rows = []
            for data in batch.column("text"):
                words = words_of(data.as_py())
                at = np.fromiter(map(get, words, repeat(-1)), np.int32, len(words))
                symbols, new = vocab.symbol[at] if vocab.index else np.zeros(len(at), np.uint16), np.flatnonzero(at < 0)
                others = [words[i] for i in new.tolist()]
                groups = np.fromiter(map(ending_of, others), np.int32, len(others))
                symbols[new] = vocab.group_symbol[groups]
                at = at[at >= 0]
                rows.append((
                    len(words) + 1, len(at) + (vocab.end_log > 0), vocab.log_count[at].sum() + vocab.end_log,
                    vocab.in_group[at].sum() - vocab.group_log[groups].sum(), np.concatenate([symbols, end]).astype("<u2").tobytes(), others,
                ))
            types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.list_(pa.binary())]
            found = zip(*rows, strict=True) if rows else [()] * len(types)
            arrays = [pa.array(list(col), t) for col, t in zip(found, types, strict=True)]
            arrays[-1] = arrays[-1].cast(pa.list_(pa.string()))
            names = [f.name for f in kept]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + arrays, [*names, *(f.split()[0] for f in CODED.split(", "))])

    return docs.mapInArrow(code, f"{fields}, {CODED}")


def shards(batches: Iterator[pa.RecordBatch], size: int = SHARD) -> Iterator[tuple[pa.Table, list[np.ndarray]]]:
    """Rows of about ``size`` tokens at a time, with their symbols."""
    waiting: list[pa.RecordBatch] = []
    tokens = 0
    for batch in batches:
        at, sizes = 0, [len(s.as_buffer()) // 2 if s.is_valid else 0 for s in batch.column("symbols")]
        for k, n in enumerate(sizes):
            tokens += n
            if tokens >= size:
                yield _documents([*waiting, batch.slice(at, k + 1 - at)])
                waiting, tokens, at = [], 0, k + 1
        if at < batch.num_rows:
            waiting.append(batch.slice(at))
    if waiting:
        yield _documents(waiting)


def _documents(batches: list[pa.RecordBatch]) -> tuple[pa.Table, list[np.ndarray]]:
    table = pa.Table.from_batches(batches)
    return table, [np.frombuffer(s.as_buffer(), "<u2") for s in table.column("symbols")]


# training


def trained(codes: DataFrame, vocab: Vocabulary) -> recurrent.Weights:
    """Weights after one pass over all training documents of stored codes (row, held_out, symbols)."""
    weights = recurrent.Weights.fresh(vocab.counts)
    part = F.pmod(F.xxhash64("row"), F.lit(ROUNDS[-1][1]))
    for low, high, rate in ROUNDS:
        rows = codes.where(~F.col("held_out") & part.between(low, high - 1)).select("symbols")
        weights = _after_round(rows, weights, vocab.end, rate)
    return weights


def _after_round(rows: DataFrame, weights: recurrent.Weights, end: int, rate: float) -> recurrent.Weights:
    symbols = len(weights.inputs)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for k, (_, documents) in enumerate(shards(batches)):
            seen = np.bincount(np.concatenate(documents), minlength=symbols).astype(np.float32)
            change = recurrent.train(weights, documents, end, rate=rate).flat() - weights.flat()
            change *= weights.uses(seen)
            data = np.concatenate([change, seen]).astype("<f4").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([f"{task}:{k}"]), pa.array([data], pa.binary())], ["shard", "data"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(d.as_buffer(), "<f4").astype(np.float64) for d in group.column("data"))
        return pa.table({"shard": group.column("shard").slice(0, 1), "data": pa.array([total.astype("<f4").tobytes()], pa.binary())})

    changes = materialise(rows.mapInArrow(learn, "shard string, data binary"), "changes")
    left = changes.count()
    if not left:
        return weights
    while left > 1:  # a task adds up a few dozen of them, whatever their number
        left = -(-left // FAN_IN)
        changes = changes.groupBy(F.pmod(F.xxhash64("shard"), F.lit(left)).alias("group")).applyInArrow(add, "shard string, data binary")
    total = sum(np.frombuffer(r["data"], "<f4").astype(np.float64) for r in changes.collect())
    change, seen = total[:-symbols], total[-symbols:]
    return weights.like((weights.flat() + change / np.maximum(weights.uses(seen), 1)).astype(np.float32))


# scores


def scored(codes: DataFrame, weights: recurrent.Weights, end: int) -> DataFrame:
    """Rows with ``symbol_log``, log10 of the probability of their symbols, in place of ``symbols``."""
    kept = [f for f in codes.schema.fields if f.name != "symbols"]
    names = [f.name for f in kept]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, documents in shards(batches):
            found = recurrent.log_likelihoods(weights, documents, end) / np.log(10)
            yield from table.select(names).append_column("symbol_log", pa.array(found)).combine_chunks().to_batches()

    return codes.mapInArrow(score, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", symbol_log double")


def document_scores(docs: DataFrame, text: Column, key: Column, known: int = KNOWN) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    rows = docs.select(key.alias("doc_id"), held_out(key).alias("held_out"), utf8(text).alias("text"))
    counts = materialise(word_counts(rows.where(~F.col("held_out")), F.col("text")), "counts")
    travels = least_known(counts.where(F.col("word") != END), known)
    vocab = vocabulary(counts, travels)
    codes = materialise(coded(rows.withColumn("row", F.monotonically_increasing_id()), vocab), "codes")
    weights = trained(codes, vocab)
    # a word without a count adds log10(0 + 1)
    others = codes.select("row", F.explode("others").alias("word")).join(counts.where(~travels), "word")
    others = others.groupBy("row").agg(F.sum(F.log10(F.col("n") + 1)).alias("other_log"), F.count("*").alias("other_known"))
    found = scored(codes.drop("others"), weights, vocab.end).join(others, "row", "left")
    other_log = F.coalesce("other_log", F.lit(0.0))
    return found.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("other_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("base_log") + other_log - F.col("n_tokens") * vocab.base_log).alias("base_score"),
        (F.col("symbol_log") + F.col("group_log") + other_log).alias("score"),
    )
