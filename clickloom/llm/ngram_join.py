"""Jaccard self-join of documents on word shingles, by token-combination prefixes.

Every set is put into one global order of tokens: rare ones first, then by frequency class. Two sets that are
similar enough must agree on part of a prefix: a set of size n has at most n - o tokens that the other lacks, with o
the least overlap that the threshold allows. Rare tokens are indexed one by one. Frequent tokens are indexed in
pairs: they are dealt into small hash classes, and two common tokens of a class make a common pair. A class with
c prefix tokens can lose c - 1 of them before no pair is left, so the prefix is extended until the rare tokens and
the c - 1 of all classes exceed n - o by ``spare(n)``; then at least one key more than that is shared. The number of
classes follows the size of the set in powers of two, and a set whose partners may lie in two such bands has the keys
of both.

A candidate must share as many keys as are guaranteed. A document with enough rare tokens has no key of a frequent
one, so passages that many otherwise different documents share make no candidates.

Token frequencies come from a count sketch over all documents; it only decides the order, never a result. A
token counts as frequent at ``4 * tokens / CELLS`` or more (``RARE`` at least), so there are at most ``CELLS / 4``
frequent cells, and as the sketch never counts too little, no rare token has more documents than that.

Equal sets are one representative. Candidates are verified on the whole sets. First every bucket of a key proposes
its smallest member with each other one, which is repeated with another document of the bucket while it still settles
a tenth of the rows. What is left are families of variants just below the threshold, whose pairs across components grow
with the square of a family and are never rows: every document goes to one block, that of its most common key, and
its set travels to the blocks that hold a key of it, where all pairs are compared at once as matrices. Of links
that are found there only those travel on that join two components.

Copies that a step no longer needs are deleted, and the files of a shuffle go with its query.

Rows of documents that hold fewer keys than a similar pair must share go, before the first step and after each.

Edge cases: null and empty texts and texts without words have an empty set and are linked with nothing; shorter texts
are one element; rows without an id are left out; rows that repeat an id are one document with the smallest text.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import keyed
from clickloom.llm.components import connected_components
from clickloom.llm.shingles import mixed, set_key, shingle_sets
from clickloom.session import SHUFFLES_GO, discard, materialise, settings

CELL_BITS = 24
CELLS = 1 << CELL_BITS
SLICES = 64
PROFILE = "doc_id bigint, n int, k1 bigint, k2 bigint, slice int, counts binary"
FLUSH = 1 << 18  # keys or cells that a worker holds before it hands them on
SPARE = 5  # keys beyond the least prefix, per hundred tokens
RARE = 16
MOST = (1 << 16) - 1
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20  # of texts and sets handed to Python at once
BLOCK_TOKENS = 1 << 19  # of the sets of a block
CELLS_AT_ONCE = 1 << 21  # of a matrix or list of pairs in a worker
RARELY = 128  # a token is counted pair by pair if fewer than one in so many pairs share it


def cell_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - CELL_BITS)).astype(np.int32)


def profile(docs: DataFrame, width: int) -> DataFrame:
    """Per document its set's size and key; per task also the counts of all cells, in slices."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, waiting, held = np.zeros(CELLS, np.uint16), [], 0

        def add() -> None:
            cells, times = np.unique(np.concatenate(waiting), return_counts=True)
            counts[cells] = np.minimum(counts[cells] + times, MOST)

        for batch in batches:
            rows = []
            for doc_id, hashes in zip(batch["doc_id"], shingle_sets(batch["text"], width), strict=True):
                rows.append((doc_id, len(hashes), *set_key(hashes)))
                waiting.append(cell_of(hashes))
                held += len(hashes)
                if held > FLUSH:
                    add()
                    waiting.clear()
                    held = 0
            yield pd.DataFrame(rows, columns=["doc_id", "n", "k1", "k2"]).assign(slice=None, counts=None)
        if held:
            add()
        parts = [zlib.compress(p.tobytes(), 1) for p in np.split(counts, SLICES)] if counts.any() else []
        none = [None] * len(parts)
        yield pd.DataFrame({"doc_id": none, "n": none, "k1": none, "k2": none, "slice": range(len(parts)), "counts": parts})

    return docs.mapInPandas(run, PROFILE)


def levels(counts: DataFrame, tokens: int) -> np.ndarray:
    """Frequency class of every cell: 0 for rare, then one more for every doubling."""
    least = max(float(RARE), 4 * tokens / CELLS)

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(CELLS // SLICES, np.int64)
        for part in rows["counts"]:
            total += np.frombuffer(zlib.decompress(part), np.uint16)
        level = np.where(total < least, 0, 1 + np.log2(np.maximum(total, 1) / least)).clip(0, 30).astype(np.uint8)
        return pd.DataFrame({"slice": [key[0]], "level": [level.tobytes()]})

    found = np.zeros((SLICES, CELLS // SLICES), np.uint8)
    for row in counts.groupBy("slice").applyInPandas(add, "slice int, level binary").collect():  # a byte a cell
        found[row["slice"]] = np.frombuffer(row["level"], np.uint8)
    return found.reshape(-1)


def bands(n: int, percent: int) -> range:
    """Powers of two below the sizes that a partner of a set of size ``n`` may have and its own, as far as both see them."""
    low, high = -(-n * percent // 100), n * 100 // percent
    return range(int(math.log2(low)), int(math.log2(high)) + 1)


def spare(n: int) -> int:
    return n * SPARE // 100


def index_keys(hashes: np.ndarray, level: np.ndarray, percent: int) -> np.ndarray:
    """Index keys of a set; sets of one or two tokens have none, as only equal ones are similar to them."""
    n = len(hashes)
    need = n - -(-n * percent // 100) + 1 + spare(n)
    if n < 3:
        return hashes[:0]
    own = level[cell_of(hashes)]
    order = np.argsort(own, kind="stable")
    hashes, rare = hashes[order], int((own == 0).sum())
    if rare >= need:
        return hashes[:need]
    out, frequent = [hashes[:rare]], hashes[rare:]
    for count in sorted({max(1, (1 << band) // 8) for band in bands(n, percent)}):  # small bands share one: no key twice
        classes = np.uint64(count)
        class_of = (frequent >> np.uint64(7)) % classes
        again = np.ones(len(frequent), bool)
        again[np.unique(class_of, return_index=True)[1]] = False
        end = int(np.searchsorted(np.cumsum(again), need - rare)) + 1
        by_class = np.argsort(class_of[:end], kind="stable")
        tokens, class_of = frequent[:end][by_class], class_of[:end][by_class]
        for lag in range(1, len(tokens)):
            same = class_of[lag:] == class_of[:-lag]
            if not same.any():
                break
            first, second = tokens[:-lag][same], tokens[lag:][same]
            out.append(mixed(mixed(first) + mixed(second ^ classes)))
    return np.concatenate(out)


def keys_of(docs: DataFrame, level: np.ndarray, width: int, percent: int) -> DataFrame:
    """(key, doc_id, n) of all documents."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, sizes, keys, held = [], [], [], 0
            for doc_id, hashes in zip(batch["doc_id"], shingle_sets(batch["text"], width), strict=True):
                found = index_keys(hashes, level, percent)
                if len(found):
                    ids.append(np.full(len(found), doc_id, np.int64))
                    sizes.append(np.full(len(found), len(hashes), np.int32))
                    keys.append(found.view(np.int64))
                    held += len(found)
                if held > FLUSH:
                    yield pd.DataFrame({"key": np.concatenate(keys), "doc_id": np.concatenate(ids), "n": np.concatenate(sizes)})
                    ids, sizes, keys, held = [], [], [], 0
            if held:
                yield pd.DataFrame({"key": np.concatenate(keys), "doc_id": np.concatenate(ids), "n": np.concatenate(sizes)})

    return docs.mapInPandas(run, "key bigint, doc_id bigint, n int")


KEY_ROWS = "key bigint, doc_id bigint, n int"


def shared_keys(keys: DataFrame) -> DataFrame:
    """The rows of keys that several documents have."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # rows come sorted; of a key cut by the end of a batch only the first row is kept in mind
        key, doc, n, told = None, 0, 0, True
        for batch in batches:
            if batch.empty:
                continue
            k, d, s = (batch[c].to_numpy() for c in ("key", "doc_id", "n"))
            starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
            lengths = np.diff(np.r_[starts, len(k)])
            keep = np.repeat(lengths > 1, lengths)
            if k[0] == key:  # goes on
                keep[: int(lengths[0])] = True
                if not told:
                    yield pd.DataFrame({"key": [key], "doc_id": [doc], "n": [n]})
                told = True
            if len(starts) > 1 or k[0] != key:
                last = int(starts[-1])
                key, doc, n, told = int(k[last]), int(d[last]), int(s[last]), bool(lengths[-1] > 1)
            yield pd.DataFrame({"key": k[keep], "doc_id": d[keep], "n": s[keep]})

    return keys.repartition("key").sortWithinPartitions("key", "doc_id").mapInPandas(run, KEY_ROWS)


def spare_of(n: Column) -> Column:
    return F.floor(n * SPARE / 100).cast("int")


def enough_keys(found: Column, *n: Column) -> Column:
    """Whether two documents share as many keys as similar ones must."""
    return found >= 1 + F.least(*map(spare_of, n))


def least_keys(percent: int) -> Column:
    """As many keys as a document of size ``n`` must share with the smallest set that can be similar."""
    return 1 + spare_of(F.ceil(F.col("n") * percent / 100))


def with_enough_keys(placed: DataFrame, percent: int) -> DataFrame:
    """The rows of documents that hold as many keys as the smallest set that can be similar must share."""
    held = placed.groupBy("doc_id").agg(F.sum("times").alias("held"), F.first("n").alias("n")).where(F.col("held") >= least_keys(percent))
    return placed.join(held.select("doc_id"), "doc_id", "left_semi")


def size_fits(left: Column, right: Column, percent: int) -> Column:
    return F.least(left, right) * 100 >= F.greatest(left, right) * percent


def whole_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(doc_id, hashes) of the documents of ``wanted``."""

    @F.pandas_udf("binary")
    def sets(texts: pd.Series) -> pd.Series:
        return pd.Series([hashes.tobytes() for hashes in shingle_sets(texts, width)], dtype=object)

    return docs.join(wanted, "doc_id", "left_semi").select("doc_id", sets("text").alias("hashes"))


def verified(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    pairs = materialise(pairs, "pairs")
    wanted = materialise(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "wanted")

    @F.pandas_udf("boolean")
    def similar(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(left, right, strict=True):
            common = len(np.intersect1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), assume_unique=True))
            out.append(100 * common >= percent * ((len(a) + len(b)) // 8 - common))
        return pd.Series(out, dtype=bool)

    whole = materialise(whole_sets(docs, wanted, width), "sets")
    first = pairs.join(whole.select(F.col("doc_id").alias("b"), F.col("hashes").alias("hashes_b")), "b")
    both = first.join(whole.select(F.col("doc_id").alias("a"), F.col("hashes").alias("hashes_a")), "a")
    found = materialise(both.where(similar("hashes_a", "hashes_b")).select("a", "b"), "found")
    discard(pairs, wanted, whole)
    return found


def likely(pairs: DataFrame) -> DataFrame:
    return pairs.where(enough_keys(F.col("found"), F.col("na"), F.col("nb"))).select("a", "b")


def star_pairs(placed: DataFrame, turn: int, percent: int) -> DataFrame:
    """Of every key one document with each of another component; another one in each turn."""
    order = F.col("doc_id") if turn == 0 else F.xxhash64("doc_id", F.lit(turn))
    centres = placed.groupBy("key").agg(F.min(F.struct(order.alias("o"), "doc_id", "n", "component")).alias("m"))
    col = F.col
    star = placed.join(centres, "key").where((col("component") != col("m.component")) & size_fits(col("n"), col("m.n"), percent))
    ends = (F.least("m.doc_id", "doc_id").alias("a"), F.greatest("m.doc_id", "doc_id").alias("b"))
    # only the smaller of the two sizes matters here
    return likely(star.groupBy(*ends).agg(F.sum("times").alias("found"), F.first("m.n").alias("na"), F.first("n").alias("nb")))


def mixed_keys(rows: DataFrame) -> DataFrame:
    """Rows of keys that hold several components; keys with the same documents become one, ``times`` as many."""
    keys = rows.groupBy("key").agg(
        F.count("*").alias("c"), F.bit_xor(F.xxhash64("doc_id")).alias("x"), F.sum(F.hash("doc_id")).alias("s"),
        F.first("times").alias("t"), F.min("component").alias("low"), F.max("component").alias("high"),
    )
    keys = keys.where("low < high").groupBy("c", "x", "s").agg(F.min("key").alias("key"), F.sum("t").alias("times"))
    return rows.drop("times").join(keys.select("key", "times"), "key")


def several_components(placed: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Rows that can still give a link between two components."""
    now = placed.drop("component").join(classes.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    now = now.select("key", "doc_id", "n", "times", F.coalesce("component", "doc_id").alias("component"))
    mixed = materialise(mixed_keys(now), "mixed")
    full = materialise(with_enough_keys(mixed, percent), "full")
    left = materialise(mixed_keys(full), "mixed")
    discard(placed, mixed, full)
    return left


def in_blocks(placed: DataFrame) -> DataFrame:
    """``placed`` with the block of every document: that of its key with the most documents, or a part of it."""
    sizes = placed.groupBy("key").agg(F.count("*").alias("c"))
    home = F.min(F.struct((-F.col("c")).alias("c"), "key"))["key"].alias("home")
    homes = materialise(placed.join(sizes, "key").groupBy("doc_id").agg(F.first("n").alias("n"), home), "homes")
    parts = homes.groupBy("home").agg(F.ceil(F.sum("n") / BLOCK_TOKENS).alias("parts"))
    block = F.xxhash64("home", F.pmod(F.xxhash64("doc_id"), "parts")).alias("block")
    rows = materialise(placed.join(homes.join(parts, "home").select("doc_id", block), "doc_id"), "in-blocks")
    discard(homes)
    return rows


def meetings(placed: DataFrame, percent: int) -> DataFrame:
    """(low, high, side, doc_id, component): the documents of two blocks that may have a partner in the other one.

    Such a document shares as many keys with the other block as it must share with the partner.
    """
    rows = in_blocks(placed)
    sizes = (F.min("n").alias("least"), F.max("n").alias("most"))
    there = rows.groupBy("key", F.col("block").alias("other")).agg(*sizes, F.min("component").alias("first"), F.max("component").alias("last"))
    fits = f"most * 100L >= n * {percent} and n * 100L >= least * {percent} and (first < last or first <> component)"
    shared = rows.join(there, "key").where(fits).groupBy("block", "other", "doc_id")
    met = shared.agg(F.sum("times").alias("held"), F.first("n").alias("n"), F.first("component").alias("component")).where(F.col("held") >= least_keys(percent))
    ends = (F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    met = materialise(met.select(*ends, (F.col("block") > F.col("other")).cast("int").alias("side"), "doc_id", "component"), "meetings")
    side, component = ((F.min(c).alias(f"first_{c}"), F.max(c).alias(f"last_{c}")) for c in ("side", "component"))
    whole = met.groupBy("low", "high").agg(*side, *component).where("first_component < last_component and (low = high or first_side < last_side)")
    left = materialise(met.join(whole.select("low", "high"), ["low", "high"], "left_semi"), "meetings")
    discard(rows, met)
    return left


def common_tokens(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many tokens every left set has in common with every right one."""
    shape = len(left), len(right)
    rows, tokens, columns = [], [], []
    for sets in (left, right):
        rows.append(np.repeat(np.arange(len(sets)), [len(s) for s in sets]))
        tokens.append(np.concatenate(sets))
    both = np.intersect1d(*tokens)
    for x in range(2):
        at = np.searchsorted(both, tokens[x])
        known = both[np.minimum(at, len(both) - 1)] == tokens[x] if len(both) else np.zeros(len(at), bool)
        order = np.argsort(at[known], kind="stable")
        rows[x], columns = rows[x][known][order], [*columns, at[known][order]]
    counts = [np.bincount(c, minlength=len(both)) for c in columns]
    starts = [np.r_[0, np.cumsum(c)] for c in counts]
    shared = counts[0] * counts[1]
    often = np.flatnonzero(shared * RARELY > shape[0] * shape[1])
    out = np.zeros(shape, np.int64)

    step = max(1, CELLS_AT_ONCE // max(shape))
    place = np.full(len(both), -1)
    for low in range(0, len(often), step):
        some = often[low : low + step]
        place[some] = np.arange(len(some))
        sides = []
        for x in range(2):
            of = np.concatenate([np.arange(a, b) for a, b in zip(starts[x][some], starts[x][some + 1], strict=True)])
            dense = np.zeros((shape[x], len(some)), np.float32)
            dense[rows[x][of], place[columns[x][of]]] = 1
            sides.append(dense)
        out += np.rint(sides[0] @ sides[1].T).astype(np.int64)  # at most ``step`` of a pair, exact

    seldom = np.ones(len(both), bool)
    seldom[often] = False
    entries = np.flatnonzero(seldom[columns[0]])
    times = counts[1][columns[0][entries]]
    ends, low = np.cumsum(times), 0
    while low < len(entries):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + CELLS_AT_ONCE, "right")))
        some, n = entries[low:high], times[low:high]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[1][columns[0][some]], n)
        np.add.at(out, (np.repeat(rows[0][some], n), rows[1][at]), 1)
        low = high
    return out


def joining(similar: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Similar pairs (row, column) that join all that similar pairs can join of the components ``left`` and ``right``."""
    out, now = [], [left.copy(), right.copy()]
    for i in np.flatnonzero(similar.any(1)):
        near = np.flatnonzero(similar[i] & (now[1] != now[0][i]))
        others, first = np.unique(now[1][near], return_index=True)
        out += [(int(i), int(j)) for j in near[first]]
        if len(others):
            own = now[0][i]
            for side in now:
                side[np.isin(side, others)] = own
    return out


def block_links(ids: np.ndarray, component: np.ndarray, side: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links (a, b) across components between the two sides of a meeting, or within its one block."""
    sides = [np.flatnonzero(side == x) for x in range(2)] if side.any() else [np.arange(len(ids))] * 2
    if not min(map(len, sides)):
        return []
    left, right = ([sets[i] for i in at] for at in sides)
    common = common_tokens(left, right)
    size = [np.array([len(s) for s in x]) for x in (left, right)]
    similar = 100 * common >= percent * (size[0][:, None] + size[1][None, :] - common)
    found = joining(similar, component[sides[0]], component[sides[1]])
    return [(min(p), max(p)) for p in ((int(ids[sides[0][i]]), int(ids[sides[1][j]])) for i, j in found)]


def cross_links(placed: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b): similar documents that join the components of ``placed``, compared block by block."""
    met = meetings(placed, percent)
    wanted = materialise(met.select("doc_id").distinct(), "wanted")
    whole = materialise(whole_sets(docs, wanted, width), "sets")

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, at = [], None

        def links() -> list[tuple[int, int]]:
            ids, component, side = (np.concatenate([rows[c].to_numpy() for rows in held]) for c in ("doc_id", "component", "side"))
            return block_links(ids, component, side, [np.frombuffer(s, np.uint64) for rows in held for s in rows["hashes"]], percent)

        for batch in batches:
            found, ends = [], batch[["low", "high"]].to_numpy()
            starts = np.flatnonzero(np.r_[True, (ends[1:] != ends[:-1]).any(1)]) if len(batch) else []
            for low, high in zip(starts, np.r_[starts[1:], len(batch)], strict=True):
                if held and tuple(ends[low]) != at:
                    found += links()
                    held = []
                held.append(batch.iloc[low:high])
                at = tuple(ends[low])
            yield pd.DataFrame(found, columns=["a", "b"])
        if held:
            yield pd.DataFrame(links(), columns=["a", "b"])

    rows = met.join(whole, "doc_id").select("low", "high", "side", "doc_id", "component", "hashes")
    rows = rows.repartition("low", "high").sortWithinPartitions("low", "high", "side", "doc_id")
    found = materialise(rows.mapInPandas(run, "a bigint, b bigint"), "found")
    discard(met, wanted, whole)
    return found


def similar_documents(docs: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id) of all documents (doc_id, text).

    The component is the smallest doc_id that links of at least ``percent`` similarity reach.
    """
    with settings(docs.sparkSession, {BATCH: BATCH_BYTES, SHUFFLES_GO: True}):
        return _components(docs, width, percent)


def _components(docs: DataFrame, width: int, percent: int) -> DataFrame:
    docs = keyed(docs, "doc_id").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    profiled = materialise(profile(docs, width), "profile")
    sizes = profiled.where("doc_id is not null").groupBy("doc_id").agg(F.max_by(F.struct("n", "k1", "k2"), "n").alias("p"), F.count("*").alias("copies"))
    sizes = materialise(sizes.select("doc_id", "p.*", "copies"), "sizes")
    totals = sizes.agg(F.sum("n"), F.max("copies")).first()
    if (totals[1] or 1) > 1:  # rows that repeat an id: one text each
        docs = docs.groupBy("doc_id").agg(F.min("text").alias("text"))
        discard(profiled, sizes)
        profiled = materialise(profile(docs, width), "profile")
        sizes = materialise(profiled.where("doc_id is not null").select("doc_id", "n", "k1", "k2"), "sizes")
    level = levels(profiled.where("slice is not null"), int(totals[0] or 0))

    same = sizes.where("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("first"), F.count("*").alias("c")).where("c > 1")
    member = materialise(
        sizes.join(same, ["k1", "k2"], "left").select("doc_id", "n", F.when(F.col("n") > 0, F.coalesce("first", "doc_id")).otherwise(F.col("doc_id")).alias("first")),
        "members",
    )
    discard(profiled, sizes)
    copies = materialise(member.where("first <> doc_id").select("doc_id"), "copies")
    distinct = docs.join(copies, "doc_id", "left_anti")

    shared = materialise(shared_keys(keys_of(distinct, level, width, percent)), "shared-keys")
    first = shared.select("*", F.lit(1).cast("long").alias("times"), F.col("doc_id").alias("component"))
    placed = materialise(with_enough_keys(first, percent), "placed")
    discard(shared)
    links, turn, rows, before = None, 0, 0, None
    while before is None or rows * 10 < before * 9:
        before = placed.count() if before is None else rows
        found = verified(star_pairs(placed, turn, percent), distinct, width, percent)
        links = found if links is None else links.unionByName(found)
        placed = several_components(placed, connected_components(links, "a", "b"), percent)
        rows, turn = placed.count(), turn + 1
    more = cross_links(placed, distinct, width, percent)
    final = materialise(connected_components(links.unionByName(more), "a", "b"), "components")
    discard(placed, copies)

    found = member.join(final.withColumnRenamed("node", "first"), "first", "left")
    return found.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "first").alias("component_id"))
