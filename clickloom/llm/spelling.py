"""Spelling variants: words one edit apart, found by range searches in k-d trees over letter counts.

A word is the vector of how often each letter occurs in it. A replaced letter makes one count larger and one smaller
(L1 distance two), an inserted letter makes one count larger (distance one). So the words one edit from a word of
length L are, among those of length L, within one step up and one step down of its vector, and among those of length
L + 1, within one step up. For each such pair of lengths the tree is walked with what is left of both steps: a branch is
left out as soon as its box is further up or down than that. What is left is compared letter by letter.

Spark deals the words out by length and by the leaf of a coarse tree over a sample of all words; a word visits every
leaf whose box its steps reach. Inside a leaf's task a fine tree is built and walked with all visitors at once.
Words lie in exactly one leaf, so every pair is seen once, and each task returns one row per word that it found a
neighbour of: their number and the best of them. Pairs are never rows.

The sample (``SAMPLE`` words, all words if there are fewer) only places the leaves' borders: about ``LEAF`` words a leaf
as long as there are under ``SAMPLE / 8 * LEAF`` (650 million) words; beyond that, leaves grow in step with the words.

Edge cases: null texts have no words; an empty table gives no rows; rows without an id are left out; rows that repeat
count as often as they occur; words may have any length, a length that the sample lacks is one leaf.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.session import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LETTERS, LEAST_COUNT, RATIO = 7, 2, 10
DAMAGE = 31  # one run in so many loses a letter
SAMPLE, LEAF, FINE_LEAF, PAIRS = 1 << 18, 20_000, 8, 1 << 18
LETTERS = 64 + 26  # the lower case of the alphabet and all from U+00C0 to U+00FF
HOME, SAME, LONGER = 0, 1, 2  # why a word is in a leaf: it lies there, or seeks words of its length or of one letter more


# words of the corpus


def damaged(run: Column, key: Column, every: int = DAMAGE) -> Column:
    """The run, without one of its letters if its hash with the document's id says so."""
    h = F.crc32(F.concat(key.cast("string"), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % every == 0, cut).otherwise(run)


def corpus_words(docs: DataFrame, text: Column, key: Column, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): distinct words of all texts with at least so many letters and occurrences."""
    # a shorter run can't become a longer word, so the pattern takes whole runs of enough letters only
    runs = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"[A-Za-zÀ-ÿ]{{{least_letters},}}+"), F.lit(0))
    rows = docs.select(key.alias("key"), F.explode(runs).alias("run"))
    rows = rows.select("key", F.translate("run", UPPER, LOWER).alias("run"))
    words = rows.select(damaged(F.col("run"), F.col("key")).alias("word")).where(F.length("word") >= least_letters)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


# letter counts


def letters(words: list[str], length: int) -> np.ndarray:
    """Words of one length as rows of bytes."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)


def letter_counts(rows: np.ndarray) -> np.ndarray:
    """How often each letter is in each word."""
    code = np.where(rows < 128, rows - 97, rows.astype(np.int16) - 166)
    cell = (code + LETTERS * np.arange(len(rows))[:, None]).ravel()
    counts = np.bincount(cell, minlength=LETTERS * len(rows)).reshape(len(rows), LETTERS)
    return counts.astype(np.uint8 if rows.shape[1] < 256 else np.int32)


# trees


@dataclass
class Node:
    """A split (letter, most of it on the left), or a leaf with a number; with the box's bounds on the letter before it."""

    leaf: int = -1
    members: np.ndarray | None = None
    letter: int = 0
    most: int = 0
    floor: int = 0  # least count of the letter in this box
    ceiling: int = 1 << 30
    left: Node | None = None
    right: Node | None = None


@dataclass
class Tree:
    root: Node
    leaves: list[Node] = field(default_factory=list)


def best_split(counts: np.ndarray) -> tuple[int, int] | None:
    """The letter and count that halve the words best; None if all vectors are equal."""
    some = counts if len(counts) <= 512 else counts[:: len(counts) // 512]
    best, found = 0, None
    for most in range(int(some.max(initial=0))):
        below = (some <= most).sum(0)
        even = np.minimum(below, len(some) - below)
        letter = int(even.argmax())
        if even[letter] <= best and found:
            break  # higher counts are rarer
        if even[letter] > best:
            best, found = int(even[letter]), (letter, most)
    if found or len(some) == len(counts):
        return found
    spread = np.flatnonzero(counts.max(0) > counts.min(0))
    return (int(spread[0]), int(counts[:, spread[0]].min())) if len(spread) else None


def grow(counts: np.ndarray, size: int) -> Tree:
    """Splits words by their letter counts until a leaf has at most ``size`` or equal ones only."""
    tree = Tree(Node())
    stack = [(tree.root, np.arange(len(counts)), {})]
    while stack:
        node, members, box = stack.pop()
        split = best_split(counts[members]) if len(members) > size else None
        if split is None:
            node.leaf, node.members = len(tree.leaves), members
            tree.leaves.append(node)
            continue
        node.letter, node.most = split
        node.floor, node.ceiling = box.get(node.letter, (0, 1 << 30))
        left = counts[members, node.letter] <= node.most
        node.left, node.right = Node(), Node()
        stack.append((node.left, members[left], box | {node.letter: (node.floor, node.most)}))
        stack.append((node.right, members[~left], box | {node.letter: (node.most + 1, node.ceiling)}))
    return tree


def reached(tree: Tree, counts: np.ndarray, up: int, down: int) -> Iterator[tuple[Node, np.ndarray]]:
    """Every leaf with the vectors that reach its box by at most so many steps up and down."""
    n = len(counts)
    by_letter = np.ascontiguousarray(counts.T).astype(np.int32)
    stack = [(tree.root, np.arange(n), np.full(n, up, np.int32), np.full(n, down, np.int32))]
    while stack:
        node, who, up_left, down_left = stack.pop()
        if node.leaf >= 0:
            yield node, who
            continue
        have = by_letter[node.letter, who]
        # the letter's earlier bounds may have cost steps already: only what the new bound adds is taken off
        down_now = down_left - np.maximum(have - node.most, 0) + np.maximum(have - node.ceiling, 0)
        up_now = up_left - np.maximum(node.most + 1 - have, 0) + np.maximum(node.floor - have, 0)
        go = np.flatnonzero(down_now >= 0)
        if len(go):
            stack.append((node.left, who[go], up_left[go], down_now[go]))
        go = np.flatnonzero(up_now >= 0)
        if len(go):
            stack.append((node.right, who[go], up_now[go], down_left[go]))


def home_leaf(tree: Tree, counts: np.ndarray) -> np.ndarray:
    """The leaf that each vector lies in."""
    at = np.zeros(len(counts), np.int64)
    for node, who in reached(tree, counts, 0, 0):
        at[who] = node.leaf
    return at


# letter order


def replaced_once(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(1) == 1


def inserted_once(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Rows where ``long`` is ``short`` with one more letter."""
    size = short.shape[1]
    same = short == long[:, :size]
    first = np.where(same.all(1), size, same.argmin(1))
    return ((short == long[:, 1:]) | (np.arange(size) < first[:, None])).all(1)


def pairs_of(tree: Tree, points: np.ndarray, seekers: np.ndarray, counts: np.ndarray, longer: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(seeker, point) index pairs one edit apart, in blocks."""
    test = inserted_once if longer else replaced_once
    for node, who in reached(tree, counts, 1, 0 if longer else 1):
        step = max(1, PAIRS // len(node.members))
        for at in range(0, len(who), step):
            a = np.repeat(who[at : at + step], len(node.members))
            b = np.tile(node.members, len(a) // len(node.members))
            hit = np.flatnonzero(test(seekers[a], points[b]))
            if len(hit):
                yield a[hit], b[hit]


# one leaf's work


def best_of(found: list[tuple[np.ndarray, np.ndarray]], n: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per owner: owner, number of its neighbours, the one of largest count (smallest word of equals)."""
    owner, other = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((rank[other], -n[other], owner))
    owner, other = owner[order], other[order]
    start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    return owner[start], np.diff(np.r_[start, len(owner)]), other[start]


FOUND = "word string, n_near long, best_n long, best_word string"


def leaf_neighbours(rows: pa.Table) -> pa.Table:
    """Neighbours among the words of one leaf and those that reach it."""
    length = rows["length"][0].as_py()
    role, words, n = rows["role"].to_numpy(), np.array(rows["word"].to_pylist(), object), rows["n"].to_numpy()
    out: list[pd.DataFrame] = []

    def report(owners: np.ndarray, others: np.ndarray, found: list, other_n: np.ndarray) -> None:
        if found:
            who, near, best = best_of(found, other_n, np.argsort(np.argsort(others)))
            out.append(pd.DataFrame({"word": owners[who], "n_near": near, "best_n": other_n[best], "best_word": others[best]}))

    home = np.flatnonzero(role == HOME)
    if len(home):
        points = letters(words[home].tolist(), length)
        counts = letter_counts(points)
        tree = grow(counts, FINE_LEAF)
        same = np.flatnonzero(role != LONGER)
        shapes = letters(words[same].tolist(), length)
        found = list(pairs_of(tree, points, shapes, letter_counts(shapes), longer=False))
        report(words[same], words[home], found, n[home])
        short = np.flatnonzero(role == LONGER)
        if len(short):
            shapes = letters(words[short].tolist(), length - 1)
            found = list(pairs_of(tree, points, shapes, letter_counts(shapes), longer=True))
            report(words[short], words[home], found, n[home])
            report(words[home], words[short], [(b, a) for a, b in found], n[short])
    none = pd.DataFrame({"word": [], "n_near": [], "best_n": [], "best_word": []})
    frame = pd.concat(out) if out else none
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best_word", pa.string())])
    return pa.Table.from_pandas(frame, schema, preserve_index=False)


# all words


def coarse_trees(words: DataFrame, total: int) -> dict[int, Tree]:
    """Per length a tree whose leaves hold about ``LEAF`` of all words, from a sample of bounded size."""
    some = words.select("word")
    if total > SAMPLE:
        some = some.where(F.pmod(F.xxhash64("word"), F.lit(-(-total // SAMPLE))) == 0).limit(SAMPLE)
    sample = some.toPandas()["word"]
    size = max(8, LEAF * len(sample) // max(total, 1))
    trees = {}
    for length, group in sample.groupby(sample.str.len()):
        if len(group) > size:
            tree = grow(letter_counts(letters(group.tolist(), length)), size)
            for leaf in tree.leaves:
                leaf.members = None
            trees[int(length)] = tree
    return trees


ROUTED = "length int, leaf int, role int, word string, n long"


def routed(words: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """A row for each leaf that a word lies in or can have neighbours in."""
    one = Tree(Node(0))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            size = frame["word"].str.len()
            parts = []
            for length, group in frame.groupby(size):
                counts = letter_counts(letters(group["word"].tolist(), length))
                tree = trees.get(length, one)
                home = home_leaf(tree, counts)
                visits = [(length, HOME, np.arange(len(group)), home)]
                for node, who in reached(tree, counts, 1, 1):
                    away = who[home[who] != node.leaf]
                    visits.append((length, SAME, away, np.full(len(away), node.leaf)))
                for node, who in reached(trees.get(length + 1, one), counts, 1, 0):
                    visits.append((length + 1, LONGER, who, np.full(len(who), node.leaf)))
                for to, role, who, leaf in visits:
                    word, n = group["word"].to_numpy()[who], group["n"].to_numpy()[who]
                    parts.append(pd.DataFrame({"length": to, "leaf": leaf, "role": role, "word": word, "n": n}))
            if parts:
                yield pa.RecordBatch.from_pandas(pd.concat(parts), ROUTED_SCHEMA, preserve_index=False)

    return words.mapInArrow(route, ROUTED)


ROUTED_SCHEMA = pa.schema([("length", pa.int32()), ("leaf", pa.int32()), ("role", pa.int32()), ("word", pa.string()), ("n", pa.int64())])


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, n_near, best_n, best_word) of stored words (word, n)."""
    trees = coarse_trees(words, words.count())
    found = routed(words, trees).groupBy("length", "leaf").applyInArrow(leaf_neighbours, FOUND)
    found = found.select("word", F.lit(None).cast("long").alias("n"), "n_near", "best_n", "best_word")
    alone = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("best_n"), F.lit(None).cast("string").alias("best_word"))
    best = F.min(F.when(F.col("best_n").isNotNull(), F.struct((-F.col("best_n")).alias("n"), F.col("best_word").alias("word"))))
    rows = alone.unionByName(found).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
    return rows.select("word", "n", "n_near", (-F.col("best.n")).alias("best_n"), F.col("best.word").alias("best_word"))


def last_forms(links: DataFrame) -> DataFrame:
    """(word, root) of stored links (word, form): each round doubles the way that has been followed.

    A form is more frequent than its word, so there is no circle and the ways are short.
    """
    at = links.select("word", F.col("form").alias("root"))
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = at.join(ahead, "root", "left")
        at = materialise(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if at.where("moved").isEmpty():
            return at.select("word", "root")
        at = at.select("word", "root")


def variant_groups(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of words (word, n)."""
    near = near_words(materialise(words, "words"))
    strong = F.col("best_n") >= ratio * F.col("n")
    near = near.select("word", "n", "n_near", F.when(strong, F.col("best_word")).alias("form"), F.when(strong, F.col("best_n")).alias("form_n"))
    near = materialise(near, "near-words")
    roots = last_forms(near.where("form is not null").select("word", "form"))
    return near.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
