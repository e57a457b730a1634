"""Blocks of vectors as balls, to compare only blocks that can hold a close pair.

A tree of centres halves a bounded sample of all vectors level by level. Every vector lies in the cell of its nearest
centre, on the level where a key's cells hold about a block of its rows. A block keeps the least and the largest angle
of its vectors to the centre. By the triangle inequality for angles, two vectors of two blocks are at least so far
apart as the angle between the centres less both largest angles (and a shell's least angle less the rest), so the
largest cosine that a pair of blocks can hold is known before a vector moves. The bound is exact whatever the tree is
like: a poor tree only leaves more pairs of blocks to compare.

Pairs of cells come first (at most ``LEAVES`` cells a side and key), then pairs of their blocks. Where vectors have no
groups, as random ones in many dimensions, hardly any pair is ruled out and the work is that of all pairs of blocks.

Blocks travel in groups of neighbouring cells: a task gets two groups and multiplies those of their blocks that can
pass, so a block is moved once for every group of the other side and not for every block of it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators.joins import salted_join
from clickloom.session import materialise

BLOCK = 256
LEAVES = 1 << 10
SAMPLE_ROWS, SAMPLE_VALUES = 20_000, 1 << 23
MARGIN = 1e-6  # radians; covers the rounding of cosines and angles
GROUP, LEAST_GROUP = 1 << 14, 1 << 10  # rows of a group
GROUPS = 8  # of a key whose rows would fill fewer
META = ("cell", "part", "parts", "low", "high", "group")
NOWHERE = -1  # cell of vectors without length: never ruled out


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    length = np.sqrt((matrix * matrix).sum(1, keepdims=True))
    return np.divide(matrix, length, out=np.zeros_like(matrix), where=length > 0)


@dataclass
class CellTree:
    """Centres in heap order: the children of node i are 2i + 1 and 2i + 2."""

    centres: np.ndarray
    depth: int

    def cells(self, rows: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell of every row on its level, and the row's angle to the centre."""
        rows = unit_rows(rows)
        at = np.zeros(len(rows), np.int64)
        for level in range(min(self.depth, int(depth.max(initial=0)))):
            deeper = np.flatnonzero(depth > level)
            left = 2 * at[deeper] + 1
            some = rows[deeper]
            near = [(some * self.centres[left + side]).sum(1) for side in (0, 1)]
            at[deeper] = left + (near[1] > near[0])
        angle = np.arccos(np.clip((rows * self.centres[at]).sum(1), -1, 1))
        empty = ~rows.any(1)
        return np.where(empty, NOWHERE, at), np.where(empty, 0.0, angle)

    def angle(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Angle between the centres of two cells."""
        apart = np.arccos(np.clip((self.centres[a] * self.centres[b]).sum(1), -1, 1))
        return np.where((a == b) | (a < 0) | (b < 0), 0.0, apart)


def halved(rows: np.ndarray, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Two centres of unit rows, from the row furthest from the mean and the one furthest from that."""
    first = rows[(rows @ rows.sum(0)).argmin()]
    centres = np.stack([first, rows[(rows @ first).argmin()]])
    for _ in range(rounds):
        right = rows @ centres[1] > rows @ centres[0]
        if right.all() or not right.any():
            break
        centres = unit_rows(np.stack([rows[~right].sum(0), rows[right].sum(0)]))
    return centres, rows @ centres[1] > rows @ centres[0]


def fit_tree(rows: np.ndarray, depth: int) -> CellTree:
    """The tree over a sample; a node without enough rows has its children where it is itself."""
    rows = unit_rows(rows)
    rows = rows[rows.any(1)]
    centres = np.zeros((2 ** (depth + 1) - 1, rows.shape[1]))
    centres[0] = unit_rows(rows.sum(0, keepdims=True))[0]
    members = {0: rows}
    for node in range(2**depth - 1):
        mine = members.pop(node)
        if len(mine) > 1:
            pair, right = halved(mine)
        else:
            pair, right = np.stack([centres[node]] * 2), np.zeros(len(mine), bool)
        centres[[2 * node + 1, 2 * node + 2]] = pair
        members[2 * node + 1], members[2 * node + 2] = mine[~right], mine[right]
    return CellTree(centres, depth)


def sampled_tree(vectors: DataFrame, rows: int, block: int) -> CellTree:
    """From at most ``SAMPLE_ROWS`` rows and ``SAMPLE_VALUES`` numbers, by the vectors' hashes."""
    depth = max(0, int(np.ceil(np.log2(min(LEAVES, max(1, rows / block))))))
    width = vectors.agg(F.max(F.size("vector"))).first()[0]
    size = max(2, min(SAMPLE_ROWS, SAMPLE_VALUES // width))
    every = -(-rows // size)
    some = vectors.where(F.pmod(F.xxhash64("vector"), F.lit(every)) == 0).limit(size).toPandas()["vector"]
    sample = np.stack([np.asarray(v, float) for v in some]) if len(some) else np.eye(1, width)
    return fit_tree(sample, depth) if sample.any() else CellTree(np.eye(2 ** (depth + 1) - 1, width), depth)


def _cell(tree: CellTree, vector: Column, depth: Column) -> Column:
    @F.pandas_udf("cell long, angle double")
    def place(vectors: pd.Series, depths: pd.Series) -> pd.DataFrame:
        rows = np.stack([np.asarray(v, float) for v in vectors]) if len(vectors) else np.zeros((0, tree.centres.shape[1]))
        cell, angle = tree.cells(rows, depths.to_numpy())
        return pd.DataFrame({"cell": cell, "angle": angle})

    return place(vector.cast("array<double>"), depth)


def _blocks(words: DataFrame, keys: Sequence[str], tree: CellTree, sizes: DataFrame, block: int) -> DataFrame:
    """Stored blocks: their cell and number, the angles they cover, their rows as arrays."""
    fields = [c for c in words.columns if c not in keys]
    rows = salted_join(words, sizes, keys, spread=32)
    rows = materialise(rows.withColumn("_at", _cell(tree, F.col("vector"), F.col("_depth"))).select(*keys, *fields, "_at.*"), "placed")
    share = rows.groupBy(*keys, "cell").agg(F.count("*").alias("_n"), F.ceil(F.count("*") / block).alias("parts"))
    key = Window.partitionBy(*keys)
    before = F.coalesce(F.sum("_n").over(key.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fill = F.greatest(F.lit(LEAST_GROUP), F.least(F.lit(GROUP), F.ceil(F.sum("_n").over(key) / GROUPS)))
    share = share.select(*keys, "cell", "_n", "parts", before.alias("_before"), fill.alias("_fill"))
    rows = salted_join(rows, share, [*keys, "cell"], spread=32).withColumn("part", F.pmod(F.xxhash64("word"), "parts"))
    rows = rows.withColumn("group", F.floor((F.col("_before") + F.col("part") * F.col("_n") / F.col("parts")) / F.col("_fill")))
    known = F.col("cell") != NOWHERE
    packed = rows.groupBy(*keys, "cell", "part", "parts", "group").agg(
        F.when(known, F.min("angle")).otherwise(0.0).alias("low"),
        F.when(known, F.max("angle")).otherwise(np.pi).alias("high"),
        F.collect_list(F.struct(*fields)).alias("_rows"),
    )
    return materialise(packed.select(
        *keys, *META, *[F.col(f"_rows.{c}").alias(c) for c in fields if c != "vector"], F.flatten("_rows.vector").alias("vector"),
    ), "blocks")


def _side(blocks: DataFrame, keys: Sequence[str], side: str) -> DataFrame:
    return blocks.select(*keys, *[F.col(c).alias(f"{side}_{c}") for c in blocks.columns if c not in keys])


@dataclass
class BallIndex:
    """Blocks of two sides whose rows are (keys .., word, vector, ..); vectors are not null."""

    left: DataFrame
    right: DataFrame
    keys: list[str]
    owner: list[str]  # the keys without the constant one of sides that have none
    tree: CellTree

    @classmethod
    def of(cls, left: DataFrame, right: DataFrame, keys: Sequence[str] = (), block: int = BLOCK) -> BallIndex | None:
        """None if no key has rows on both sides."""
        owner, keys, same = list(keys), list(keys) or ["_all"], left is right
        if not owner:
            left, right = left.withColumn("_all", F.lit(0)), right.withColumn("_all", F.lit(0))
        left = materialise(left, "left")
        right = left if same else materialise(right, "right")
        counts = left.groupBy(*keys).agg(F.count("*").alias("l"))
        sizes = counts.join(right.groupBy(*keys).agg(F.count("*").alias("r")), keys)
        if sizes.isEmpty():
            return None
        most = F.greatest("l", "r")
        tree = sampled_tree(left.select("vector").unionAll(right.select("vector")), left.count() + right.count(), block)
        depth = F.least(F.greatest(F.ceil(F.log2(most / block)), F.lit(0)), F.lit(tree.depth)).cast("int")
        sizes = sizes.select(*keys, depth.alias("_depth"))
        l_blocks = _blocks(left, keys, tree, sizes, block)
        r_blocks = l_blocks if same else _blocks(right, keys, tree, sizes, block)
        return cls(_side(l_blocks, keys, "l"), _side(r_blocks, keys, "r"), keys, owner, tree)

    def _closest(self) -> Column:
        """The largest cosine that vectors in two balls (or shells) can have."""
        tree = self.tree

        @F.pandas_udf("double")
        def apart(a: pd.Series, b: pd.Series) -> pd.Series:
            return pd.Series(tree.angle(a.to_numpy(), b.to_numpy()))

        between, l_low, l_high, r_low, r_high = apart("l_cell", "r_cell"), *(F.col(c) for c in ("l_low", "l_high", "r_low", "r_high"))
        gap = F.greatest(between - l_high - r_high, l_low - between - r_high, r_low - between - l_high)
        return F.cos(F.greatest(gap - MARGIN, F.lit(0.0)))

    def near_pairs(self, least: DataFrame | float) -> DataFrame:
        """(keys .., l_cell, l_part, r_cell, r_part, l_group, r_group) of blocks that can hold a cosine of ``least`` or more.

        ``least`` is one number, or a number ``least`` per left block (owner .., l_cell, l_part).
        """
        keys, names = self.keys, [f"l_{c}" for c in META]
        left, right = self.left.select(*keys, *names), self.right.select(*keys, *[f"r_{c}" for c in META])
        if isinstance(least, DataFrame):
            left = left.join(least, [*self.owner, "l_cell", "l_part"])
        else:
            left = left.withColumn("least", F.lit(float(least)))
        cells = [
            rows.groupBy(*keys, f"{s}_cell").agg(F.min(f"{s}_low").alias(f"{s}_low"), F.max(f"{s}_high").alias(f"{s}_high"), *more)
            for rows, s, more in ((left, "l", [F.min("least").alias("least")]), (right, "r", []))
        ]
        both = cells[0].join(cells[1], keys)
        near = both.where(self._closest() >= F.col("least")).select(*keys, "l_cell", "r_cell")
        blocks = left.join(near, [*keys, "l_cell"]).join(right, [*keys, "r_cell"])
        passing = blocks.where(self._closest() >= F.col("least"))
        return passing.select(*keys, "l_cell", "l_part", "r_cell", "r_part", "l_group", "r_group")

    def home_groups(self) -> DataFrame:
        """(keys .., l_group, r_group): for every left group the right one that shares most cells with it, if there is any."""
        cells = [
            side.select(*self.keys, F.col(f"{s}_cell").alias("_cell"), f"{s}_group").distinct() for s, side in (("l", self.left), ("r", self.right))
        ]
        shared = cells[0].join(cells[1], [*self.keys, "_cell"]).groupBy(*self.keys, "l_group", "r_group").agg(F.count("*").alias("_n"))
        near = F.struct("_n", -F.abs(F.col("l_group") - F.col("r_group")), "r_group")
        return shared.groupBy(*self.keys, "l_group").agg(F.max_by("r_group", near).alias("r_group"))

    def meet(self, pairs: DataFrame) -> DataFrame:
        """The arrays of both blocks of every pair."""
        left = self.left.drop("l_parts", "l_low", "l_high", "l_group")
        right = self.right.drop("r_parts", "r_low", "r_high", "r_group")
        return pairs.join(left, [*self.keys, "l_cell", "l_part"]).join(right, [*self.keys, "r_cell", "r_part"])

    def meet_groups(self, pairs: DataFrame, compare: Compare, schema: str, floors: DataFrame | None = None) -> DataFrame:
        """What ``compare`` returns for every pair (keys .., l_group, r_group); ``floors`` is (owner .., cell, part, floors).

        ``compare`` takes the values of the owner and both groups and yields record batches.
        """
        owner, at = self.owner, [*self.keys, "l_group", "r_group"]
        sides = []
        for s, blocks in (("l", self.left), ("r", self.right)):
            rest = [c for c in blocks.columns if c.startswith(f"{s}_") and c not in (f"{s}_group", f"{s}_parts")]
            named = blocks.select(*self.keys, f"{s}_group", *[F.col(c).alias(c[2:]) for c in rest], F.lit(s).alias("side"))
            if s == "l" and floors is not None:
                named = named.join(floors, [*owner, "cell", "part"], "left")
            else:
                named = named.withColumn("floors", F.lit(None).cast("array<double>"))
            named = named.withColumn("vector", F.col("vector").cast(self._vectors()))
            sides.append(named.join(pairs, [*self.keys, f"{s}_group"]))
        both = sides[0].unionByName(sides[1], allowMissingColumns=True)
        tree = self.tree

        def walk(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(batches).combine_chunks()
            of_left = np.array(rows["side"].to_pylist()) == "l"
            if of_left.any() and not of_left.all():
                left, right = (Group.of(rows.filter(pa.array(x)), tree) for x in (of_left, ~of_left))
                yield from compare([k.as_py() for k in key[: len(owner)]], left, right)

        return both.groupBy(*at).applyInArrow(walk, schema)

    def _vectors(self) -> str:
        """Vectors travel as they came, if both sides have the same kind."""
        kinds = {dict(side.dtypes)[f"{s}_vector"] for s, side in (("l", self.left), ("r", self.right))}
        return kinds.pop() if len(kinds) == 1 else "array<double>"


@dataclass
class Group:
    """Blocks of a group in a task: their words, unit vectors (also in single precision) and balls."""

    words: list[str]
    floors: np.ndarray  # NaN where none is given
    units: np.ndarray
    single: np.ndarray
    empty: np.ndarray
    edges: np.ndarray  # where blocks begin, and the end
    cell: np.ndarray
    part: np.ndarray
    low: np.ndarray
    high: np.ndarray
    tree: CellTree
    rows: pa.Table

    @classmethod
    def of(cls, rows: pa.Table, tree: CellTree) -> Group:
        lists, vectors = rows["word"].combine_chunks(), rows["vector"].combine_chunks()
        words = lists.flatten().to_pylist()
        sizes = lists.value_lengths().to_numpy()
        matrix = np.asarray(vectors.flatten(), dtype="float64").reshape(len(words), -1)
        units = unit_rows(matrix)
        floors = [np.full(n, np.nan) if f is None else np.array(f, float) for n, f in zip(sizes, rows["floors"].to_pylist())]
        cell, part, low, high = (rows[c].to_numpy() for c in ("cell", "part", "low", "high"))
        edges = np.concatenate([[0], np.cumsum(sizes)])
        return cls(words, np.concatenate(floors), units, units.astype(np.float32), ~matrix.any(1), edges, cell, part, low, high, tree, rows)

    @property
    def margin(self) -> float:
        """How far a product in single precision may be from the cosine."""
        return (self.single.shape[1] + 8) * 2.0**-22

    def blocks(self) -> Iterable[tuple[int, int, int]]:
        return zip(range(len(self.cell)), self.edges[:-1].tolist(), self.edges[1:].tolist())

    def near(self, block: int, other: Group, least: float) -> np.ndarray:
        """Rows of the other group's blocks that can hold a cosine of ``least`` with one of this block."""
        between = self.tree.angle(np.full(len(other.cell), self.cell[block]), other.cell)
        low, high = self.low[block], self.high[block]
        gap = np.maximum.reduce([between - high - other.high, low - between - other.high, other.low - between - high])
        keep = np.cos(np.maximum(gap - MARGIN, 0.0)) >= least
        return np.flatnonzero(np.repeat(keep, np.diff(other.edges)))

    def products(self, low: int, high: int, other: Group, rows: np.ndarray) -> np.ndarray:
        """Cosines in single precision; -1 where a vector has no length, less than all where one has no number."""
        every = len(rows) == len(other.words)
        product = self.single[low:high] @ (other.single if every else other.single[rows]).T
        product[self.empty[low:high], :] = -1.0
        product[:, other.empty[rows]] = -1.0
        return np.nan_to_num(product, copy=False, nan=-np.inf)

    def cosines(self, i: np.ndarray, other: Group, j: np.ndarray) -> np.ndarray:
        """Cosines of the rows ``i`` and ``j``, pair by pair, in double precision."""
        out = np.empty(len(i))
        for at in range(0, len(i), 1 << 14):
            x, y = i[at : at + (1 << 14)], j[at : at + (1 << 14)]
            out[at : at + (1 << 14)] = np.einsum("ij,ij->i", self.units[x], other.units[y])
        out[self.empty[i] | other.empty[j]] = -1.0
        return out


Compare = Callable[[list, Group, Group], Iterator[pa.RecordBatch]]
