"""Approximate nearest neighbours by a hierarchical k-means tree with best-bin-first search.

The tree is fitted on at most ``SAMPLE`` vectors (those with the smallest hashes of their ids) and every vector
of the table is put into the leaf that it reaches by following the nearest centre. A query pops branches from a
priority queue by the distance of their centres and so meets leaves from the most to the least promising. How
many leaves it visits is calibrated: for at most ``PROBES`` vectors the exact neighbours are found by comparing
them with every vector, and visits are widened until these leaves hold ``recall`` of them.

The first ``FIRST`` leaves of a query give a distance that its k-th neighbour does not exceed; the others report only
what is no farther. A visit is a row of numbers. Neighbouring leaves share a block of about ``PART`` numbers, a larger
leaf is split, and a query's vector travels once to a block, with the leaves it visits there. Matrix products rule
rows out; the distances of what is left are worked out one by one. Of equal vectors only the smallest ids can be among
the k nearest, so only k + 1 are indexed; that loses nothing, as ties go to the smaller id.

Edge cases: vectors that are null, zero, of another length than most or hold null or non-finite components take no
part, nor do rows without an id; rows that repeat count once; of several vectors with one query id the smallest is
searched; a query with fewer than k other vectors gets all of them; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import keyed, shares
from clickloom.session import materialise

SAMPLE = 20_000
PROBES = 200
BRANCH = 8
LEAF_ROWS = 200
PART = 1 << 18  # numbers of the vectors of a block, and of the queries that meet it at once
VISIT_ROWS = 1 << 16  # visits that a worker hands on at once
CELLS = 1 << 20  # of a matrix of distances
ROUNDING = 1e-9  # of a squared length; what the products leave open is far less
RECALL = 0.96
FIRST = 4
QUERIES = 128  # whose visits a task plans
FOUND = "query_id bigint, vec_id bigint, score double"


def nearest_centre(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1) - 2 * rows @ centres.T).argmin(1)


def k_means(rows: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    """At most ``k`` centres; seeds are drawn in proportion to the squared distance from those before."""
    centres = [rows[rng.integers(len(rows))]]
    gap = ((rows - centres[0]) ** 2).sum(1)
    while len(centres) < k and gap.sum() > 0:
        centres.append(rows[rng.choice(len(rows), p=gap / gap.sum())])
        gap = np.minimum(gap, ((rows - centres[-1]) ** 2).sum(1))
    found = np.array(centres)
    for _ in range(rounds):
        near = nearest_centre(rows, found)
        used = np.unique(near)
        found = np.array([rows[near == i].mean(0) for i in used])
    return found


@dataclass
class Tree:
    """Nodes by number, 0 the root; ``centres`` and ``children`` of inner nodes, ``leaf`` of the others."""

    centres: dict[int, np.ndarray] = field(default_factory=dict)
    children: dict[int, list[int]] = field(default_factory=dict)
    leaf: dict[int, int] = field(default_factory=dict)

    @classmethod
    def fit(cls, rows: np.ndarray, leaf_rows: int, branch: int = BRANCH, seed: int = 7) -> Tree:
        tree, rng, todo, nodes = cls(), np.random.default_rng(seed), [(0, rows)], 1
        while todo:
            node, mine = todo.pop()
            centres = k_means(mine, branch, rng) if len(mine) > leaf_rows else mine[:0]
            if len(centres) < 2:
                tree.leaf[node] = len(tree.leaf)
                continue
            tree.centres[node], tree.children[node] = centres, list(range(nodes, nodes + len(centres)))
            near = nearest_centre(mine, centres)
            todo += [(nodes + i, mine[near == i]) for i in range(len(centres))]
            nodes += len(centres)
        return tree

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of every row."""
        out, todo = np.zeros(len(rows), np.int64), [(0, np.arange(len(rows)))]
        while todo:
            node, at = todo.pop()
            if node in self.leaf:
                out[at] = self.leaf[node]
            elif len(at):
                near = nearest_centre(rows[at], self.centres[node])
                todo += [(child, at[near == i]) for i, child in enumerate(self.children[node])]
        return out

    def visits(self, query: np.ndarray) -> Iterator[int]:
        """Leaves, best bin first."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            while node not in self.leaf:
                far = ((self.centres[node] - query) ** 2).sum(1)
                best = int(far.argmin())
                for i, child in enumerate(self.children[node]):
                    if i != best:
                        heapq.heappush(queue, (float(far[i]), child))
                node = self.children[node][best]
            yield self.leaf[node]


def usable(vector: Column) -> Column:
    """Neither null nor zero, all components finite."""
    fine = F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(x))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(vectors: Iterable) -> np.ndarray:
    return np.array([np.asarray(v, np.float64) for v in vectors])


def nearest(query: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and Euclidean distances of the k nearest rows, ties to the smaller id."""
    far = np.sqrt(((rows - query) ** 2).sum(1))
    at = np.arange(len(far))
    if len(far) > k:
        at = np.flatnonzero(far <= np.partition(far, k - 1)[k - 1])
    at = at[np.lexsort((ids[at], far[at]))][:k]
    return ids[at], far[at]


def found_rows(found: list[tuple[int, np.ndarray, np.ndarray]]) -> pd.DataFrame:
    """(query_id, vec_id, score) of lists of neighbours by query."""
    queries = np.repeat([i for i, _, _ in found], [len(ids) for _, ids, _ in found])
    columns = [np.concatenate(part) for part in zip(*((ids, far) for _, ids, far in found), strict=True)]
    return pd.DataFrame({"query_id": queries, "vec_id": columns[0], "score": columns[1]})


@dataclass
class Index:
    tree: Tree
    rows: DataFrame  # vec_id, vector, leaf
    sizes: dict[int, int]  # rows by leaf
    width: int = 1  # numbers of a vector
    visits: int = 1

    @property
    def part(self) -> int:
        """Vectors of a block."""
        return max(1, PART // self.width)


def _valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    rows = keyed(vectors, id_col).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where(usable(F.col("vector")))
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vector") == (lengths["n"] if lengths else 0)).dropDuplicates(["vec_id", "vector"])


def build_index(rows: DataFrame, k: int, recall: float = RECALL) -> Index:
    """``rows`` (vec_id, vector): the tree, every row's leaf, and calibrated visits."""
    by_id = Window.partitionBy("vector").orderBy("vec_id")
    rows = materialise(rows.withColumn("_n", F.row_number().over(by_id)).where(F.col("_n") <= k + 1).drop("_n"), "vectors")
    total = rows.count()
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toPandas()
    if not total:
        return Index(Tree(leaf={0: 0}), rows.withColumn("leaf", F.lit(0).cast("long")), {})
    points = matrix(sample["vector"])
    tree = Tree.fit(points, max(8, LEAF_ROWS * len(points) // total))

    def put(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(leaf=tree.assign(matrix(batch["vector"])))

    placed = materialise(rows.mapInPandas(put, "vec_id bigint, vector array<double>, leaf bigint"), "leaves")
    sizes = {r["leaf"]: r["count"] for r in placed.groupBy("leaf").count().collect()}  # at most one a sampled row
    index = Index(tree, placed, sizes, points.shape[1])
    index.visits = calibrated_visits(index, sample.head(PROBES), k, recall)
    return index


def calibrated_visits(index: Index, probes: pd.DataFrame, k: int, recall: float) -> int:
    """The fewest leaves that hold ``recall`` of the exact neighbours of ``probes``."""
    ids, points = probes["vec_id"].to_numpy(), matrix(probes["vector"])

    def exact(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            rows, own, out = matrix(batch["vector"]), batch["vec_id"].to_numpy(), []
            for i, point in zip(ids, points, strict=True):
                found, far = nearest(point, rows[own != i], own[own != i], k)
                out.append((i, found, far))
            yield found_rows(out)

    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    true = index.rows.mapInPandas(exact, FOUND).withColumn("n", F.row_number().over(best)).where(F.col("n") <= k)
    by_query = true.join(index.rows, "vec_id").select("query_id", "leaf").toPandas().groupby("query_id")["leaf"].apply(list).to_dict()
    places = []
    for i, point in zip(ids, points, strict=True):
        place = {leaf: n for n, leaf in enumerate(index.tree.visits(point), 1)}
        places += [place[leaf] for leaf in by_query.get(i, [])]
    return int(np.quantile(places, recall, method="higher")) if places else 1


VISITS = "query_id bigint, leaf bigint, visit int"


def planned_visits(index: Index, queries: DataFrame, k: int) -> DataFrame:
    """The leaves that every query visits, by number of the visit."""
    tree, sizes, wanted = index.tree, index.sizes, index.visits

    def plan(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, leaves, numbers, held = [], [], [], 0
            for i, vector in zip(batch["query_id"], batch["vector"], strict=True):
                seen, mine, at = 0, [], []
                for n, leaf in enumerate(tree.visits(np.asarray(vector, np.float64)), 1):
                    if n > wanted and seen > k:  # all promising leaves, and enough rows besides itself
                        break
                    if sizes.get(leaf):
                        seen += sizes[leaf]
                        mine.append(leaf)
                        at.append(n)
                ids.append(np.full(len(mine), i, np.int64))
                leaves.append(np.array(mine, np.int64))
                numbers.append(np.array(at, np.int32))
                held += len(mine)
                if held > VISIT_ROWS:
                    yield pd.DataFrame({"query_id": np.concatenate(ids), "leaf": np.concatenate(leaves), "visit": np.concatenate(numbers)})
                    ids, leaves, numbers, held = [], [], [], 0
            if held:
                yield pd.DataFrame({"query_id": np.concatenate(ids), "leaf": np.concatenate(leaves), "visit": np.concatenate(numbers)})

    return queries.mapInPandas(plan, VISITS)


def leaf_blocks(sizes: dict[int, int], part: int) -> list[tuple[int, int, int]]:
    """(leaf, first block, blocks): neighbouring leaves share a block of about ``part`` rows, a larger leaf has several."""
    out, block, held = [], 0, 0
    for leaf, n in sorted(sizes.items()):
        if held and held + n > part:
            block, held = block + 1, 0
        parts = shares(n, part)
        out.append((leaf, block, parts))
        block, held = (block + parts, 0) if parts > 1 else (block, held + n)
    return out


def nearest_of_leaves(points: np.ndarray, visits: Iterable[np.ndarray], within: np.ndarray, own: np.ndarray, rows: np.ndarray, ids: np.ndarray, leaf: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, distance): per query ``points`` the k nearest ``rows`` of the leaves it ``visits`` that are ``within`` and not its ``own``."""
    order = np.argsort(leaf, kind="stable")
    rows, ids, leaf = rows[order], ids[order], leaf[order]
    visits = list(visits)
    asked = np.concatenate([np.asarray(v, np.int64) for v in visits])
    asking = np.repeat(np.arange(len(visits)), [len(v) for v in visits])
    order = np.argsort(asked, kind="stable")
    asked, asking = asked[order], asking[order]
    sizes, lengths = (points**2).sum(1), (rows**2).sum(1)
    out = []
    for name in np.unique(asked):
        low, high = np.searchsorted(leaf, name), np.searchsorted(leaf, name, "right")
        who = asking[np.searchsorted(asked, name) : np.searchsorted(asked, name, "right")]
        step = max(1, CELLS // max(1, high - low))
        for some in (who[x : x + step] for x in range(0, len(who) if high > low else 0, step)):
            far = sizes[some][:, None] + lengths[low:high] - 2 * points[some] @ rows[low:high].T
            margin = ROUNDING * (sizes[some] + lengths[low:high].max())
            far[own[some][:, None] == ids[low:high]] = np.inf
            limit = within[some] ** 2 * (1 + ROUNDING) + margin
            if high - low > k:
                limit = np.minimum(limit, np.partition(far, k - 1, axis=1)[:, k - 1] + 2 * margin)
            i, j = np.nonzero(~(far > limit[:, None]) & (own[some][:, None] != ids[low:high]))  # what is no number stays
            i, j = some[i], j + low
            exact = np.sqrt(((rows[j] - points[i]) ** 2).sum(1))
            near = exact <= within[i]
            out.append((i[near], ids[j[near]], exact[near]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    i, found, far = (np.concatenate(part) for part in zip(*out, strict=True))
    order = np.lexsort((found, far, i))
    i, found, far = i[order], found[order], far[order]
    best = np.arange(len(i)) - np.searchsorted(i, i) < k
    return i[best], found[best], far[best]


def compared(index: Index, visits: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): up to k rows per query (query_id, vector, within) and block of visited leaves that are ``within``."""
    spark = index.rows.sparkSession
    asked = {r["leaf"] for r in visits.select("leaf").distinct().collect()}  # at most one a sampled row
    places = leaf_blocks({leaf: n for leaf, n in index.sizes.items() if leaf in asked}, index.part)
    places = F.broadcast(spark.createDataFrame(places or [(-1, 0, 1)], "leaf bigint, first bigint, parts int"))
    query_parts = shares(queries.count(), index.part)
    part = F.pmod(F.xxhash64("query_id"), F.lit(query_parts)).alias("query_part")
    blocks = F.explode(F.sequence("first", F.col("first") + F.col("parts") - 1)).alias("block")
    met = visits.join(places, "leaf").select("query_id", "leaf", blocks).groupBy("query_id", "block").agg(F.collect_list("leaf").alias("leaves"))
    asking = met.join(queries, "query_id").select("query_id", "vector", "within", "leaves", "block", part)
    block = (F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("parts"))).alias("block")
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_parts - 1).cast("long"))).alias("query_part")
    rows = index.rows.join(places, "leaf").select("vec_id", "vector", "leaf", block, parts)

    def compare(key: tuple, asking: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if asking.empty or rows.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        own, within = asking["query_id"].to_numpy(), asking["within"].to_numpy()
        there = matrix(rows["vector"]), rows["vec_id"].to_numpy(), rows["leaf"].to_numpy()
        i, found, far = nearest_of_leaves(matrix(asking["vector"]), asking["leaves"], within, own, *there, k)
        return pd.DataFrame({"query_id": own[i], "vec_id": found, "score": far})

    keys = ["block", "query_part"]
    return asking.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(compare, FOUND)


def ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(index: Index, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found for ``queries`` (query_id, vector)."""
    queries = materialise(queries, "queries")
    dealt = queries.repartition(shares(queries.count(), QUERIES), "query_id")
    visits = materialise(planned_visits(index, dealt, k), "visits")
    anything = F.lit(float("inf"))
    early = materialise(ranked(compared(index, visits.where(F.col("visit") <= FIRST), queries.withColumn("within", anything), k), k), "early")
    limits = early.where(F.col("rank") == k).select("query_id", F.col("score").alias("within"))
    limited = materialise(queries.join(limits, "query_id", "left").withColumn("within", F.coalesce("within", anything)), "limited")
    return ranked(early.drop("rank").unionByName(compared(index, visits.where(F.col("visit") > FIRST), limited, k)), k)


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", recall: float = RECALL) -> DataFrame:
    """The k nearest other rows of every row for which ``is_query`` (over ``vec_id``) holds."""
    rows = materialise(_valid(vectors, id_col, vector_col), "vectors")
    queries = rows.where(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("vector"))
    return search(build_index(rows, k, recall), queries, k)
