"""Blocks as balls: bounds and results against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.operators import balls, similarity


def clustered(rng, groups=12, each=60, width=10, spread=0.08):
    """Near groups of vectors in random directions."""
    heads = balls.unit_rows(rng.standard_normal((groups, width)))
    rows = np.repeat(heads, each, axis=0) + spread * rng.standard_normal((groups * each, width))
    return rows * rng.uniform(0.2, 5, (len(rows), 1))


def frame(spark, rows, tenants=1):
    data = [(f"t{i % tenants}", f"w{i}", None if r is None else [float(x) for x in r]) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "web_id string, word string, vector array<double>").repartition(4)


def cosines(rows):
    unit = balls.unit_rows(np.array(rows, float))
    return unit @ unit.T


def in_block(spark, index, side):
    return {(r[0], r[1]): set(r[2]) for r in getattr(index, "left" if side == "l" else "right").select(f"{side}_cell", f"{side}_part", f"{side}_word").collect()}


def test_few_block_pairs_hold_every_close_pair(spark):
    rows = clustered(np.random.default_rng(1))
    words = frame(spark, rows).drop("web_id")
    index = balls.BallIndex.of(words, words, (), block=30)
    kept = [tuple(r) for r in index.near_pairs(0.8).select("l_cell", "l_part", "r_cell", "r_part").collect()]
    blocks = in_block(spark, index, "l")
    assert len(kept) == len(set(kept)) < 0.25 * len(blocks) ** 2, (len(kept), len(blocks))
    met = {(a, b) for lc, lp, rc, rp in kept for a in blocks[lc, lp] for b in blocks[rc, rp]}
    i, j = np.nonzero(cosines(rows) >= 0.8)
    assert {(f"w{a}", f"w{b}") for a, b in zip(i, j, strict=True)} <= met
    # a lower threshold keeps more, none keeps all
    assert index.near_pairs(-1.0).count() == len(blocks) ** 2


def test_vectors_stay_where_blocks_are_apart(spark):
    rows = np.concatenate([clustered(np.random.default_rng(k), 1, 200, 6, 0.01) + 50 * np.eye(6)[k % 6] for k in range(4)])
    words = frame(spark, rows).drop("web_id")
    index = balls.BallIndex.of(words, words, (), block=200)
    assert index.meet(index.near_pairs(0.95)).count() == index.left.count()


@pytest.mark.parametrize("block", [7, 40, 5000])
def test_close_pairs_by_brute_force(spark, block):
    rng = np.random.default_rng(block)
    rows = [*clustered(rng, 5, 30), *rng.standard_normal((40, 10)), np.zeros(10), np.zeros(10), None]
    words = frame(spark, rows, tenants=3)
    got = {(r.word, r.other): r.similarity for r in similarity.close_pairs(words, 0.5, block).collect()}
    known = [r if r is not None else np.zeros(10) for r in rows]
    c = cosines(known)
    want = {(f"w{i}", f"w{j}"): c[i, j] for i, j in zip(*np.nonzero(np.round(c, 9) >= 0.5), strict=True) if i != j and i % 3 == j % 3}
    assert got.keys() == want.keys() and len(want) > 500
    assert np.allclose([got[k] for k in want], list(want.values()), atol=1e-8)


@pytest.mark.parametrize("block", [9, 60])
def test_nearest_by_brute_force(spark, block):
    rng = np.random.default_rng(block)
    rows = [*clustered(rng, 8, 25), np.zeros(10), *([np.ones(10)] * 3)]
    words = frame(spark, rows).drop("web_id")
    got = {}
    for r in similarity.nearest(words, words, 4, block).orderBy("word", F.desc("similarity"), "other").collect():
        got.setdefault(r.word, []).append(r.other)
    c = np.round(cosines(rows), 9)
    c[~np.array(rows).any(1), :] = c[:, ~np.array(rows).any(1)] = -1
    for i in range(len(rows)):
        best = sorted((j for j in range(len(rows)) if j != i), key=lambda j: (-c[i, j], f"w{j}"))[:4]
        assert got[f"w{i}"] == [f"w{j}" for j in best]


def test_floors_leave_few_pairs(spark):
    words = frame(spark, clustered(np.random.default_rng(5), 16, 40, spread=0.03)).drop("web_id")
    seen = []
    kept = balls.BallIndex.near_pairs

    def counted(self, least):
        pairs = kept(self, least)
        seen.append((pairs.count(), self.left.count() ** 2))
        return pairs

    balls.BallIndex.near_pairs = counted
    try:
        similarity.nearest(words, words, 3, 40).count()
    finally:
        balls.BallIndex.near_pairs = kept
    assert seen[0][0] < 0.3 * seen[0][1]


def test_empty_sides(spark):
    none = frame(spark, []).limit(0)
    some = frame(spark, np.eye(3), tenants=2)
    assert similarity.close_pairs(none, 0.5).count() == 0
    assert similarity.trend_catalogue_match(some, none).count() == similarity.trend_catalogue_match(none, some, keys=()).count() == 0
    assert similarity.nearest(none.drop("web_id"), some.drop("web_id")).count() == similarity.keyword_similarity(none).count() == 0


def test_tree_bounds_hold_for_any_centres():
    rng = np.random.default_rng(3)
    a, b = balls.unit_rows(rng.standard_normal((300, 5))), balls.unit_rows(rng.standard_normal((300, 5)))
    tree = balls.fit_tree(rng.standard_normal((50, 5)), 4)
    (ca, ta), (cb, tb) = tree.cells(a, np.full(300, 4)), tree.cells(b, np.full(300, 4))
    between = tree.angle(ca, cb)
    gap = np.maximum.reduce([between - ta - tb, ta - between - tb, tb - between - ta])
    assert (np.arccos(np.clip((a * b).sum(1), -1, 1)) >= gap - 1e-7).all()
