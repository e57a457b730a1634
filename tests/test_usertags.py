"""Tag thresholds, blacklists and ranked tag lists."""

import random

import numpy as np
import pytest

from clickloom.operators import usertags


@pytest.mark.parametrize("n", [1, 3, 499, 500, 501, 777])
def test_threshold_is_numpy_percentile(spark, n):
    rng = random.Random(n)
    counts = [rng.randint(0, 40) for _ in range(n)]
    df = spark.createDataFrame([("w", f"t{i}", c) for i, c in enumerate(counts)], "web_id string, usertag string, token_count long")
    if n < 500:
        limit = np.mean(counts) - 50
        want = {f"t{i}" for i, c in enumerate(counts) if c > 2 and c > limit}
    else:
        limit = np.percentile(counts, 100 * (1 - 500 / n))
        want = {f"t{i}" for i, c in enumerate(counts) if c > limit}
    assert usertags.tag_limits(df).first().freq_limit == pytest.approx(limit)
    assert {r.usertag for r in usertags.above_threshold(df).collect()} == want


def test_mean_limit_uses_all_tags(spark):
    rows = [("w", "rare", 1), ("w", "low", 30), ("w", "high", 400)]
    df = spark.createDataFrame(rows, "web_id string, usertag string, token_count long")
    assert {r.usertag for r in usertags.above_threshold(df).collect()} == {"high"}  # mean - 50 = 93.67


def test_ranked_tags_swap_by_price(spark):
    kind = "web_id string, uuid string, keyword string, freq long"
    old = spark.createDataFrame([("w", "u", "a", 9), ("w", "u", "b", 5)], kind)
    new = spark.createDataFrame([("w", "u", "b", 3), ("w", "u", "c", 2), ("w", "u", "d", 1)], kind)
    prices = spark.createDataFrame([("a", 5), ("c", 50), ("d", 3)], "keyword string, price long")
    rows = usertags.rank_user_tags(old, new, prices, limit=2, challengers=2, sample=2).collect()
    # kept a (9, price 5) and b (8, price 0); c (50) takes b's slot, d (3) is not worth more than a
    assert {(r.keyword, r.freq) for r in rows} == {("a", 9), ("c", 2)}


def test_ranked_tags_without_challengers(spark):
    kind = "web_id string, uuid string, keyword string, freq long"
    old = spark.createDataFrame([("w", "u", "a", 1)], kind)
    prices = spark.createDataFrame([], "keyword string, price long")
    assert [r.keyword for r in usertags.rank_user_tags(old, old, prices, 5, 5).collect()] == ["a"]
