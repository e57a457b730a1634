"""Upserts, block similarity and forecasts against brute force."""

import datetime as dt
import inspect
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.functions import edits
from clickloom.functions.edits import edit_distance
from clickloom.operators import ad_scores, balls, forecast, joins, ml, reports, rollups, similarity, stats, trends
from clickloom.sinks import merge
from clickloom.streaming.sinks import upsert_sink


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_upserts(spark):
    kind = "k long, a string, b string"
    old = spark.createDataFrame([(1, "a1", "b1"), (2, "a2", "b2")], kind)
    new = spark.createDataFrame([(2, None, "n2"), (3, "n3", "n3")], kind)
    assert {r[0]: tuple(r[1:]) for r in merge.upsert(old, new, ["k"]).collect()} == {1: ("a1", "b1"), 2: (None, "n2"), 3: ("n3", "n3")}
    assert {r[0]: tuple(r[1:]) for r in merge.upsert(old, new, ["k"], ["a"]).collect()} == {1: ("a1", "b1"), 2: (None, "b2"), 3: ("n3", "n3")}
    assert {r[0]: r[1] for r in merge.update_where(old, new, ["k"], ["a"]).collect()} == {1: "a1", 2: None}
    assert [r.k for r in merge.insert_ignore(old, new, ["k"]).collect()] == [3]


def test_replayed_batch_leaves_the_table_alone(spark, tmp_path):
    root = str(tmp_path / "table")
    write = upsert_sink(root, ["k"], newest=[F.desc("v")])
    first = spark.createDataFrame([(i, i) for i in range(20)], "k long, v long")
    second = spark.createDataFrame([(5, 50), (5, 7), (99, 1)], "k long, v long")
    write(first, 0)
    write(second, 1)
    once = rows_of(merge.read_merged(spark, root))
    write(second, 1)
    assert rows_of(merge.read_merged(spark, root)) == once
    assert (5, 50) in once and (99, 1) in once and len(once) == 21


def test_merge_rewrites_only_touched_days(spark, tmp_path):
    root = tmp_path / "table"
    kind = "day int, k long, v long"
    merge.merge_into(spark.createDataFrame([(1, i, 0) for i in range(30)], kind), str(root), ["day", "k"], by=["day"])
    stamps = {p: p.stat().st_mtime_ns for p in root.glob("day=1/*/*.parquet")}
    merge.merge_into(spark.createDataFrame([(2, 7, 1)], kind), str(root), ["day", "k"], by=["day"])
    merge.merge_into(spark.createDataFrame([(2, 7, 2), (2, 8, 3)], kind), str(root), ["day", "k"], by=["day"])
    assert {p: p.stat().st_mtime_ns for p in root.glob("day=1/*/*.parquet")} == stamps
    rows = {(r.day, r.k): r.v for r in merge.read_merged(spark, str(root)).collect()}
    assert len(rows) == 32 and rows[(2, 7)] == 2 and rows[(2, 8)] == 3


@pytest.mark.parametrize("bound", [1000, 1])
def test_merge_reads_touched_partitions_only(spark, tmp_path, bound):
    root, kind = str(tmp_path / "table"), "day int, k long, v long"
    rows = spark.range(40 * 20).select(F.floor(F.col("id") / 20).cast("int").alias("day"), (F.col("id") % 20).alias("k"), F.lit(0).cast("long").alias("v"))
    merge.merge_into(rows, root, ["day", "k"], by=["day"], buckets=4)
    table = spark.read.parquet(root)
    fresh = spark.createDataFrame([(day, 1, 5, b) for day in (7, 9) for b in range(4)], f"{kind}, bucket int")
    found = merge.touched_rows(table, fresh, ["day", "bucket"], bound)
    plan = found._jdf.queryExecution().executedPlan().toString()
    wanted = "day#\\d+ IN \\(7,9\\)" if bound > 1 else "day#\\d+ >= 7.*day#\\d+ <= 9"
    assert re.search(rf"PartitionFilters: \[.*{wanted}", plan), plan
    assert sorted((r.day, r.k) for r in found.collect()) == [(day, k) for day in (7, 9) for k in range(20)]
    merge.merge_into(spark.createDataFrame([(7, 1, 5), (9, 2, 5), (41, 1, 1)], kind), root, ["day", "k"], by=["day"], buckets=4)
    after = {(r.day, r.k): r.v for r in merge.read_merged(spark, root).collect()}
    assert after[41, 1] == 1 and sum(v == 5 for v in after.values()) == 2


def test_edit_distance_is_unrestricted():
    assert edit_distance("ca", "abc") == 2
    assert edit_distance("", "abc") == 3
    assert edit_distance("same", "same") == 0


def make_words(seed, n, tenants=2):
    rng = random.Random(seed)
    letters = "abcde"
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n)}
    return [(f"t{i % tenants}", w, [rng.gauss(0, 1) for _ in range(6)]) for i, w in enumerate(sorted(words))]


def cosine(a, b):
    return float(np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b))


@pytest.mark.parametrize("block", [5, 1000])
def test_keyword_similarity_is_exact(spark, block):
    words = make_words(2, 60)
    df = spark.createDataFrame([*words, ("t0", "unknown", None)], "web_id string, word string, vector array<double>")
    got = {}
    for r in similarity.keyword_similarity(df, k=4, block=block).collect():
        got.setdefault((r.web_id, r.keyword), []).append((round(-r.score, 9), r.keyword_related))
    for tenant, word, vector in words:
        scores = [
            (round(-(2 * cosine(vector, v) - edit_distance(word, w) / len(word)), 9), w)
            for t, w, v in words
            if t == tenant
        ]
        assert sorted(got[(tenant, word)]) == sorted(s for s in scores if -s[0] > 0.09)[:4]


def test_match_ads_is_exact(spark):
    words = make_words(7, 50, 1)
    kind = "owner string, word string, vector array<double>"
    arts = [(f"a{i // 3}", w, None if i % 7 == 0 else v) for i, (_, w, v) in enumerate(words)]
    ads = [(f"d{i // 4}", w, None if i % 11 == 0 else v) for i, (_, w, v) in enumerate(reversed(words))]
    a = spark.createDataFrame(arts, kind).withColumnRenamed("owner", "article_id")
    d = spark.createDataFrame(ads, kind).withColumnRenamed("owner", "ad_id")
    got = {r.article_id: (r.ad_id, r.keyword) for r in similarity.match_ads(a, d, block=6).collect()}

    def sim(x, y):
        return -1.0 if x is None or y is None else cosine(x, y)

    for article in {r[0] for r in arts}:
        own = [v for o, _, v in arts if o == article]
        best = None
        for ad in sorted({r[0] for r in ads}):
            upper = {w: np.mean(s) + np.std(s) for o, w, v in ads if o == ad for s in [[sim(v, x) for x in own]]}
            values = [round(float(u), 9) for u in upper.values()]
            score = round(float(np.mean(list(upper.values())) + np.std(list(upper.values()))), 9)
            word = min(w for w in upper if round(float(upper[w]), 9) == max(values))
            if best is None or score > best[0]:
                best = (score, ad, word)
        assert got[article] == best[1:]


def brute_ads(articles, ads):
    """By article the ad, the word inside it and the score, all pairs in double precision."""
    out = []
    for n, low in zip(articles.counts, articles.starts):
        best = None
        for ad, (m, start) in enumerate(zip(ads.counts, ads.starts)):
            sims = articles.units[low : low + n] @ ads.units[start : start + m].T
            sims[articles.empty[low : low + n]] = -1
            sims[:, ads.empty[start : start + m]] = -1
            upper = sims.mean(0) + sims.std(0)
            score = upper.mean() + upper.std()
            if best is None or round(score, 9) > round(best[2], 9):
                best = (ad, int(np.argmax(np.round(upper, 9))), score)
        out.append(best)
    return out


@pytest.mark.parametrize("width", [2, 16])
def test_best_ads_by_brute_force(monkeypatch, width):
    monkeypatch.setattr(ad_scores, "ARTICLES", 5)
    monkeypatch.setattr(ad_scores, "WORDS", 11)
    monkeypatch.setattr(ad_scores, "NUMBERS", 40)
    rng = np.random.default_rng(width)

    def side(counts, near):
        rows = rng.standard_normal((sum(counts), width))
        rows[::3] = near + rng.choice([0, 1e-7, 1e-9], (len(rows[::3]), 1)) * rng.standard_normal((len(rows[::3]), width))
        units, empty = rows / np.linalg.norm(rows, axis=1, keepdims=True), rng.random(len(rows)) < 0.15
        units[empty] = 0
        return ad_scores.Words.of(units, empty, np.repeat(np.arange(len(counts)), counts))

    near = rng.standard_normal(width)
    for _ in range(4):
        articles = side([*rng.integers(1, 7, 12), 40], near)
        ads = side([*rng.integers(1, 5, 30), 25], near)
        got = list(zip(*ad_scores.best_ads(articles, ads)))
        for (ad, word, score), want in zip(got, brute_ads(articles, ads), strict=True):
            assert (ad, word) == want[:2] and abs(score - want[2]) < 1e-12
    twice = ad_scores.Words.of(np.tile(ads.units, (2, 1)), np.tile(ads.empty, 2), np.repeat(np.arange(62), np.tile(ads.counts, 2)))
    assert [a.tolist() for a in ad_scores.best_ads(articles, twice)] == [list(x) for x in zip(*got)] and len(twice.once()) <= 31
    odd = ads.units.copy()
    odd[ads.starts[3]] = odd[ads.starts[7]] = np.nan
    found = ad_scores.best_ads(articles, ad_scores.Words.of(odd, np.zeros(len(odd), bool), np.repeat(np.arange(31), ads.counts)))
    unknown = np.bitwise_and.reduceat(articles.empty, articles.starts)
    assert (found[0] == np.where(unknown, 0, 3)).all() and (np.isnan(found[2]) == ~unknown).all() and (found[2][unknown] == -1).all()


def test_blocks_grow_where_there_are_many(spark):
    rows = spark.range(4000).select(F.col("id").cast("string").alias("word"), F.array(F.lit(1.0)).alias("vector"))
    few = rows.where("word < '2'").where("length(word) < 3")  # 0, 1 and 10 to 19
    for copies, blocks in ((None, 400), (100, 100), (4, 100), (1000, 400)):
        assert similarity.block_pairs(rows, few, (), 10, copies=copies).count() == blocks * 2


def plain_forecast(signal, ahead, harmonics=None):
    n = len(signal)
    t = np.arange(1, n + 1)
    slope = np.polyfit(t, signal, 1)[0]
    spectrum = np.fft.fft(signal - slope * t)[: n // 2]
    freq = np.linspace(0, 1, n)[: n // 2]
    strongest = sorted(range(n // 2), key=lambda i: -abs(spectrum[i]))[: 1 + (n if harmonics is None else harmonics)]
    days = np.arange(1, n + ahead + 1)
    out = sum(abs(spectrum[i]) / n * np.cos(2 * np.pi * freq[i] * days + np.angle(spectrum[i])) for i in strongest)
    return np.maximum(out + slope * days, 0)


@pytest.mark.parametrize(
    "signal",
    [np.zeros(40), np.eye(40)[7] * 9, np.round(50 + 20 * np.cos(np.arange(40) / 3)), np.arange(40) * 3.0],
)
def test_extrapolation(signal):
    for harmonics in (None, 3):
        got = forecast.extrapolate(signal[None, :], 7, harmonics)[0]
        assert np.allclose(got, plain_forecast(signal, 7, harmonics), atol=1e-8)


def test_forecast_pads_and_truncates(spark):
    start = dt.date(2024, 1, 1)
    rows = [("i", start + dt.timedelta(days=3), 10.9), ("i", start + dt.timedelta(days=20), 5.2)]
    df = spark.createDataFrame(rows, "item string, date date, v double")
    signal = np.zeros(30)
    signal[3], signal[20] = 10, 5
    want = plain_forecast(signal, 7)
    row = forecast.forecast(df, ["item"], "v", start, start + dt.timedelta(days=29)).first()
    assert row.revenue_l7 == pytest.approx(want[-14:-7].mean())
    assert row.revenue_f7 == pytest.approx(want[-7:].mean())


def test_histograms_match_numpy(spark):
    values = [1.0, 1.5, 2.0, 2.5, 3.0, 3.0, 9.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    want, edges = np.histogram(values, 4)
    got = stats.histogram(df, "v", 4).orderBy("bin").collect()
    assert [r["count"] for r in got] == list(want)
    assert [round(r.center, 9) for r in got] == [round(float(a + b) / 2, 9) for a, b in zip(edges, edges[1:])]
    flat = stats.histogram(spark.createDataFrame([(2.0,), (2.0,)], "v double"), "v", 2).orderBy("bin").collect()
    assert [r["count"] for r in flat] == list(np.histogram([2.0, 2.0], 2)[0])
    edge = np.arange(1, 9 + 1, 2)
    want = np.histogram(values, edge)[0]
    got = stats.histogram_width(df, "v", 2.0, 1.0, 9.0).orderBy("bin").collect()
    assert [r["count"] for r in got] == list(want)


def test_trend_forms_and_hour_rule(spark):
    kind = "k string, pageviews long"
    now = spark.createDataFrame([("up", 30), ("new", 5), ("zero", 4)], kind)
    last = spark.createDataFrame([("up", 20), ("zero", 0), ("gone", 9)], kind)
    by_last = {r.k: r.trend for r in trends.trend(now, last, ["k"]).collect()}
    by_now = {r.k: round(r.trend, 6) for r in trends.trend(now, last, ["k"], base="now").collect()}
    assert by_last == {"up": 0.5, "new": 0.0, "zero": 0.0}
    assert by_now == {"up": 33.333333, "new": 0.0, "zero": 100.0}
    hours = spark.createDataFrame([("a", 0, 4), ("a", 1, 9), ("a", 3, 12)], "k string, hour int, pageviews long")
    got = {r.hour: r.pageviews_hour for r in trends.hour_delta(hours, ["k"]).collect()}
    assert got == {0: 4, 1: 5, 3: 12}


def test_table_keeps_its_buckets(spark, tmp_path):
    root, kind = str(tmp_path / "t"), "day int, k long, v string"
    merge.merge_into(spark.createDataFrame([(1, i, "a") for i in range(40)], kind), root, ["day", "k"], by=["day"], buckets=3)
    merge.merge_into(spark.createDataFrame([(1, 5, "b"), (2, 5, "c")], kind), root, ["day", "k"], by=["day"], buckets=7)
    rows = {(r.day, r.k): r.v for r in merge.read_merged(spark, root).collect()}
    assert len(rows) == 41 and rows[1, 5] == "b" and rows[2, 5] == "c"
    assert {r.bucket for r in spark.read.parquet(root).select("bucket").distinct().collect()} <= {0, 1, 2}
    assert merge.table_buckets(spark, root, 9) == 3


def test_keywords_of_very_many_articles(spark):
    """Beyond ten thousand articles a keyword is listed like any other."""
    hot = spark.range(12_000).select(F.lit("w").alias("web_id"), F.lit("hot").alias("keyword"), F.concat(F.lit("a"), "id").alias("article_id"), F.lit(dt.date(2024, 1, 30)).alias("date"))
    cold = spark.createDataFrame([("w", "cold", "a1", dt.date(2024, 1, 1))], hot.schema)
    got = reports.keyword_articles(hot.unionByName(cold).unionByName(cold), dt.date(2024, 1, 31), {"month": 30}).collect()
    assert len(got) == 12_001 and {r.article_count for r in got if r.keyword == "hot"} == {12_000}
    assert [(r.article_id, r.days, r.article_count) for r in got if r.keyword == "cold"] == [("a1", 2, 2)]


def test_rollups_take_all_rows(spark):
    """More than five thousand (article, source) rows of a tenant's day all count."""
    facts = spark.range(6_000).select(
        F.lit("w").alias("web_id"), F.lit(20240101).alias("date"), F.concat(F.lit("a"), "id").alias("article_id"), F.lit("fb").alias("source_domain"),
        *[F.lit(1).cast("long").alias(m) for m in rollups.MEASURES],
    )
    articles = facts.select("web_id", "article_id", F.array(F.lit("k")).alias("keyword_list"), F.lit(0).alias("is_cut"))
    rows = rollups.explode_keywords(rollups.with_source(rollups.attach_articles(rollups.day_pageviews(facts), articles)))
    assert [r.pageviews for r in rollups.keyword_rollup(rows).collect()] == [6_000]
    assert rollups.hot_pageviews(facts, 7).count() == 7


def test_all_similar_products_by_default(spark):
    pairs = [("w", m, o, 0.5 + o / 100) for m in range(30) for o in range(3)]
    df = spark.createDataFrame(pairs, "web_id string, main_product_id long, similarity_product_id long, text_similarity double")
    assert joins.top_similar(df).count() == 30 and joins.top_similar(df, products=5).count() == 5


def test_clusters_are_reproducible(spark):
    rng = random.Random(0)
    rows = [(i, [rng.gauss(5 * (i % 2), 1) for _ in range(4)]) for i in range(80)]
    df = spark.createDataFrame(rows, "id long, vector array<double>")
    out, bics = ml.cluster_items(df, dims=2, k_range=(2, 3))
    assert set(bics) == {2, 3} and out.count() == 80
    groups = {(r.id % 2, r.cluster) for r in out.collect()}
    assert len(groups) >= 2


def test_registered_clusters_try_every_count(spark, monkeypatch):
    from clickloom.catalog import similarity as queries

    real, seen = inspect.signature(ml.cluster_items), []
    df = spark.createDataFrame([(1, 0)], "vec_id long, cluster int")

    def record(*args, **named):
        bound = real.bind(*args, **named)
        bound.apply_defaults()
        seen.extend(bound.arguments["k_range"])
        return df, {}

    monkeypatch.setattr(queries, "table", lambda *_: df)
    monkeypatch.setattr(ml, "cluster_items", record)
    assert queries.cluster_items(spark, "").count() == 1 and seen == list(range(10, 30))


def test_edits_of_many_pairs_at_once():
    rng = np.random.default_rng(7)
    words = ["", "a", "ca", "abc", "word12", "word120", "wrod12", *("".join(rng.choice(list("abé𝄞"), n)) for n in rng.integers(0, 14, 60)), "x" * 90 + "yz"]
    i, j = (x.ravel() for x in np.meshgrid(range(len(words)), range(len(words))))
    side = edits.Letters.of(words)
    assert edits.edit_distances(side, i, side, j).tolist() == [edit_distance(words[x], words[y]) for x, y in zip(i, j)]
    assert edits.edit_distances(side, i[:0], side, j[:0]).tolist() == []


def test_a_block_travels_once_per_group(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [("t", f"word{n}", [float(x) for x in rng.standard_normal(8)]) for n in range(3000)]
    words = spark.createDataFrame(rows, "web_id string, word string, vector array<double>")
    seen = []
    real = balls.BallIndex.meet_groups

    def counted(self, pairs, *rest):
        seen.append((self.left.count(), pairs.count()))
        return real(self, pairs, *rest)

    monkeypatch.setattr(balls.BallIndex, "meet_groups", counted)
    got = {}
    for r in similarity.keyword_similarity(words, block=64).collect():
        got.setdefault(r["keyword"], []).append((r["score"], r["keyword_related"]))
    assert sum(pairs for _, pairs in seen) <= 9 < seen[0][0]  # not the square of the blocks
    units = balls.unit_rows(np.array([v for _, _, v in rows]))
    for n in range(0, 3000, 500):
        edited = np.array([edit_distance(f"word{n}", w) for _, w, _ in rows]) / len(f"word{n}")
        scores = 2 * units @ units[n] - edited
        best = sorted((-round(float(s), 9), w) for s, (_, w, _) in zip(scores, rows) if s > 0.09)[:10]
        assert sorted((-round(s, 9), w) for s, w in got[f"word{n}"]) == best


def test_one_pass_serves_the_mixtures_of_all_counts(spark, monkeypatch):
    rng = np.random.default_rng(5)
    points = rng.standard_normal((4, 6))[rng.integers(0, 4, 300)] * 3 + rng.standard_normal((300, 6))
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id long, vector array<double>").coalesce(1)
    passes, once = [], ml._expectation
    monkeypatch.setattr(ml, "_expectation", lambda vectors, mixtures, dims: passes.append(set(mixtures)) or once(vectors, mixtures, dims))
    out, bics = ml.cluster_items(df, dims=3, k_range=range(2, 5))
    assert passes[0] == {2, 3, 4} and len(passes) <= 50
    reduced, labels = ml.reduce_dim(df, dims=3).persist(), {}
    for k in range(2, 5):  # Spark's own
        model = ml.GaussianMixture(k=k, featuresCol="reduced", predictionCol="cluster", seed=42, maxIter=50).fit(reduced)
        assert bics[k] == pytest.approx(ml._free_parameters(k, 3) * np.log(300) - 2 * model.summary.logLikelihood, abs=1e-5)
        labels[k] = rows_of(model.transform(reduced).select("id", "cluster"))
    assert rows_of(out.select("id", "cluster")) == labels[min(bics, key=bics.get)]
