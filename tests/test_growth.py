"""Steps that must not outgrow a task, the driver or the disk as tables grow."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
from clickloom.functions import text as tx
from clickloom.operators import joins, keywords, ml, reports, similarity, usertags


def test_salted_copies_count_against_the_broadcast_threshold(spark, tmp_path):
    right = spark.range(2000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("title"))
    right.coalesce(1).write.parquet(str(tmp_path / "right"))
    right = spark.read.parquet(str(tmp_path / "right"))
    left = spark.range(6000).select((F.col("id") % 3000).alias("id"), F.col("id").alias("event"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(400_000))  # one copy fits, eight don't
    try:
        joined = joins.salted_join(left, right, ["id"], "left", spread=8)
        plan = joined._jdf.queryExecution().sparkPlan().toString()
        rows = joined.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" not in plan
    assert rows == 6000


def test_slices_of_a_salted_join_need_no_cross_product(spark):
    left = spark.range(100).select((F.col("id") % 7).alias("id"), F.col("id").alias("event"))
    right = spark.createDataFrame([(i, f"t{i}") for i in range(5)] + [(None, "x")], "id long, title string")
    for how, rows in (("inner", 72), ("left", 100), ("left_semi", 72), ("left_anti", 28)):
        joined = joins.salted_join(left, right, ["id"], how)
        plan = joined._jdf.queryExecution().sparkPlan().toString()
        assert joined.count() == rows and "NestedLoop" not in plan and "Cartesian" not in plan


def test_registrations_are_chosen_before_they_travel_in_slices(spark):
    views = spark.createDataFrame([("w", "u", "a"), ("w", "v", "a")], "web_id string, uuid string, article_id string")
    articles = spark.createDataFrame([("w", "a", ["x", "y"], 1)], "web_id string, article_id string, keyword_list array<string>, is_cut int")
    owned = [("u", "2", "c2"), ("u", "1", None), ("u", "3", "c3"), ("v", "9", "c9")]
    tokens = spark.createDataFrame(owned, "uuid string, token string, code string")
    tagged = usertags.user_tags(views, articles, tokens, F.lit("2024-01-01"))
    assert {(r["uuid"], r["usertag"], r["token"], r["code"]) for r in tagged.collect()} == {
        ("u", "x", "2", "c2"), ("u", "y", "2", "c2"), ("v", "x", "9", "c9"), ("v", "y", "9", "c9")
    }
    assert tagged._jdf.queryExecution().optimizedPlan().toString().count("Window [row_number()") == 2


def test_articles_with_the_same_words_are_scored_once(spark, monkeypatch):
    rng = np.random.default_rng(4)
    vectors = {f"w{i}": [float(x) for x in rng.standard_normal(4)] for i in range(12)} | {"new": None, "other": None}
    lists = [["w0", "w1", "new"], ["w2", "w3"], ["w1", "w0", "other"], ["w2", "w3", "w3"]]
    rows = [(f"a{i}", w, vectors[w]) for i in range(400) for w in lists[i % 4]]
    ads = [(f"ad{i}", w, vectors[w]) for i in range(6) for w in (f"w{2 * i}", f"w{2 * i + 1}")]
    articles = spark.createDataFrame(rows, "article_id string, word string, vector array<double>")
    offers = spark.createDataFrame(ads, "ad_id string, word string, vector array<double>")
    seen = []
    real = similarity.block_pairs
    monkeypatch.setattr(similarity, "block_pairs", lambda left, *rest, **more: seen.append(left.count()) or real(left, *rest, **more))
    got = {r["article_id"]: (r["ad_id"], r["keyword"], round(r["score"], 6)) for r in similarity.match_ads(articles, offers).collect()}
    assert len(got) == 400 and seen == [8]
    unit = {w: np.array(v) / np.linalg.norm(v) for w, v in vectors.items() if v}
    for i, words in enumerate(lists):
        best = {}
        for ad in range(6):
            sims = {k: [unit[w] @ unit[k] if w in unit else -1.0 for w in words] for k in (f"w{2 * ad}", f"w{2 * ad + 1}")}
            upper = {k: np.mean(s) + np.std(s) for k, s in sims.items()}
            best[f"ad{ad}"] = (np.mean(list(upper.values())) + np.std(list(upper.values())), max(upper, key=upper.get))
        ad = max(best, key=lambda a: best[a][0])
        assert all(got[f"a{j}"] == (ad, best[ad][1], round(best[ad][0], 6)) for j in range(i, 400, 4))


def test_a_worker_holds_the_words_of_a_few_texts(spark, monkeypatch):
    monkeypatch.setattr(keywords, "TRIE_TEXTS", 2)
    texts = [(i, t) for i, t in enumerate(["abcd efg", None, "", "gab", "abab x", "efgabcd"])]
    rows = spark.createDataFrame(texts, "id long, text string").coalesce(1)
    known = spark.createDataFrame([("ab", 5), ("cd", 4), ("efg", 3)], "word string, freq long")
    cut = keywords.segment(rows, "id", "text", known, run="[a-z]+")
    plan = cut._jdf.queryExecution().sparkPlan().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan
    got = {}
    for r in sorted(cut.collect()):
        got.setdefault((r["id"], r["run_no"]), []).append(r["word"])
    assert got == {
        (0, 0): ["ab", "cd"], (0, 1): ["efg"], (3, 0): ["g", "ab"], (4, 0): ["ab", "ab"], (4, 1): ["x"], (5, 0): ["efg", "ab", "cd"]
    }
    joined = keywords.segment(rows, "id", "text", known, run="[a-z]+", trie_words=0)
    assert sorted(joined.collect()) == sorted(cut.collect())


def exchanges(df, key):
    return df._jdf.queryExecution().executedPlan().toString().count(f"Exchange hashpartitioning({key}#")


TEXTS = {1: "aa bb bb cc dd", 2: "aa cc ee ff ff", 3: "aa bb gg 12", 4: "", 5: None, 6: "aa aa hh"}


def test_rows_of_frequent_terms_are_scored_in_place(spark, monkeypatch):
    monkeypatch.setattr(keywords, "FREQUENT_TERMS", 4)  # terms in four rows and more travel
    rows = spark.createDataFrame(list(TEXTS.items()) + [(1, "bb ii")], "id long, text string").repartition(3, "id")
    counted = keywords.count_with_totals(rows, "id", tx.latin_tokens(F.col("text")))
    assert exchanges(counted, "id") == 1  # the one that shares texts out
    words = {i: Counter((t or "").split()) for i, t in TEXTS.items()}
    words[1].update(["bb", "ii"])
    assert {(r.id, r.term): (r.freq, r.total) for r in counted.collect()} == {
        (i, t): (n, sum(c.values())) for i, c in words.items() for t, n in c.items()
    }
    docs = sum(map(bool, words.values()))
    found = Counter(t for c in words.values() for t in c)
    want = set()
    for i, c in words.items():
        scores = sorted((-round(n / sum(c.values()) * math.log10(docs / found[t]), 9), t) for t, n in c.items() if t != "12")
        want |= {(i, t, place) for place, (_, t) in enumerate(scores[:2], 1)}
    for idf in (keywords.train_idf(counted, rows=True), keywords.train_idf(counted)):
        best = keywords.tfidf_keywords(counted, idf, 2, keep_term=~tx.is_noise(F.col("term")) | (F.col("term") != "12"))
        assert "_salt" not in best._jdf.queryExecution().optimizedPlan().toString()
        assert {(r.id, r.term, r["rank"]) for r in best.collect()} == want
    # all of another corpus: terms without an IDF have the upper median
    other = spark.createDataFrame([("aa", 3.0), ("bb", 1.0), ("cc", 2.0)], "term string, idf double")
    best = keywords.tfidf_keywords(counted, other, 1)
    assert {r.id: (r.term, round(r.score, 6)) for r in best.collect()} == {1: ("aa", 0.428571), 2: ("ff", 0.8), 3: ("aa", 0.75), 6: ("aa", 2.0)}


def small_tables(spark, folder):
    docs = [(i, t, "en", "s1" if i % 2 else None, 1) for i, t in TEXTS.items()]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, "cc")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_words_are_counted_where_the_text_is(spark, tmp_path):
    sf, queries = small_tables(spark, tmp_path), entry.queries()
    counted = queries["F6_stopwords"](spark, sf)
    assert exchanges(counted, "doc_id") == 1  # the one that shares texts out
    assert ("aa", 2) in {(r.word, r.n) for r in counted.where("doc_id = 6").collect()}
    assert {r.word for r in counted.where("doc_id = 2").collect()} == {"aa", "ee", "ff"}


def test_a_vocabulary_is_counted_without_documents(spark, tmp_path, monkeypatch):
    from clickloom.catalog import aggregates

    monkeypatch.setattr(aggregates, "doc_terms", None)
    got = {r.term: r.idf for r in entry.queries()["A22_idf_vocab"](spark, small_tables(spark, tmp_path)).collect()}
    assert len(got) == 9 and got["aa"] == round(math.log10(9 / 5), 6)


def test_label_batches_start_from_documents(spark, tmp_path, monkeypatch):
    from clickloom.catalog import aggregates

    monkeypatch.setattr(aggregates, "doc_terms", None)
    got = {(r.web_id, r.id): r.distinct_keywords for r in entry.queries()["A30_label_batch"](spark, small_tables(spark, tmp_path)).collect()}
    assert {k: n for k, n in got.items() if k[0]} == {("s1", 1): 4, ("s1", 3): 6}
    rows = spark.createDataFrame([("w", 1, "x"), ("w", 1, "y"), ("w", 2, "x"), ("w", 3, "z")], "web_id string, id long, term string")
    batch = reports.label_batch(rows, "web_id", "id", "term", 1)
    assert sorted((r.id, r.distinct_keywords) for r in batch.collect()) == [(1, 2)]


def test_word_pairs_need_no_join_of_positions(spark):
    rows = spark.createDataFrame([(1, "a b a b the c"), (2, "the"), (3, None)], "id long, text string")
    stop = spark.createDataFrame([("The",)], "word string")
    counted = keywords.ngram_terms(rows, "id", tx.latin_tokens(F.col("text")), stop)
    assert "_pos" not in counted._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.id, r.term, r.words): r.freq for r in counted.collect()} == {
        (1, "a", 1): 2, (1, "b", 1): 2, (1, "c", 1): 1, (1, "a b", 2): 2, (1, "b a", 2): 1
    }
    assert {r.term for r in keywords.ngram_terms(rows, "id", tx.latin_tokens(F.col("text")), None, n=1).collect()} == {"a", "b", "the", "c"}


def test_embedding_tasks_have_a_bounded_share(spark, monkeypatch):
    monkeypatch.setattr(ml, "PART_WORDS", 40)
    docs = spark.createDataFrame([(["x", "y", "z"],)] * 30 + [(None,), ([],)], "tokens array<string>").coalesce(2)
    assert ml.training_partitions(docs) == 3 and ml.training_partitions(docs.limit(0)) == 1
    model = ml.train_embedding(docs.where("tokens is not null"), size=4, min_count=2, epochs=1, partitions=3)
    assert {r.word for r in model.getVectors().collect()} == {"x", "y", "z"}


def test_a_label_set_ranks_once(spark, monkeypatch):
    from clickloom.plans import reporting

    runs = []
    real = reporting.materialise
    monkeypatch.setattr(reporting, "materialise", lambda df, label: runs.append(label) or real(df, label))
    texts = spark.createDataFrame([(1, "w"), (2, "w"), (3, "w")], "id long, web_id string")
    ranked = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, "x", 1), (3, "z", 1)], "id long, term string, rank int")
    assert {(r.web_id, r.term) for r in reporting.label_set(texts, ranked, n=1).collect()} == {("w", "x"), ("w", "y")}
    assert runs == ["label-set"]
