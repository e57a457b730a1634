"""Cleaners, signatures and traffic sources, edge cases included."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from clickloom.functions import text as tx
from clickloom.functions import urls
from clickloom.operators import keywords
from clickloom.sources import logs


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "c string").select(fn(F.col("c"))).first()[0]


def test_url_text_keeps_path_unless_dropped(spark):
    assert one(spark, "看 https://a.b/c 文", tx.strip_urls) == "看 a.b/c 文"
    assert one(spark, "看 https://a.b/c 文", lambda c: tx.strip_urls(c, True)) == "看  文"


@pytest.mark.parametrize(
    "word,noise",
    [
        ("", True), ("12", True), ("123", True), ("1.5", True), ("ab", True), ("abcde", False), ("AB", True),
        ("ABC", False), ("5.1萬", True), ("天", True), ("天氣", False), ("5kg", True), ("Ab", False), ("7天", True),
    ],
)
def test_noise_tokens(spark, word, noise):
    assert one(spark, word, tx.is_noise) is noise


def test_small_text_functions(spark):
    assert one(spark, "a-b!c.d~e&f+g_h～i:j，k/l", tx.strip_symbols) == "abcdefghijkl"
    assert one(spark, "今天abc很好", tx.keep_runs) == "今天 很好"
    assert one(spark, "5萬+", tx.traffic_number) == 50000
    assert one(spark, "1,200+", tx.traffic_number) == 1200
    assert one(spark, "many", tx.traffic_number) is None
    assert one(spark, '["a"，b,,c]', lambda c: tx.short_pieces(tx.drop_brackets(c))) == ["a", "b", "c"]
    assert one(spark, " a , b,a,", tx.split_list) == ["a", "b", "a", ""]
    assert one(spark, "简体", lambda c: tx.map_chars(c, {"简": "簡", "体": "體"})) == "簡體"


def test_signatures(spark):
    long_part, edge = "x" * 61, "y" * 60
    rows = [
        ("shop", "https://shop.tw/p/12"), ("shop", "https://shop.tw/about"), ("shop", "https://other.tw/about"),
        ("none", "https://none.tw/p/1"), ("shop", f"https://shop.tw/p/{long_part}"), ("shop", f"https://shop.tw/p/{edge}"),
        ("bad", "https://bad.tw/p/3"), ("shop", "https://shop.tw/p/%E4%B8%AD"),
    ]
    rules = spark.createDataFrame(
        [("shop", r"/p/([\w%一-鿿]+)", 1), ("bad", "/p/[0-9]+", 1)], "web_id string, pattern string, group int"
    )
    df = spark.createDataFrame(rows, "web_id string, url string")
    got = {r.url: r.article_id for r in urls.url_signature(df, rules, decode=F.lit(True)).collect()}
    assert got[rows[0][1]] == "shop_12"
    assert got[rows[1][1]] == "shop"  # no match, but the URL names the tenant
    assert got[rows[2][1]] == "_"
    assert got[rows[3][1]] == "_"  # no rule
    assert got[rows[4][1]] == "shop_" + hashlib.sha256(long_part.encode()).hexdigest()
    assert got[rows[5][1]] == "shop_" + edge
    assert got[rows[6][1]] == "bad"  # the rule asks for a group its pattern does not have
    assert got[rows[7][1]] == "shop_中"


@pytest.mark.parametrize(
    "referrer,current,app,want",
    [
        ("https://a.com/", "https://b.com/?utm_source=x&utm_source=facebook_ads", "", "fb"),
        ("https://a.com/", "https://b.com/?utm_medium=EDM&utm_source=weird", "", "weird"),
        ("https://a.com/", "https://b.com/?utm_medium=sms2", "line", "sms"),
        ("https://a.com/", "https://b.com/", "line", "line"),
        ("_", "https://b.com/x", "", "other"), ("-1", "https://b.com/x", "", "other"), (None, "https://b.com/x", "", "other"),
        ("nohost", "https://b.com/x", "", "other"),
        ("https://www.google.com/s", "https://b.com/x", "", "google search"),
        ("https://mygoogle.com/s", "https://b.com/x", "", "mygoogle.com"),  # no border before the name
        ("https://instagram.com/", "https://b.com/x", "", "instagram"),
        ("https://ins.io/", "https://b.com/x", "", "insider"),
        ("https://b.com/?utm_source=yahoo", "https://b.com/x", "", "yahoo"),
        ("https://b.com/y", "https://b.com/x", "", "b.com"),
    ],
)
def test_traffic_source(spark, referrer, current, app, want):
    df = spark.createDataFrame([(referrer, current, app)], "r string, c string, a string")
    assert df.select(urls.traffic_source(F.col("r"), F.col("c"), F.col("a"))).first()[0] == want


def test_own_networks_slot_into_the_rules(spark):
    rules = urls.source_rules(own=[("(adnet)(?:_again)?", "adnet")])
    df = spark.createDataFrame([("https://b.com/?utm_source=ADNET_again",)], "c string")
    assert df.select(urls.utm_source(F.col("c"), rules)).first()[0] == "adnet"


@pytest.mark.parametrize(
    "source,domain,want",
    [
        ("shop.com", "https://www.shop.com/", "w"), ("FB", "https://x.tw", "fb"), ("adnet-old", "https://x.tw", "adnet"),
        ("x.y", "https://www.xzy.tw", "other"), ("blogs.example", "https://x.tw", "w"), ("fb", None, "other"),
        ("shops", "https://x.tw", "w"),
    ],
)
def test_canonical_source(spark, source, domain, want):
    df = spark.createDataFrame([(source, "w", domain)], "s string, w string, d string")
    fold = urls.canonical_source(F.col("s"), F.col("w"), F.col("d"), own_aliases={"adnet-old": "adnet"}, app_hosts=["app.shops.example"], blog_networks=["blogs"])
    assert df.select(fold).first()[0] == want


def brute_segment(word_freq, run):
    from functools import lru_cache
    from math import log

    total = sum(word_freq.values())

    @lru_cache(None)
    def best(i):
        if i == len(run):
            return 0.0, ()
        options = []
        for n in range(1, min(8, len(run) - i) + 1):
            piece = run[i : i + n]
            if piece in word_freq or n == 1:
                weight = log(word_freq.get(piece, 1) / total)
                score, rest = best(i + n)
                options.append((weight + score, n, (piece, *rest)))
        score, _, words = max(options)
        return score, words

    return list(best(0)[1])


def test_segmenter_finds_the_most_probable_split(spark):
    freq = {"今天": 50, "天氣": 40, "今": 3, "天": 5, "氣": 2, "很": 9, "很好": 20, "好": 8}
    text = "今天天氣很好, abc 天氣好 未知今天"
    dictionary = spark.createDataFrame(list(freq.items()), "word string, freq long")
    df = spark.createDataFrame([(1, text)], "id long, text string")
    rows = keywords.segment(df, "id", "text", dictionary).orderBy("run_no", "word_no").collect()
    want = [w for run in ("今天天氣很好", "天氣好", "未知今天") for w in brute_segment(freq, run)]
    assert [r.word for r in rows] == want


@pytest.mark.parametrize("trie_words", [1 << 19, 3])
def test_trie_and_join_split_alike(spark, trie_words):
    rng = random.Random(6)
    letters = "甲乙丙丁戊"
    freq = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 7))): rng.randint(1, 60) for _ in range(60)}
    del freq[next(w for w in freq if len(w) == 1)]
    texts = ["".join(rng.choice(letters + " ,a") for _ in range(rng.randint(0, 60))) for _ in range(80)]
    texts += [texts[3], None, "", "no han", "甲" * 4000]
    dictionary = spark.createDataFrame([*freq.items(), ("丁丁", 0), ("", 4)], "word string, freq long")
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    found = {}
    for r in keywords.segment(df, "id", "text", dictionary, trie_words=trie_words).orderBy("id", "run_no", "word_no").collect():
        found.setdefault((r.id, r.run_no), []).append(r.word)
    sized = freq | {"": 4}
    for i, text in enumerate(texts[:-1]):
        runs = re.findall("[一-鿿]+", text or "")
        assert [found[i, n] for n in range(len(runs))] == [brute_segment(sized, run) for run in runs]
    assert "".join(found[len(texts) - 1, 0]) == texts[-1]
    assert len(found) == sum(len(re.findall("[一-鿿]+", t or "")) for t in texts)


def test_empty_dictionary_leaves_characters(spark):
    df = spark.createDataFrame([(1, "今天 好")], "id long, text string")
    none = spark.createDataFrame([], "word string, freq long")
    assert sorted(r.word for r in keywords.segment(df, "id", "text", none).collect()) == ["今", "天", "好"]


def test_dictionary_words_may_be_long(spark):
    word = "中華民國行政院環境保護署"
    dictionary = spark.createDataFrame([(word, 3), ("中華", 9)], "word string, freq long")
    df = spark.createDataFrame([(1, f"到{word}去")], "id long, text string")
    assert [r.word for r in keywords.segment(df, "id", "text", dictionary).orderBy("word_no").collect()] == ["到", word, "去"]


def test_han_texts_reach_keywords(spark):
    freq = {"今天": 50, "天氣": 40, "很好": 20, "電影": 30, "好看": 10, "的": 99}
    dictionary = spark.createDataFrame(list(freq.items()), "word string, freq long")
    texts = {1: "今天天氣很好, 天氣!", 2: "電影好看的電影", 3: "今天的電影", 4: "plain words only", 5: ""}
    df = spark.createDataFrame([(i, t, "zh" if i < 4 else "xx") for i, t in texts.items()], "id long, text string, lang string")
    terms = keywords.explode_tokens(df, "id", keywords.han_terms(df, "id", "text", dictionary))
    assert {(r.id, r.term): r.freq for r in terms.collect()} == {
        (1, "今天"): 1, (1, "天氣"): 2, (1, "很好"): 1, (2, "電影"): 2, (2, "好看"): 1, (3, "今天"): 1, (3, "電影"): 1,
    }
    best = keywords.tfidf_keywords(terms, keywords.train_idf(terms), 1)
    assert {r.id: r.term for r in best.collect()} == {1: "天氣", 2: "好看", 3: "今天"}
    lists = keywords.keyword_lists(keywords.tfidf_keywords(terms, keywords.train_idf(terms), 2), "id", 2)
    named = df.withColumn("keywords", F.lit("_"))
    assert {r.id: len(r.keyword_list) for r in keywords.article_keywords(named, lists).collect()} == {1: 2, 2: 2, 3: 2, 4: 0, 5: 0}
    extractors = keywords.EXTRACTORS | {"zh": keywords.han_extractor(dictionary)}
    found = keywords.keywords_by_language(df, "id", tx.latin_tokens(F.col("text")), extractors=extractors).collect()
    by_id = {}
    for r in found:
        by_id.setdefault(r.id, set()).add(r.term)
    assert by_id == {1: {"今天", "天氣", "很好"}, 2: {"電影", "好看"}, 3: {"今天", "電影"}, 4: {"plain", "words", "only"}}


def test_glued_json_survives_bad_text(spark):
    texts = [
        ('{"a":1}{"a":2}',), ('"landing""landing"{"a":3}"landing"{"a":4}"landing"',), ("garbage",), ("",), ('{"a":5}',),
    ]
    df = spark.createDataFrame(texts, "value string")
    assert sorted(r.a for r in logs.parse_glued(df, "value", "a int").collect()) == [1, 2, 3, 4, 5]
