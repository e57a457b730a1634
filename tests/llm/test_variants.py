"""Spelling variants and fill-in-the-middle against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import middle, spelling
from clickloom.llm.catalog import QUERIES


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{key}:{run}".encode())
            at = h % len(run)
            counts[run[:at] + run[at + 1 :] if h % 31 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 10 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words[form[w]] if form[w] else None)
    return out


def misspelt(rng, base):
    word = list(rng.choice(base))
    for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
        at = rng.randrange(len(word))
        word[at : at + rng.randint(0, 1)] = [rng.choice("abcdeÀÿ÷×é")] * rng.randint(0, 2)
    return "".join(word)


def variant_rows(seed, docs=60, each=80):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(6, 11))) for _ in range(25)]
    weights = [4 ** -(i % 6) for i in range(len(base))]
    rows = []
    for key in range(docs):
        words = [misspelt(rng, rng.choices(base, weights)) for _ in range(each)]
        rows.append((key, rng.choice([" ", "_", "\n", "1"]).join(w.upper() if rng.random() < 0.1 else w for w in words)))
    return [*rows, (docs, None), (docs + 1, ""), (docs + 2, "a" * 3000 + " " + "a" * 2999 + " " + "a" * 3000 + " " + "a" * 2999), rows[3]]


@pytest.mark.parametrize(("leaf", "sample"), [(20_000, 1 << 18), (12, 1 << 18), (12, 60)])
def test_variants_by_brute_force(spark, tmp_path, monkeypatch, leaf, sample):
    monkeypatch.setattr(spelling, "LEAF", leaf)
    monkeypatch.setattr(spelling, "SAMPLE", sample)
    rows = variant_rows(leaf)
    frame = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, word string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_letter_count_variants"](spark, str(tmp_path)).collect()
    want = plain_variants(rows)
    assert len(got) == len(want) and len(want) > 100
    assert {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got} == want
    assert any(w[1] != w[0] for w in want.values() if w[0]), "no chain of forms"


def test_leaves_hold_every_vector_within_reach():
    rng = np.random.default_rng(5)
    words = ["".join(map(chr, rng.choice([97, 98, 99, 100, 233, 255], 8))) for _ in range(700)]
    counts = spelling.letter_counts(spelling.letters(words, 8)).astype(int)
    tree = spelling.grow(counts, 5)
    assert sorted(np.concatenate([leaf.members for leaf in tree.leaves])) == list(range(700))
    for up, down in ((0, 0), (1, 0), (1, 1)):
        seen = np.zeros((700, 700), bool)
        visits = 0
        for leaf, who in spelling.reached(tree, counts, up, down):
            seen[np.ix_(who, leaf.members)] = True
            visits += len(who)
        diff = counts[None] - counts[:, None]
        close = (np.maximum(diff, 0).sum(2) <= up) & (np.maximum(-diff, 0).sum(2) <= down)
        assert not (close & ~seen).any()
        assert visits < 700 * len(tree.leaves) / 2
    assert (spelling.home_leaf(tree, counts) >= 0).all()


def test_chains_of_forms(spark):
    links = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(13)] + [("x", "w12")], "word string, form string")
    assert {r["word"]: r["root"] for r in spelling.last_forms(links).collect()} == {f"w{i}": "w13" for i in range(13)} | {"x": "w13"}


def plain_middle(key, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{key}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    parts = ["".join(units[:a]), "".join(units[a:b]), "".join(units[b:])]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    form = "spm" if h[3] % 100 < 20 else "psm"
    output = f"<S>{parts[2]}<P>{parts[0]}<M>{parts[1]}" if form == "spm" else f"<P>{parts[0]}<S>{parts[2]}<M>{parts[1]}"
    return len(units), form, len(parts[0]), len(parts[1]), output


def test_middle_by_brute_force(spark, tmp_path):
    rng = random.Random(2)
    parts = ["ab", "Z", " ", "\n", "é", "😀", "<", "P>", "<P", "S", ">", "<S>", " ", "9", "ß", "\r\n"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))) for i in range(1500)]
    rows += [(2000, None), (2001, ""), (2002, "x" * 200_000 + " y" * 100_000), (5, "again"), (5, "again"), (-7, "below zero"), (None, "no id")]
    frame = spark.createDataFrame([(k, t, "psm", 1) for k, t in rows], "doc_id long, text string, form string, cut int")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for key, text in rows:
        if key is not None:
            *shape, output = plain_middle(key, text)
            want.append((key, *shape, sha(output), sha(text or "")))
    got = [tuple(r) for r in QUERIES["op12_fill_in_middle"](spark, str(tmp_path)).collect()]
    order = lambda rows: sorted(rows, key=str)
    assert order(got) == order(want)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}


def test_middle_with_other_rates_and_seed(spark):
    frame = spark.range(300).select("id", F.lit("one two three").alias("text"))
    forms = lambda **how: Counter(r["form"] for r in frame.select(middle.fill_in_middle(F.col("text"), F.col("id"), **how).alias("c")).select("c.form").collect())
    assert forms(plain_from=0) == {"plain": 300}
    assert forms(plain_from=100, spm_below=100) == {"spm": 300}
    assert forms(seed=1) != forms(seed=2)
