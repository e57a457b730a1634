"""The recurrent language model against plain definitions, and its query against plain counts."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from clickloom.llm import language_model, recurrent
from clickloom.llm.catalog import QUERIES


def toy(symbols=11, units=5, seed=1):
    rng = np.random.default_rng(seed)
    w = recurrent.Weights.fresh(np.sort(rng.integers(1, 90, symbols))[::-1], units)
    documents = [rng.integers(0, symbols, n).astype(np.uint16) for n in (1, 9, 30, 2, 17, 5, 1, 64)]
    return w, documents


def plain_likelihood(w, document, end):
    """One symbol after the other, with the softmax over all symbols written out."""
    h, before, total, units = np.zeros(w.units), end, 0.0, w.units
    for s in document:
        a = w.inputs[before].astype(float) + h @ w.turn
        gate = 1 / (1 + np.exp(-a[:units]))
        h = h + gate * (np.tanh(a[units:]) - h)
        by_class = h @ w.classes + w.class_bias
        by_class = np.exp(by_class) / np.exp(by_class).sum()
        inside = np.einsum("u,kup->kp", h, w.words) + w.word_bias
        inside = np.exp(inside) / np.exp(inside).sum(1, keepdims=True)
        chances = (by_class[:, None] * inside).ravel()
        assert abs(chances[: len(w.inputs)].sum() - 1) < 1e-5
        total += math.log(chances[s])
        before = s
    return total


@pytest.mark.parametrize(("lanes", "steps"), [(1, 3), (3, 4), (8, 32), (2, 1)])
def test_likelihood_by_definition(lanes, steps):
    w, documents = toy()
    want = [plain_likelihood(w, d, 4) for d in documents]
    assert np.allclose(recurrent.log_likelihoods(w, documents, 4, lanes, steps), want, rtol=1e-4, atol=1e-4)


def test_gradients_by_differences():
    w, documents = toy(units=3)
    w = recurrent.Weights(*(a.astype(np.float64) for a in w.arrays()))
    batch = recurrent.Batch.of(documents, 3)
    span, h = slice(0, 7), np.zeros((3, 3))
    back = recurrent.Weights(*(np.zeros_like(a) for a in w.arrays()))
    _, used, pull = recurrent.gradients(w, batch, span, 3, 4, h, back)
    back.inputs[used] = pull

    def value():
        win = recurrent.run_window(w, batch, span, 3, 4, h)
        here = batch.owner[span, :3].ravel() >= 0
        return sum(plain_step_logs(w, win.out.reshape(-1, 3)[here], batch.symbol[span, :3].ravel()[here]))

    rng = np.random.default_rng(2)
    for a, g in zip(w.arrays(), back.arrays(), strict=True):
        for at in rng.integers(0, a.size, 12):
            if a.flat[at] < -1e8:
                continue
            old, step = a.flat[at], 1e-2
            a.flat[at] = old + step
            up = value()
            a.flat[at] = old - step
            down = value()
            a.flat[at] = old
            assert g.flat[at] == pytest.approx((up - down) / (2 * step), rel=0.03, abs=0.01)


def plain_step_logs(w, states, symbols):
    for h, s in zip(states.astype(float), symbols, strict=True):
        kind, place = divmod(int(s), w.places)
        by_class, inside = h @ w.classes + w.class_bias, h @ w.words[kind] + w.word_bias[kind]
        yield by_class[kind] - np.log(np.exp(by_class).sum()) + inside[place] - np.log(np.exp(inside).sum())


def test_uses_follow_the_order_of_the_values():
    w, _ = toy()
    seen = np.arange(11, dtype=np.float32)
    uses = w.like(w.uses(seen))
    assert (uses.inputs == seen[:, None]).all() and (uses.turn == seen.sum()).all()
    assert uses.word_bias.ravel()[0] == seen[: w.places].sum() and uses.words[1].max() == seen[w.places : 2 * w.places].sum()


def test_training_learns_a_pattern():
    rng = np.random.default_rng(3)
    documents = [np.array([0, 1, 2, 3] * int(rng.integers(2, 9)) + [4], np.uint16) for _ in range(600)]
    w = recurrent.Weights.fresh(np.bincount(np.concatenate(documents)))
    after = recurrent.train(w, documents, 4, lanes=8, steps=16)
    before, now = (recurrent.log_likelihoods(x, documents, 4).sum() for x in (w, after))
    assert now > 0.4 * before and (after.flat() != w.flat()).any()


def corpus(seed=4, docs=700):
    rng = random.Random(seed)
    tongues = [["".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(400)] for letters in ("abcdE", "zyxwvé")]
    rows = []
    for key in range(docs):
        words = rng.choice(tongues)
        rows.append((key, rng.choice([" ", "\n", "\t \x0b"]).join(words[min(399, int(rng.expovariate(0.02)))] for _ in range(rng.randint(1, 120)))))
    return [*rows, (docs, None), (docs + 1, ""), (docs + 2, " \r\n "), rows[5], (docs + 3, "q" * 90 + " " + "q" * 90 + "   É é"), (-1, "Ab\x1cc ab\x85")]


def plain_scores(rows):
    words = {}
    for key, text in rows:
        text = "".join(c.lower() if c.isascii() else c for c in text or "")
        words[key] = [*re.findall(r"[^\x20\x09-\x0D]+", text), "\n"]
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in words}
    counts = Counter(w for key, _ in rows if not held[key] for w in words[key])
    total = sum(counts.values())
    out = []
    for key, _ in rows:
        base = sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in words[key])
        out.append((key, held[key], len(words[key]), sum(counts[w] > 0 for w in words[key]), total, base))
    return out


@pytest.mark.parametrize("known", [language_model.KNOWN, 150, 0])
def test_query_by_plain_counts(spark, tmp_path, monkeypatch, known):
    monkeypatch.setattr(language_model, "SHARD", 4000)
    monkeypatch.setattr(language_model, "SYMBOLS", 400)
    monkeypatch.setattr(language_model, "FLUSH", 100)
    rows = corpus()
    frame = spark.createDataFrame([(k, t, 1, "w") for k, t in rows], "doc_id long, text string, row int, word string")
    frame.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    got = language_model.document_scores(docs, docs["text"], docs["doc_id"], known).collect()
    want = sorted(plain_scores(rows))
    assert sorted(tuple(r)[:5] for r in got) == [w[:5] for w in want]
    got = sorted(got, key=lambda r: r["doc_id"])
    assert np.allclose([r["base_score"] for r in got], [w[5] for w in want])
    for held in (True, False):
        some = [r for r in got if r["held_out"] == held]
        assert sum(r["score"] for r in some) > sum(r["base_score"] for r in some) * 0.97
    twice = [r["score"] for r in got if r["doc_id"] == 5]
    assert len(twice) == 2 and twice[0] == pytest.approx(twice[1], rel=1e-5)


def test_shares_within_a_group_add_up(spark):
    rows = corpus(docs=120)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = language_model.word_counts(docs, docs["text"]).cache()
    vocab = language_model.vocabulary(counts, language_model.least_known(counts.where("word <> '\n'"), 1000))
    n = {r["word"].encode(): r["n"] for r in counts.collect()}
    assert int(vocab.counts.sum()) == sum(n.values()) == vocab.tokens and vocab.distinct == len(n)
    left = 10.0**vocab.group_log - 1
    for word, c in n.items():
        at = vocab.index.get(word)
        if word != b"\n" and (at is None or vocab.symbol[at] in vocab.group_symbol):
            left[language_model.ending_of(word)] -= c + 1
    assert np.allclose(left, 0, atol=1e-6)


def test_no_training_documents(spark):
    docs = spark.createDataFrame([(k, "one two") for k in range(200) if zlib.crc32(str(k).encode()) % 7 == 2], "doc_id long, text string")
    rows = language_model.document_scores(docs, docs["text"], docs["doc_id"]).collect()
    assert len(rows) > 10 and all(r["train_tokens"] == r["n_known"] == r["base_score"] == 0 and r["n_tokens"] == 3 and r["score"] < 0 for r in rows)


def test_registered():
    assert "op13_recurrent_scores" in QUERIES
