"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are looked up in a learned table, filters of ``WIDTH`` bytes slide over the whole text in steps of ``STEP``, and
the largest response of every filter is taken in overlapping chunks of two blocks of ``BLOCK`` bytes. A document is
the mean, the largest and the smallest of its chunks' responses; a small hidden layer makes one probability of them.
All chunks of a text count, whatever its length.

The network is fitted on at most ``TRAIN_ROWS`` labelled texts of at most ``TRAIN_BYTES`` bytes (those with the
smallest hashes of id and text) and learns from text and label alone. Scoring covers all texts.

Edge cases: null counts as empty; an empty text is one block of padding and scored like any other; label rows with a
null id or label are left out, of contradicting labels of an id the smaller counts; without labels of both kinds every
text scores the share of label 1, without any label 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import keyed

TRAIN_ROWS = 4000
TRAIN_BYTES = 1 << 16
UNKNOWN = 0.5  # score of every text if there is nothing to learn from
KEEP = 0.7  # texts that score less are rejected
DEPTH, WIDTH, STEP, FILTERS, HIDDEN, BLOCK = 4, 8, 4, 32, 16, 256
WINDOWS = BLOCK // STEP
SLICE = 1 << 20


def padded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes in a row, every text padded to whole blocks with at least one window's zeros; blocks per text."""
    parts, blocks = [], []
    for text in texts:
        data = text.encode("utf-8", "surrogatepass")
        n = len(data) // BLOCK + 1
        n += n * BLOCK - len(data) < WIDTH
        parts.append(data.ljust(n * BLOCK, b"\0"))
        blocks.append(n)
    return np.frombuffer(b"".join(parts), np.uint8), np.array(blocks)


@dataclass
class Network:
    table: np.ndarray  # byte -> DEPTH
    filters: np.ndarray  # WIDTH * DEPTH, FILTERS
    bias: np.ndarray
    hidden: np.ndarray  # 3 * FILTERS, HIDDEN
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def fresh(cls, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        zeros = lambda n: np.zeros(n, np.float32)
        return cls(
            draw(256, DEPTH, scale=0.5), draw(WIDTH * DEPTH, FILTERS, scale=0.25), zeros(FILTERS),
            draw(3 * FILTERS, HIDDEN, scale=0.15), zeros(HIDDEN), draw(HIDDEN, scale=0.3), zeros(1),
        )

    def weights(self) -> list[np.ndarray]:
        return [self.table, self.filters, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def windows(self, data: np.ndarray) -> np.ndarray:
        """Windows by their start, one row each; the last ones reach into zeros."""
        seen = self.table[np.concatenate([data, np.zeros(WIDTH - STEP, np.uint8)])].reshape(-1)
        rows = len(data) // STEP
        step, size = STEP * DEPTH, WIDTH * DEPTH
        return np.lib.stride_tricks.as_strided(seen, (rows, size), (step * seen.itemsize, seen.itemsize))

    def block_peaks(self, data: np.ndarray) -> np.ndarray:
        """Largest response of every filter in every block, zero at least; in slices of bounded size."""
        peaks = []
        for at in range(0, len(data), SLICE):
            some = data[at : at + SLICE + WIDTH - STEP]
            some = np.pad(some, (0, max(0, min(SLICE, len(data) - at) + WIDTH - STEP - len(some))))
            seen = self.table[some].reshape(-1)
            count, size = (len(some) - (WIDTH - STEP)) // STEP, STEP * DEPTH
            # a window is two steps: the same rows of step features, shifted by one
            steps = seen.reshape(-1, size)
            response = steps[:count] @ self.filters[:size] + steps[1 : count + 1] @ self.filters[size:]
            peaks.append(response.reshape(-1, WINDOWS, FILTERS).max(1))
        return np.maximum(np.concatenate(peaks) + self.bias, 0)

    def features(self, peaks: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Mean, largest and smallest response over the chunks of every text."""
        starts, chunks = chunk_rows(blocks)
        pooled = np.maximum(peaks[chunks[:, 0]], peaks[chunks[:, 1]])
        counts = np.diff(np.r_[starts, len(chunks)])[:, None].astype(np.float32)
        return np.concatenate(
            [np.add.reduceat(pooled, starts) / counts, np.maximum.reduceat(pooled, starts), np.minimum.reduceat(pooled, starts)], axis=1
        )

    def logits(self, features: np.ndarray) -> np.ndarray:
        return np.maximum(features @ self.hidden + self.hidden_bias, 0) @ self.out + self.out_bias[0]

    def __call__(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        data, blocks = padded(texts)
        z = self.logits(self.features(self.block_peaks(data), blocks)).astype(np.float64)
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def chunk_rows(blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First chunk of every text, and the two blocks of every chunk; a text of one block is one chunk."""
    first = np.r_[0, np.cumsum(blocks)[:-1]]
    per_text = np.maximum(blocks - 1, 1)
    starts = np.r_[0, np.cumsum(per_text)[:-1]]
    left = np.arange(per_text.sum()) - np.repeat(starts, per_text) + np.repeat(first, per_text)
    right = np.minimum(left + 1, np.repeat(first + blocks - 1, per_text))
    return starts, np.stack([left, right], axis=1)


def gradients(net: Network, texts: list[str], target: np.ndarray) -> list[np.ndarray]:
    data, blocks = padded(texts)
    windows = net.windows(data)
    response = (windows @ net.filters + net.bias).reshape(-1, WINDOWS, FILTERS)
    peak_at, lanes = response.argmax(1), np.arange(FILTERS)
    raw = np.take_along_axis(response, peak_at[:, None], 1)[:, 0]
    peaks = np.maximum(raw, 0)
    starts, chunks = chunk_rows(blocks)
    left, right = peaks[chunks[:, 0]], peaks[chunks[:, 1]]
    pooled = np.maximum(left, right)
    counts = np.diff(np.r_[starts, len(chunks)])
    features = net.features(peaks, blocks)
    hidden = np.maximum(features @ net.hidden + net.hidden_bias, 0)
    z = hidden @ net.out + net.out_bias[0]
    d_z = ((1 / (1 + np.exp(-np.clip(z, -50, 50))) - target) / len(texts)).astype(np.float32)
    d_hidden = np.outer(d_z, net.out) * (hidden > 0)
    d_features = d_hidden @ net.hidden.T
    mean, most, least = np.split(d_features, 3, axis=1)
    text_of = np.repeat(np.arange(len(texts)), counts)
    d_pooled = mean[text_of] / counts[text_of][:, None]
    for part, pick in ((most, np.maximum), (least, np.minimum)):
        hit = pooled == pick.reduceat(pooled, starts)[text_of]
        d_pooled += part[text_of] * hit / np.maximum(np.add.reduceat(hit, starts), 1)[text_of]
    d_peaks = np.zeros_like(peaks)
    from_left = left >= right
    np.add.at(d_peaks, chunks[:, 0], d_pooled * from_left)
    np.add.at(d_peaks, chunks[:, 1], d_pooled * ~from_left)
    d_peaks *= raw > 0
    window_of = peak_at + np.arange(len(peaks))[:, None] * WINDOWS
    d_filters = np.stack([windows[window_of[:, f]].T @ d_peaks[:, f] for f in lanes], axis=1)
    data = np.concatenate([data, np.zeros(WIDTH - STEP, np.uint8)])
    used = data[(window_of * STEP)[:, :, None] + np.arange(WIDTH)].reshape(-1)
    pull = (d_peaks[:, :, None] * net.filters.T[None]).reshape(-1, DEPTH)
    d_table = np.stack([np.bincount(used, pull[:, d], 256) for d in range(DEPTH)], axis=1)
    return [d_table, d_filters, d_peaks.sum(0), features.T @ d_hidden, d_hidden.sum(0), hidden.T @ d_z, d_z.sum(keepdims=True)]


def fit(texts: list[str], labels: np.ndarray, epochs: int = 10, least_steps: int = 600, batch: int = 32, rate: float = 4e-3, seed: int = 11) -> Network:
    """Adam with a falling rate on shuffled batches; few texts are gone over more often."""
    epochs = max(epochs, -(-least_steps * batch // len(texts)))
    net, rng = Network.fresh(seed), np.random.default_rng(seed)
    labels = labels.astype(np.float32)
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in net.weights()]
    steps, t = epochs * -(-len(texts) // batch), 0
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            t += 1
            now = rate * (1 - (t - 1) / steps)
            for w, (m, v), g in zip(net.weights(), moments, gradients(net, [texts[i] for i in some], labels[some]), strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= now * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return net


def held_out(key: Column) -> Column:
    """The quarter of the rows whose labels are never learned from."""
    return F.crc32(key.cast("string").cast("binary")) % 4 == 2


def training_rows(docs: DataFrame, labels: DataFrame) -> pd.DataFrame:
    """At most TRAIN_ROWS rows (text, quality) of labelled documents that are not held out."""
    known = keyed(labels, "doc_id").where(~held_out(F.col("doc_id")) & F.col("quality").isNotNull())
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(F.octet_length("text") <= TRAIN_BYTES)
    # labels of documents that are not here don't count towards the sample
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality")).join(rows.select("doc_id"), "doc_id", "left_semi")
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * TRAIN_ROWS)
    rows = rows.join(known, "doc_id").select(F.xxhash64("doc_id", "text").alias("h"), "text", "quality")
    return rows.orderBy("h", "text").limit(TRAIN_ROWS).toPandas()


def trained(docs: DataFrame, labels: DataFrame) -> Network | float:
    """The network, or a constant score if the labels are of one kind."""
    rows = training_rows(docs, labels)
    if rows.empty:
        return UNKNOWN
    share = float(rows["quality"].mean())
    return fit(rows["text"].tolist(), rows["quality"].to_numpy()) if 0 < share < 1 else share


def score(text: Column, model: Network | float) -> Column:
    """Probability of label 1 of every text."""
    if not isinstance(model, Network):
        return F.lit(model)

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            parts = [model(texts.iloc[i : i + 256].tolist()) for i in range(0, len(texts), 256)]
            yield pd.Series(np.concatenate(parts) if parts else [], dtype=float)

    return scores(F.coalesce(text, F.lit("")))
