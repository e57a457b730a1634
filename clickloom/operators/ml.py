"""Embedding training and item clustering with Spark ML."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.feature import PCA, StandardScaler, Word2Vec
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.session import materialise

PART_WORDS = 1 << 20  # words of training that one task walks
PART_ROWS = 1 << 13  # vectors that one task of a mixture walks
BLOCK_ROWS = 1 << 9
EPSILON = 2.0**-52
MOST_STEPS, LEAST_GAIN = 50, 0.01


def training_partitions(docs: DataFrame, tokens: str = "tokens") -> int:
    """One task per ``PART_WORDS`` words, so that a task's share does not grow; the tasks' vectors are averaged."""
    words = docs.agg(F.sum(F.greatest(F.size(tokens), F.lit(0)))).first()[0] or 0
    return max(1, -(-words // PART_WORDS))


def train_embedding(
    docs: DataFrame, tokens: str = "tokens", size: int = 100, window: int = 5, min_count: int = 100,
    epochs: int = 5, seed: int = 42, partitions: int = 1,
):
    """Skip-gram embedding; returns the fitted model (``getVectors``, ``findSynonyms``, ``transform``)."""
    trainer = Word2Vec(
        vectorSize=size, windowSize=window, minCount=min_count, maxIter=epochs, seed=seed,
        numPartitions=partitions, inputCol=tokens, outputCol="vector",
    )
    return trainer.fit(docs)


def _free_parameters(k: int, dims: int) -> int:
    return k * (dims * (dims + 1) // 2 + dims + 1) - 1


def reduce_dim(df: DataFrame, vector: str = "vector", dims: int = 10) -> DataFrame:
    """Standardised (sample deviation) and projected vectors as column ``reduced``."""
    ready = df.withColumn("_v", array_to_vector(F.col(vector).cast("array<double>")))
    scaler = StandardScaler(withMean=True, withStd=True, inputCol="_v", outputCol="_s").fit(ready)
    scaled = scaler.transform(ready)
    return PCA(k=dims, inputCol="_s", outputCol="reduced").fit(scaled).transform(scaled).drop("_v", "_s")


class _Mixture:
    """Weights, means and covariances of one mixture, with what densities and the next estimate need."""

    def __init__(self, weights: np.ndarray, means: np.ndarray, covs: np.ndarray) -> None:
        self.weights, self.means = weights, means
        k, dims = means.shape
        values, axes = np.linalg.eigh(covs)
        some = values > EPSILON * dims * values.max(axis=1, keepdims=True)
        if not some.any(axis=1).all():
            raise ValueError("a covariance matrix has no non-zero singular values")
        safe = np.where(some, values, 1.0)
        # pseudo-inverse roots, side by side
        self.roots = (axes * np.where(some, safe**-0.5, 0.0)[:, None, :]).transpose(1, 0, 2).reshape(dims, -1)
        self.shift = (means[:, None, :] @ self.roots.reshape(dims, k, dims).transpose(1, 0, 2)).reshape(-1)
        self.scale = -0.5 * (dims * math.log(2 * math.pi) + np.log(safe).sum(axis=1))

    def shares(self, rows: np.ndarray) -> np.ndarray:
        """Weighted densities of every row in every component, never quite 0."""
        k, dims = self.means.shape
        off = (rows @ self.roots - self.shift).reshape(-1, k, dims)
        return EPSILON + self.weights * np.exp(self.scale - 0.5 * np.einsum("rkd,rkd->rk", off, off))

    def sums(self, rows: np.ndarray, squares: np.ndarray) -> np.ndarray:
        """Log-likelihood, then per component its share of the rows, of their sums and of their products' sums."""
        parts = self.shares(rows)
        total = parts.sum(axis=1, keepdims=True)
        parts /= total
        found = np.hstack([parts.sum(axis=0)[:, None], parts.T @ rows, parts.T @ squares])
        return np.r_[np.log(total).sum(), found.reshape(-1)]

    def improved(self, sums: np.ndarray) -> _Mixture:
        k, dims = self.means.shape
        found = sums.reshape(k, -1)
        share = found[:, 0]
        means = found[:, 1 : dims + 1] / share[:, None]
        products = found[:, dims + 1 :].reshape(k, dims, dims) / share[:, None, None]
        return _Mixture(share / share.sum(), means, products - means[:, :, None] * means[:, None, :])


def _started(reduced: DataFrame, k: int, seed: int) -> _Mixture:
    """The mixture from which Spark's own ``GaussianMixture`` starts."""
    model = GaussianMixture(k=k, featuresCol="reduced", predictionCol="cluster", seed=seed, maxIter=0).fit(reduced)
    found = model.gaussians
    return _Mixture(np.array(model.weights), np.array([g.mean.toArray() for g in found]), np.array([g.cov.toArray() for g in found]))


def _blocks(batches: Iterable[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    for batch in batches:
        rows = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
        for at in range(0, len(rows), BLOCK_ROWS):
            yield rows[at : at + BLOCK_ROWS]


def _expectation(vectors: DataFrame, mixtures: dict[int, _Mixture], dims: int) -> dict[int, np.ndarray]:
    """The sums of every mixture over all rows, all mixtures in one pass."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray | int] = dict.fromkeys(mixtures, 0)
        for rows in _blocks(batches, dims):
            squares = (rows[:, :, None] * rows[:, None, :]).reshape(len(rows), -1)
            for k, mixture in mixtures.items():
                totals[k] = totals[k] + mixture.sums(rows, squares)
        found = {k: t for k, t in totals.items() if not isinstance(t, int)}
        yield pa.RecordBatch.from_pydict({"k": pa.array(found.keys(), pa.int32()), "sums": pa.array(list(found.values()), pa.list_(pa.float64()))})

    parts = vectors.mapInArrow(run, "k int, sums array<double>")
    summed = parts.groupBy("k").agg(Summarizer.sum(array_to_vector("sums")).alias("sums"))
    return {row["k"]: row["sums"].toArray() for row in summed.collect()}


def cluster_items(
    df: DataFrame, vector: str = "vector", dims: int = 10, k_range: Sequence[int] = range(10, 30), seed: int = 42
) -> tuple[DataFrame, dict[int, float]]:
    """Gaussian mixture over reduced vectors with the component count of least BIC.

    Starts, steps and ends like Spark's ``GaussianMixture`` (50 steps at most), but a pass over the rows serves the
    mixtures of all counts. Returns rows with ``cluster`` and the BIC of every tried count.
    """
    reduced = reduce_dim(df, vector, dims).persist()
    rows = reduced.count()
    vectors = reduced.select(vector_to_array("reduced").alias("reduced")).repartition(max(1, -(-rows // PART_ROWS)))
    vectors = materialise(vectors, "reduced")
    mixtures = {k: _started(reduced, k, seed) for k in k_range}
    likelihoods, active = dict.fromkeys(mixtures, -math.inf), dict(mixtures)
    for _ in range(MOST_STEPS):
        for k, sums in _expectation(vectors, active, dims).items():
            gain, likelihoods[k] = abs(sums[0] - likelihoods[k]), sums[0]
            mixtures[k] = active[k] = active[k].improved(sums[1:])
            if gain <= LEAST_GAIN:
                del active[k]
        if not active:
            break
    bics = {k: _free_parameters(k, dims) * math.log(rows) - 2 * float(found) for k, found in likelihoods.items()}
    chosen = mixtures[min(bics, key=bics.get)]

    @F.pandas_udf("int")
    def cluster(points: pd.Series) -> pd.Series:
        found = [chosen.shares(np.stack(points[at : at + BLOCK_ROWS])).argmax(axis=1) for at in range(0, len(points), BLOCK_ROWS)]
        return pd.Series(np.concatenate(found) if found else [], dtype="int32")

    clustered = reduced.withColumn("cluster", cluster(vector_to_array("reduced"))).drop("reduced")
    return clustered, bics
