"""Sum-of-squares packing of documents into sequences of a fixed capacity.

Documents longer than the capacity are cut into pieces of exactly that length (the last may be shorter); every
piece goes whole into one sequence. Packing needs lengths only: the table of pieces is dealt out evenly into
shards of a bounded number of rows, and each shard packs its own. A shard leaves a few sequences part empty,
which is little beside the ten thousands it fills.

Within a shard, with ``open[g]`` the number of open sequences that have room for exactly ``g`` more tokens, a
piece goes where the sum of ``open[g] ** 2`` over all gaps becomes smallest: into an open sequence of some gap or
into a new one. Ties take the smallest gap, a new sequence last. A shard is packed in two orders, by falling length
and with the pieces of up to half a sequence shuffled by a fixed seed behind the longer ones; the order that needs
fewer sequences counts.

Edge cases: a document without tokens but the end mark is a piece of length 1; no documents give no rows; equal
and repeated documents are packed each for itself.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import shares
from clickloom.session import materialise

ID_BYTES = 4
NONE_OPEN = 1 << 30  # beyond any change of the sum


def cut(docs: DataFrame, ids: Column, capacity: int, *keep: str) -> DataFrame:
    """Pieces of at most ``capacity`` ids: (``keep``, piece, start, length, piece_ids)."""
    pieces = docs.select(*keep, ids.alias("_ids")).withColumn("_n", (F.octet_length("_ids") / ID_BYTES).cast("long"))
    last = F.greatest(F.ceil(F.col("_n") / capacity).cast("int") - 1, F.lit(0))
    pieces = pieces.select("*", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    start = F.col("piece").cast("long") * capacity
    length = F.least(F.col("_n") - start, F.lit(capacity).cast("long"))
    part = F.substring("_ids", (start * ID_BYTES + 1).cast("int"), (length * ID_BYTES).cast("int"))
    return pieces.select(*keep, "piece", start.alias("start"), length.alias("length"), part.alias("piece_ids"))


class SumOfSquares:
    """Open sequences by gap; ``place`` gives (sequence, offset)."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        # by gap, what the sum of squares gains by one sequence fewer and by one more; a full sequence counts nowhere
        self.fewer = np.full(capacity + 1, NONE_OPEN, np.int32)
        self.more = np.ones(capacity + 1, np.int32)
        self.more[0] = 0
        self.change = np.empty(capacity + 1, np.int32)
        self.by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.made = 0

    def _count(self, gap: int) -> None:
        n = len(self.by_gap[gap])
        self.fewer[gap] = 1 - 2 * n if n else NONE_OPEN
        self.more[gap] = 2 * n + 1

    def place(self, size: int) -> tuple[int, int]:
        left = self.capacity - size
        change = np.add(self.fewer[size:], self.more[: left + 1], out=self.change[: left + 1])
        best = int(change.argmin())
        if self.by_gap[best + size] and change[best] <= self.more[left]:
            gap = best + size
            bin_ = self.by_gap[gap].pop()
            self._count(gap)
        else:
            gap, bin_ = self.capacity, self.made
            self.made += 1
        rest = gap - size
        if rest:
            self.by_gap[rest].append(bin_)
            self._count(rest)
        return bin_, self.capacity - gap


def place_all(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Sequence and offset of every length, in the order given."""
    packer = SumOfSquares(capacity)
    places = [packer.place(n) for n in lengths]
    return [b for b, _ in places], [o for _, o in places]


def pack(pieces: DataFrame, capacity: int = 4096, shard_rows: int = 50_000) -> DataFrame:
    """``pieces`` (with ``length``) plus ``sequence_id`` and ``offset``; any other columns are kept.

    ``sequence_id`` and ``offset`` of the input, if it has such columns, are replaced.
    """
    stored = materialise(pieces.drop("sequence_id", "offset"), "pieces")
    shards = shares(stored.count(), shard_rows)
    # the place of a row in the stored table, so that repeated rows spread as well
    dealt = stored.withColumn("_shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
    schema = dealt.drop("_shard").schema.add("sequence_id", "long").add("offset", "long")

    def one_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop(columns="_shard").sort_values("length", ascending=False, kind="stable")
        half = int((rows["length"] > capacity // 2).sum())
        orders = [rows, pd.concat([rows.iloc[:half], rows.iloc[half:].sample(frac=1, random_state=7)])]
        tried = [place_all(order["length"].tolist(), capacity) for order in orders]
        best = min(range(2), key=lambda i: max(tried[i][0], default=0))
        bins, offsets = tried[best]
        return orders[best].assign(sequence_id=np.array(bins, np.int64) + (int(key[0]) << 32), offset=np.array(offsets, np.int64))

    return dealt.groupBy("_shard").applyInPandas(one_shard, schema)
