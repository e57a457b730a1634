"""Token ids as packed binary matrices for training.

Documents are packed where they are read: a task gathers tokenized documents up to ``BUFFER`` ids, cuts those that are
longer than a sequence without loss, packs the pieces best-fit-decreasing and emits whole sequences, so no ids are
shuffled. The sequence with the least room that still suffices is found in a segment tree over the room left. A row is
one sequence: the padded id row, the cumulative segment lengths (0 first), and per segment its document, its start in
the document (where positions are reset to) and its piece number. Rows are stored as Parquet by Spark's writer, so a
repeated task leaves nothing behind.

Edge cases: documents without ids are one empty segment's end mark only if the caller adds one, else they have no
piece; null ids count as none; rows that repeat are packed each for itself; no documents make no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUFFER = 1 << 21
ROWS = (
    "sequence_id bigint, ids binary, n_ids int, cu_seqlens array<int>, doc_ids array<bigint>, "
    "starts array<bigint>, pieces array<int>"
)


class RoomTree:
    """Segment tree over room 0..capacity: how many open sequences have so much room."""

    def __init__(self, capacity: int) -> None:
        self.base = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.base)

    def add(self, room: int, change: int) -> None:
        node = self.base + room
        while node:
            self.count[node] += change
            node >>= 1

    def least_from(self, room: int) -> int | None:
        """The smallest room of at least ``room`` that an open sequence has."""
        node = self.base + room
        if self.count[node]:
            return room
        while node > 1:
            if node % 2 == 0 and self.count[node + 1]:  # the right neighbour has the next larger ones
                node += 1
                while node < self.base:
                    node = 2 * node if self.count[2 * node] else 2 * node + 1
                return node - self.base
            node >>= 1
        return None


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Indices of ``lengths`` by sequence."""
    tree, sequences = RoomTree(capacity), []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        room = tree.least_from(size)
        if room is None:
            room, at = capacity, len(sequences)
            sequences.append([])
        else:
            at = by_room[room].pop()
            tree.add(room, -1)
        sequences[at].append(i)
        if room > size:
            by_room[room - size].append(at)
            tree.add(room - size, 1)
    return sequences


def pieces_of(doc_id: int, ids: np.ndarray, capacity: int) -> Iterator[tuple[int, int, int, np.ndarray]]:
    for piece, start in enumerate(range(0, len(ids), capacity)):
        yield doc_id, start, piece, ids[start : start + capacity]


def pack_rows(
    docs: DataFrame, capacity: int = 4096, pad: int = 0, content: str = "ids", encode: Callable[[object], bytes] | None = None
) -> DataFrame:
    """Sequences of ``docs`` (doc_id, ``content``): ids as little-endian unsigned 32-bit integers.

    ``encode`` makes ids of the content, say of a text, in the task that packs them.
    """

    def emit(held: list, first: int) -> pd.DataFrame:
        rows = []
        for n, members in enumerate(best_fit_decreasing(np.array([len(p[3]) for p in held]), capacity)):
            some = [held[i] for i in members]
            bounds = np.cumsum([0, *(len(p[3]) for p in some)]).astype(np.int32)
            line = np.full(capacity, pad, "<u4")
            line[: bounds[-1]] = np.concatenate([p[3] for p in some])
            rows.append((first + n, line.tobytes(), int(bounds[-1]), bounds, *([p[k] for p in some] for k in range(3))))
        return pd.DataFrame(rows, columns=["sequence_id", "ids", "n_ids", "cu_seqlens", "doc_ids", "starts", "pieces"])

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        made, held, size = (context.partitionId() if context else 0) << 40, [], 0
        for batch in batches:
            for doc_id, data in zip(batch["doc_id"], map(encode, batch[content]) if encode else batch[content], strict=True):
                for piece in pieces_of(doc_id, np.frombuffer(data or b"", "<u4"), capacity):
                    held.append(piece)
                    size += len(piece[3])
                    if size >= BUFFER:
                        out = emit(held, made)
                        made, held, size = made + len(out), [], 0
                        yield out
        if held:
            yield emit(held, made)

    return docs.select("doc_id", content).mapInPandas(run, ROWS)


def segments(sequences: DataFrame) -> DataFrame:
    """One row per segment: doc_id, piece, start, length, segment_ids, sequence_id, offset."""
    each = F.arrays_zip(F.col("doc_ids").alias("doc_id"), F.col("starts").alias("start"), F.col("pieces").alias("piece"), F.slice("cu_seqlens", F.lit(1), F.size("doc_ids")).alias("low"), F.slice("cu_seqlens", F.lit(2), F.size("doc_ids")).alias("high"))
    rows = sequences.select("sequence_id", "ids", F.explode(each).alias("s"))
    length = F.col("s.high") - F.col("s.low")
    return rows.select(
        "s.doc_id", "s.piece", "s.start", length.cast("long").alias("length"),
        F.substring("ids", F.col("s.low") * 4 + 1, length * 4).alias("segment_ids"),
        "sequence_id", F.col("s.low").cast("long").alias("offset"),
    )


def matrix(rows: Iterable[bytes]) -> np.ndarray:
    """Id rows as a matrix, for a loader."""
    return np.stack([np.frombuffer(r, "<u4") for r in rows])


def positions(cu_seqlens: Iterable[int], starts: Iterable[int]) -> np.ndarray:
    """Position of every id within its document, reset at each segment."""
    bounds = list(cu_seqlens)
    return np.concatenate([np.arange(b - a) + s for a, b, s in zip(bounds, bounds[1:], starts, strict=False)])
