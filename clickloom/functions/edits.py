"""Unrestricted Damerau-Levenshtein distance: small per-pair helper, many pairs at once, and a [pandas] UDF around them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

CELLS = 1 << 19  # numbers of all tables of a step
FEW = 8  # pairs that are not worth a step of their own


def edit_distance(a: str, b: str) -> int:
    """Insert, delete, substitute and transpose; text between transposed letters may change too."""
    if a == b:
        return 0
    width = len(b) + 1
    far = len(a) + len(b)
    rows = [[far] * (width + 1)]
    rows.append([far, *range(width)])
    seen_in_a: dict[str, int] = {}
    for i, x in enumerate(a, 1):
        row = [far, i]
        match_col = 0
        above = rows[i]
        for j, y in enumerate(b, 1):
            swap_row = seen_in_a.get(y, 0)
            swapped = rows[swap_row][match_col] + (i - swap_row - 1) + 1 + (j - match_col - 1)
            if x == y:
                match_col = j
                row.append(min(above[j], swapped))
            else:
                row.append(min(above[j] + 1, above[j + 1] + 1, row[j] + 1, swapped))
        rows.append(row)
        seen_in_a[x] = i
    return rows[-1][-1]


@dataclass
class Letters:
    """Words as code points, one after another."""

    words: Sequence[str]
    flat: np.ndarray
    start: np.ndarray
    size: np.ndarray

    @classmethod
    def of(cls, words: Sequence[str]) -> Letters:
        size = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        return cls(words, np.append(flat, np.uint32(0)), np.cumsum(size) - size, size)

    def table(self, start: np.ndarray, width: int) -> np.ndarray:
        """(place, pair) letters; beyond a word's end they are of no account."""
        return self.flat[np.minimum(start + np.arange(width)[:, None], len(self.flat) - 1)]


def edit_distances(left: Letters, i: np.ndarray, right: Letters, j: np.ndarray) -> np.ndarray:
    """``edit_distance`` of the words ``i`` and ``j``, pair by pair.

    Letters that both words begin or end with cost nothing. What is left is worked out a table at a time for pairs of
    like lengths, so one long word does not make the tables of others large.
    """
    a, n, b, m = left.start[i], left.size[i], right.start[j], right.size[j]
    for ends in (False, True):
        live = np.flatnonzero((n > 0) & (m > 0))
        while len(live):
            x = left.flat[a[live] + (n[live] - 1 if ends else 0)]
            live = live[x == right.flat[b[live] + (m[live] - 1 if ends else 0)]]
            n[live] -= 1
            m[live] -= 1
            if not ends:
                a[live] += 1
                b[live] += 1
            live = live[(n[live] > 0) & (m[live] > 0)]
    out = np.maximum(n, m)
    rest = np.flatnonzero((n > 0) & (m > 0) & (out > 1))  # single letters that differ are one replacement
    rest = rest[np.lexsort((m[rest], n[rest]))]
    at = 0
    while at < len(rest):
        wide = (n[rest[at]] + 2) * (m[rest[at]] + 2)
        some = rest[at : at + max(1, CELLS // wide)]
        same = (n[some] == n[some[0]]) & (m[some] == m[some[0]])
        some = some[: len(some) if same.all() else int(same.argmin())]
        at += len(some)
        if len(some) < FEW:
            out[some] = [edit_distance(left.words[x], right.words[y]) for x, y in zip(i[some], j[some])]
        else:
            rows, columns = int(n[some[0]]), int(m[some[0]])
            out[some] = _distances(left.table(a[some], rows), right.table(b[some], columns))
    return out


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of (place, pair) letters, all words of a side of one length."""
    n, m, pairs = len(a), len(b), a.shape[1]
    far, each = n + m, np.arange(pairs)
    cost = np.full((n + 2, m + 2, pairs), far, np.int32)
    cost[1, 1:] = np.arange(m + 1)[:, None]
    cost[1:, 1] = np.arange(n + 1)[:, None]
    flat = cost.reshape(-1)
    swap_row = np.zeros((m, pairs), np.int64)  # last row whose letter is the column's
    for i in range(1, n + 1):
        match_col = np.zeros(pairs, np.int64)
        for j in range(1, m + 1):
            same = a[i - 1] == b[j - 1]
            row = swap_row[j - 1]
            best = np.minimum(cost[i, j + 1], cost[i + 1, j])
            best += 1
            np.minimum(best, cost[i, j] + ~same, out=best)
            swaps = np.flatnonzero((row > 0) & (match_col > 0))
            if len(swaps):
                r, c = row[swaps], match_col[swaps]
                swapped = flat[(r * (m + 2) + c) * pairs + each[swaps]] + (i - r) + (j - c) - 1
                best[swaps] = np.minimum(best[swaps], swapped)
            cost[i + 1, j + 1] = best
            match_col[same] = j
            row[same] = i
    return cost[-1, -1]


@F.pandas_udf(T.IntegerType())
def damerau(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([edit_distance(x, y) for x, y in zip(a, b)], dtype="int32")
