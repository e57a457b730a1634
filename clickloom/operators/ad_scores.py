"""Scores of ads against articles, a block of words of each side at once.

A word of an ad scores the mean and one standard deviation of its cosines with the article's words, an ad the same of
its words' scores. The words of an article are turned into their mean and orthogonal parts of their spread, at most as
many as a vector has numbers; the deviation is then the length of the products with these parts. An unknown word (a
vector without length) has cosine -1 with every word, which one more number of every vector carries.

Products in single precision rule ads out, by a bound on their rounding. What may be the best ad of an article is
worked out in double precision, ties included.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ARTICLES = 32  # scored at once
WORDS = 4096  # of ads, scored at once
NUMBERS = 1 << 21  # of vectors that are compared in double precision at once


@dataclass
class Words:
    """Words by owner, owners by number of words; within one the words keep their order."""

    units: np.ndarray
    empty: np.ndarray
    starts: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, units: np.ndarray, empty: np.ndarray, owners: np.ndarray) -> Words:
        """``owners`` are sorted numbers from 0 on, one a word."""
        counts = np.bincount(owners)
        return cls(units, empty, np.cumsum(counts) - counts, counts)

    def classes(self, some: np.ndarray | None = None) -> list[tuple[int, np.ndarray]]:
        """(number of words, owners that have as many)."""
        some = np.arange(len(self.counts)) if some is None else some
        return [(int(n), some[self.counts[some] == n]) for n in np.unique(self.counts[some])]

    def rows(self, owners: np.ndarray, n: int) -> np.ndarray:
        return self.starts[owners][:, None] + np.arange(n)

    def once(self) -> np.ndarray:
        """Of owners with the same vectors the first."""
        seen: dict[bytes, int] = {}
        for i, (low, n) in enumerate(zip(self.starts, self.counts, strict=True)):
            seen.setdefault(b"".join(sorted(row.tobytes() for row in self.units[low : low + n])) + self.empty[low : low + n].sum().tobytes(), i)
        return np.array(sorted(seen.values()))


def apart(n: int) -> np.ndarray:
    """(n - 1, n): orthonormal rows whose numbers add up to nought."""
    k = np.arange(1, n)[:, None]
    at = np.arange(n)[None, :]
    return np.where(at < k, 1.0, np.where(at == k, -k, 0.0)) / np.sqrt(k * (k + 1))


def turned(units: np.ndarray, empty: np.ndarray) -> np.ndarray:
    """(1 + parts, articles, numbers + 1): mean, and orthogonal parts of the spread, of (articles, words, numbers)."""
    known = np.concatenate([np.where(empty[:, :, None], 0, units), -empty[:, :, None].astype(float)], axis=2)
    n, width = known.shape[1:]
    spread = apart(n) @ known / np.sqrt(n)
    if n - 1 > width and np.isfinite(spread).all():
        spread = np.linalg.qr(spread, mode="r")
    return np.concatenate([known.mean(1, keepdims=True), spread], axis=1).transpose(1, 0, 2)


def upper(values: np.ndarray, axis: int) -> np.ndarray:
    """Mean and population deviation."""
    mean = values.mean(axis, keepdims=True)
    return mean.squeeze(axis) + np.sqrt(((values - mean) ** 2).mean(axis))


def exact(articles: Words, ads: Words, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Score, and number of the best word inside the ad, of every pair in double precision."""
    scores, words = np.zeros(len(i)), np.zeros(len(i), np.int64)
    width = articles.units.shape[1]
    for n in np.unique(articles.counts[i]):
        for m in np.unique(ads.counts[j[articles.counts[i] == n]]):
            at = np.flatnonzero((articles.counts[i] == n) & (ads.counts[j] == m))
            step = max(1, NUMBERS // int((n + m) * max(1, width) + n * m))
            for some in (at[x : x + step] for x in range(0, len(at), step)):
                left, right = articles.rows(i[some], n), ads.rows(j[some], m)
                cosines = articles.units[left] @ ads.units[right].transpose(0, 2, 1)
                cosines[articles.empty[left][:, :, None] | ads.empty[right][:, None, :]] = -1.0
                each = upper(cosines, 1)
                scores[some], words[some] = upper(each, 1), np.argmax(np.round(each, 9), axis=1)
    return scores, words


def best_ads(articles: Words, ads: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ad, word inside it, score) of every article; of equal scores (to nine places) the first ad and word."""
    width = articles.units.shape[1]
    sides = []
    for m, own in ads.classes(ads.once()):
        step = max(1, WORDS // m)
        for some in (own[x : x + step] for x in range(0, len(own), step)):
            rows = ads.rows(some, m).T  # a plane per word
            vectors = np.concatenate([ads.units[rows], np.ones((*rows.shape, 1))], axis=2)
            sides.append((m, some, vectors.reshape(-1, width + 1).T.astype(np.float32, order="C"), ads.empty[rows].ravel()))
    order = np.concatenate([some for _, some, _, _ in sides])
    most = max(m for m, _, _, _ in sides)
    unknown = np.bitwise_and.reduceat(articles.empty, articles.starts)  # such an article has -1 with every ad
    found = np.zeros(len(unknown), np.int64), np.zeros(len(unknown), np.int64), np.where(unknown, -1.0, 0.0)
    for n, own in articles.classes(np.flatnonzero(~unknown)):
        slack = 16 * (width + n + most + 8) * np.finfo(np.float32).eps  # both scores may be off by half of it
        for some in (own[x : x + ARTICLES] for x in range(0, len(own), ARTICLES)):
            rows = articles.rows(some, n)
            parts = turned(articles.units[rows], articles.empty[rows]).astype(np.float32)
            count, flat, at = len(parts), parts.reshape(-1, width + 1), 0
            rough = np.empty((len(some), len(order)), np.float32)
            for m, those, vectors, empty in sides:
                product = (flat @ vectors).reshape(count, len(some), -1)
                each = product[0]
                if count > 1:
                    square = np.einsum("kij,kij->ij", product[1:], product[1:])
                    each += np.sqrt(square, out=square)
                each[:, empty] = -1.0
                score = each
                if m > 1:
                    planes = each.reshape(len(some), m, -1)
                    mean = planes.mean(1)
                    planes -= mean[:, None]
                    spread = np.einsum("imj,imj->ij", planes, planes)
                    spread /= m
                    score = mean + np.sqrt(spread, out=spread)
                rough[:, at : at + len(those)] = score
                at += len(those)
            # scores that are no numbers come before others: the first ad with one stands for them
            odd = np.isnan(rough)
            wild = odd.any(1)
            floor = np.where(wild, np.inf, rough.max(1) - slack)
            i, j = np.nonzero(rough >= floor[:, None])
            i, j = np.r_[i, np.flatnonzero(wild)], np.r_[order[j], np.where(odd, order, order.max() + 1)[wild].min(1)]
            score, word = exact(articles, ads, some[i], j)
            ranked = np.lexsort((j, -np.round(score, 9), i))
            first = ranked[np.unique(i[ranked], return_index=True)[1]]
            for out, values in zip(found, (j, word, score), strict=True):
                out[some[i[first]]] = values[first]
    return found
