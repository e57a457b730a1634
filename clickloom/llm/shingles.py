"""Sets of word shingles as sorted 64-bit hashes.

Words are runs of other than space, tab, line feed, vertical tab, form feed and carriage return, with A-Z in lower
case. A text's set holds the hash of every run of ``width`` words; a text with fewer words but one at least has one
element for the whole of it; a text without words has none.

Words are hashed in bulk: every byte stands for a fixed random number, a word's hash is the sum of its bytes' numbers
times rising powers of an odd number (modulo 2 ** 64), taken from running sums over a block of text.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np

_RNG = np.random.default_rng(20240607)
_ODD = _RNG.integers(1 << 62, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_NUMBER = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_NUMBER[ord("A") : ord("Z") + 1] = _NUMBER[ord("a") : ord("z") + 1]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_GAP = re.compile(rb"[\x20\x09-\x0D]")
BLOCK = 1 << 18
_BASE = (0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse; those of an ordinary block are kept."""
    if len(_powers[0]) <= n:
        size = max(n, BLOCK + (BLOCK >> 2)) + 1
        grown = []
        for base in _BASE:
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            grown.append(np.multiply.accumulate(steps))
        if size > 2 * BLOCK:
            return grown[0], grown[1]
        _powers[:] = grown
    return _powers[0], _powers[1]


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit value from each, whose bits all depend on all of its bits."""
    values = (values ^ (values >> np.uint64(32))) * _ODD[60]
    values = (values ^ (values >> np.uint64(29))) * _ODD[61]
    return values ^ (values >> np.uint64(32))


def word_codes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words of a block."""
    raw = np.frombuffer(data, np.uint8)
    word = np.zeros(len(raw) + 2, np.int8)
    word[1:-1] = ~_SPACE[raw]
    edges = np.diff(word)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    powers, inverse = _powers_to(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_NUMBER[raw] * powers[: len(raw)], out=sums[1:])
    codes = (sums[ends] - sums[starts]) * inverse[starts]
    return mixed(codes + (ends - starts).astype(np.uint64) * _ODD[62]), starts


def _long_codes(data: bytes) -> np.ndarray:
    """Hashes of the words of a long text, in blocks that end between words."""
    parts, at = [], 0
    while at < len(data):
        gap = _GAP.search(data, min(at + BLOCK, len(data)))
        end = gap.start() if gap else len(data)
        parts.append(word_codes(data[at:end])[0])
        at = end + 1
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def text_codes(texts: Iterable[str]) -> Iterator[np.ndarray]:
    """The word hashes of every text, in order."""

    def flush() -> Iterator[np.ndarray]:
        codes, starts = word_codes(b"\n".join(waiting))
        ends = np.searchsorted(starts, np.cumsum([len(w) + 1 for w in waiting]))
        yield from np.split(codes, ends[:-1])

    waiting, size = [], 0
    for text in texts:
        data = text.encode("utf-8", "surrogatepass")
        if waiting and size + len(data) > BLOCK:
            yield from flush()
            waiting, size = [], 0
        if len(data) > BLOCK:
            yield _long_codes(data)
        else:
            waiting.append(data)
            size += len(data) + 1
    if waiting:
        yield from flush()


def _set_of(codes: np.ndarray, width: int) -> np.ndarray:
    if len(codes) < width:
        if not len(codes):
            return codes
        return mixed((codes * _ODD[: len(codes)]).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(codes)))
    runs = len(codes) - width + 1
    total = codes[:runs] * _ODD[0]
    for i in range(1, width):
        total += codes[i : i + runs] * _ODD[i]
    return np.unique(mixed(total))


def shingle_sets(texts: Iterable[str], width: int = 5) -> Iterator[np.ndarray]:
    """Sorted distinct hashes (uint64) of every text."""
    return (_set_of(codes, width) for codes in text_codes(texts))


def shingle_set(text: str, width: int = 5) -> np.ndarray:
    return next(shingle_sets([text], width))


def set_key(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart, as two signed longs."""
    a = mixed(hashes * _ODD[62]).sum(dtype=np.uint64)
    b = mixed(hashes * _ODD[63] + np.uint64(1)).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))
