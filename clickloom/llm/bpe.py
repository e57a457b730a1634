"""Byte-level BPE: encoding by a lazily determinised transducer, decoding by an incremental UTF-8 machine.

A sequence of tokens is the BPE encoding of its bytes exactly if every two neighbours are: encoding the bytes
of the pair gives the pair back. So the last token of every prefix is unique, and an encoder needs to remember
only the prefixes that a longer token may still reach back to. Such a set of live prefixes is a state. Reading
a byte moves every live prefix along the token trie, adds the prefix that ends at this byte and drops those
that no token continues. Tokens on which all live prefixes agree are emitted, so output lags behind the input
by less than the longest token. States and transitions are made when first met and kept in a table of bounded
size; a full table is emptied, which changes no result. How the trie nodes of a state move depends on the nodes
alone, which few sets of prefixes differ in, so that part is kept once for all states of equal nodes.

Edge cases: null text counts as empty and gives no ids; malformed byte sequences decode to the bytes they are.
"""

from __future__ import annotations

import base64
import gc
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from clickloom.llm.splitting import Splitter

ROOT = 0
START = -1


class PairRule:
    """Which tokens a vocabulary can produce, and which may follow which."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.spelling = {rank: piece for piece, rank in ranks.items()}
        self._halves: dict[int, tuple[int, int] | None] = {}
        self.allowed: dict[int, bool] = {}  # by left << 32 | right

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; (token, token) for one byte, None if merging never makes it."""
        if token not in self._halves:
            self._halves[token] = self._last_merge(token)
        return self._halves[token]

    def _last_merge(self, token: int) -> tuple[int, int] | None:
        spelling = self.spelling[token]
        if len(spelling) == 1:
            return token, token
        parts = [spelling[i : i + 1] for i in range(len(spelling))]
        while len(parts) > 2:
            merges = [(self.ranks.get(a + b), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            found = min(((rank, i) for rank, i in merges if rank is not None), default=None)
            if found is None or found[0] >= token:
                return None
            i = found[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        left, right = (self.ranks.get(p) for p in parts)
        return None if left is None or right is None else (left, right)

    def may_follow(self, left: int, right: int) -> bool:
        key = left << 32 | right
        follows = self.allowed.get(key)
        if follows is None:
            if len(self.allowed) >= 1_000_000:
                self.allowed.clear()
            follows = self.allowed[key] = self._stays_apart(left, right)
        return follows

    def _stays_apart(self, left: int, right: int) -> bool:
        """No merge across the border comes before the merges that make the two tokens themselves.

        Undo the later of the two last merges, again and again: what then touches the border must not merge
        earlier than the merge just undone (equal ranks go left to right).
        """
        before = len(self.ranks) + 1  # a merge across the border counts if its rank is below this
        while True:
            across = self.ranks.get(self.spelling[left] + self.spelling[right])
            if across is not None and across < before:
                return False
            left_whole, right_whole = len(self.spelling[left]) == 1, len(self.spelling[right]) == 1
            if left_whole and right_whole:
                return True
            if right_whole or (not left_whole and left > right):
                before, left = left, self.halves(left)[1]
            else:
                before, right = right + 1, self.halves(right)[0]


class _Path:
    """Tokens not emitted yet that spell a live prefix, and the last token of it, emitted or not."""

    __slots__ = ("pending", "last")

    def __init__(self, pending: tuple[int, ...], last: int) -> None:
        self.pending, self.last = pending, last


class _Reach(dict):
    """Trie nodes that live prefixes have reached, oldest prefix first; items are the moves of the nodes, by byte."""

    __slots__ = ("nodes", "machine")

    def __init__(self, nodes: tuple[int, ...], machine: MergeTransducer) -> None:
        super().__init__()
        self.nodes, self.machine = nodes, machine

    def __missing__(self, byte: int) -> tuple[_Reach, tuple[int, ...], tuple[tuple[int, int], ...], tuple[int, int]]:
        self[byte] = self.machine.reach(self, byte)
        return self[byte]


class _State(dict):
    """Live prefixes: their nodes and their paths; items are the moves made so far, by byte."""

    __slots__ = ("nodes", "paths", "machine")

    def __init__(self, nodes: _Reach, paths: tuple[_Path, ...], machine: MergeTransducer) -> None:
        super().__init__()
        self.nodes, self.paths, self.machine = nodes, paths, machine

    def __missing__(self, byte: int) -> tuple[_State, tuple[int, ...]]:
        return self.machine.step(self, byte)


class MergeTransducer:
    """Bytes in, token ids out, one table look-up per byte."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = 200_000) -> None:
        self.rule = PairRule(ranks)
        self.max_states = max_states
        self.children: list[dict[int, int]] = [{}]
        self.token_at: list[int] = [START]
        for spelling, rank in ranks.items():
            node = ROOT
            for byte in spelling:
                nxt = self.children[node].get(byte)
                if nxt is None:
                    nxt = self.children[node][byte] = len(self.children)
                    self.children.append({})
                    self.token_at.append(START)
                node = nxt
            self.token_at[node] = rank
        self.states: dict[tuple, _State] = {}
        self.reached: dict[tuple[int, ...], _Reach] = {}
        self.paths: dict[tuple[int, ...] | int, _Path] = {}  # equal paths of several states are one object
        self._forget()

    def _path(self, pending: tuple[int, ...], last: int) -> _Path:
        key = pending or last  # pending tokens end with the last one
        path = self.paths.get(key)
        if path is None:
            path = self.paths[key] = _Path(pending, last)
        return path

    def _forget(self) -> None:
        """Empty the tables. A run goes on from the state it holds; what it meets then is made anew."""
        for table in (self.states, self.reached):
            for known in table.values():
                known.clear()
            table.clear()
        self.paths.clear()
        nodes = self.reached[(ROOT,)] = _Reach((ROOT,), self)
        self.first = _State(nodes, (self._path((), START),), self)
        self.states[nodes.nodes, *self.first.paths] = self.first

    def reach(self, before: _Reach, byte: int) -> tuple[_Reach, tuple[int, ...], tuple[tuple[int, int], ...], tuple[int, int]]:
        """Nodes after ``byte``, which prefixes stay live, and (prefix, token) of the tokens that end here, the shortest apart."""
        found = [(i, self.children[node][byte]) for i, node in enumerate(before.nodes) if byte in self.children[node]]
        ends = [(i, self.token_at[node]) for i, node in found]
        ends = [(i, token) for i, token in ends if token != START and self.rule.halves(token) is not None]
        if not ends:
            raise ValueError("the vocabulary lacks a token for a byte")
        stay = [(i, node) for i, node in found if self.children[node]]
        nodes = (*(node for _, node in stay), ROOT)
        after = self.reached.get(nodes)
        if after is None:
            after = self.reached[nodes] = _Reach(nodes, self)
        return after, tuple(i for i, _ in stay), tuple(ends[:-1]), ends[-1]

    def step(self, state: _State, byte: int) -> tuple[_State, tuple[int, ...]]:
        if len(self.states) >= self.max_states:
            self._forget()
        nodes, stay, maybe, (i, token) = state.nodes[byte]
        # exactly one token ends a prefix, so if no other may follow its path, it is the shortest
        for j, other in maybe:
            last = state.paths[j].last
            if last == START or self.rule.may_follow(last, other):
                i, token = j, other
                break
        live = [state.paths[j] for j in stay]
        live.append(self._path((*state.paths[i].pending, token), token))
        out = live[0].pending
        for path in live:
            while out != path.pending[: len(out)]:
                out = out[:-1]
        if out:
            agreed = len(out)
            live = [self._path(path.pending[agreed:], path.last) for path in live]
        key = (nodes.nodes, *live)
        target = self.states.get(key)
        if target is None:
            target = self.states[key] = _State(nodes, key[1:], self)
        move = state[byte] = target, out
        return move

    def run(self, data: bytes) -> list[int]:
        """Ids of one piece of text that merges may not leave."""
        ids: list[int] = []
        state = self.first
        for byte in data:
            state, out = state[byte]
            if out:
                ids += out
        ids += state.paths[-1].pending  # the last prefix is the one that ends here
        return ids


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class _Pieces(dict):
    """Ids of pieces met lately, as little-endian 32-bit integers. A full table becomes the old one, which is
    looked up once more before a piece is encoded anew, so frequent pieces stay."""

    def __init__(self, ranks: dict[bytes, int], limit: int = 120_000) -> None:
        super().__init__()
        self.ranks, self.limit = ranks, limit
        self.machine = MergeTransducer(ranks)
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            data = piece.encode("utf-8", "surrogatepass")
            whole = self.ranks.get(data)
            ids = packed(self.machine.run(data) if whole is None else [whole])
            if len(piece) > 32:
                return ids
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[piece] = ids
        return ids


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Encoder:
    """Whole texts to ids: split by ``pattern``, each match encoded by itself, no special tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.split = Splitter(pattern)
        self.pieces = _Pieces(ranks)

    def __call__(self, text: str | None) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.split(text or "")))


class Utf8Machine:
    """Cuts a byte stream behind its last whole character, whatever the blocks it comes in."""

    def __init__(self) -> None:
        self.held = b""

    @staticmethod
    def open_tail(data: bytes) -> int:
        """How many bytes at the end begin a character that isn't whole yet."""
        for back in range(1, min(4, len(data) + 1)):
            byte = data[-back]
            if byte >= 0xC0:
                size = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                return back if size > back else 0
            if byte < 0x80:
                return 0
        return 0

    def feed(self, data: bytes) -> bytes:
        data = self.held + data
        tail = self.open_tail(data)
        self.held = data[len(data) - tail :]
        return data[: len(data) - tail]

    def end(self) -> bytes:
        rest, self.held = self.held, b""
        return rest


class Decoder:
    """Ids to bytes in blocks that end with a whole character."""

    def __init__(self, ranks: dict[bytes, int], block: int = 1 << 16) -> None:
        self.block = block
        self.spelling: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for spelling, rank in ranks.items():
            self.spelling[rank] = spelling

    def stream(self, blocks: Iterable[list[int]]) -> Iterator[bytes]:
        machine = Utf8Machine()
        for ids in blocks:
            yield machine.feed(b"".join(map(self.spelling.__getitem__, ids)))
        yield machine.end()

    def __call__(self, ids: bytes | None) -> bytes:
        numbers = np.frombuffer(ids or b"", dtype="<u4")
        blocks = (numbers[i : i + self.block].tolist() for i in range(0, len(numbers), self.block))
        return b"".join(self.stream(blocks))


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    return Encoder(load_ranks(path), pattern)


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(load_ranks(path))


def encode(text: Column, path: str, pattern: str) -> Column:
    """Ids of every text as little-endian unsigned 32-bit integers (binary); null and empty texts have none."""

    @F.pandas_udf("binary")
    def ids(texts: pd.Series) -> pd.Series:
        # no garbage is cyclic here (a full table is taken apart), and the collector would walk the table all the time
        gc.disable()
        try:
            return pd.Series(list(map(encoder(path, pattern), texts)), dtype=object)
        finally:
            gc.enable()

    return ids(text)


def decode(ids: Column, path: str) -> Column:
    """The bytes that ids stand for (binary), made block by block; null ids give no bytes."""

    @F.pandas_udf("binary")
    def data(rows: pd.Series) -> pd.Series:
        return pd.Series(list(map(decoder(path), rows)), dtype=object)

    return data(ids)
