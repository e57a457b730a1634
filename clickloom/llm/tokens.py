"""Token ids of whole texts by a word-level BPE vocabulary of the ``tokenizers`` library.

The library's own steps, with a table of pieces met before in front of its merges: normalise, split, look up.
Strings of added tokens become their ids, as in the library's plain call: they are split off before anything else, so
what only normalising turns into one is ordinary text. Null texts count as empty and have no ids.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickloom.llm.splitting import Splitter


class WordTokenizer:
    def __init__(self, path: str, limit: int = 300_000) -> None:
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # for what is between added tokens
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        steps, suffix = spec["pre_tokenizer"]["pretokenizers"], spec["model"]["end_of_word_suffix"]
        self.split = Splitter(next(s["pattern"]["Regex"] for s in steps if s["type"] == "Split"))
        self.ends_word = np.zeros(self.library.get_vocab_size(), bool)
        self.ends_word[[i for token, i in spec["model"]["vocab"].items() if token.endswith(suffix)]] = True
        self.added = {token["content"]: int(token["id"]).to_bytes(4, "little") for token in spec["added_tokens"]}
        self.mark = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) or r"(?!)")
        self.limit = limit
        self.pieces: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def normal(self, text: str) -> str:
        """As the library normalises; the first 256 code points are in normal form, and splitting drops white space."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.library.normalizer.normalize_str(text)
        return text.lower()

    def _learn(self, missing: set[str]) -> dict[str, bytes]:
        """Adds pieces to the table; long ones are returned instead."""
        old, new = self.old, []
        for piece in missing:
            ids = old.get(piece)
            if ids is None:
                new.append(piece)
            else:
                self.pieces[piece] = ids
        found = self._encode(new)
        self.pieces.update(found)
        long = {p: ids for p, ids in found.items() if len(p) > 32}
        for piece in long:
            del self.pieces[piece]
        return long

    def _encode(self, pieces: list[str]) -> dict[str, bytes]:
        """Pieces in one call, told apart by the tokens that end a word."""
        ids = np.array(self.library.encode_batch_fast([" ".join(pieces)], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(pieces):
            return {p: np.array(self.library.encode(p, add_special_tokens=False).ids, dtype="<u4").tobytes() for p in pieces}
        data, bounds = ids.tobytes(), [0, *(4 * ends).tolist()]
        return {p: data[a:b] for p, a, b in zip(pieces, bounds, bounds[1:], strict=False)}

    def __call__(self, text: str | None) -> bytes:
        out, at, text = [], 0, text or ""
        for found in self.mark.finditer(text):
            out += [self.between(text[at : found.start()]), self.added[found[0]]]
            at = found.end()
        rest = self.between(text[at:])
        return b"".join([*out, rest]) if out else rest

    def between(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        pieces, out = self.split(self.normal(text)), []
        for at in range(0, len(pieces), self.limit // 2):
            some = pieces[at : at + self.limit // 2]
            missing = set(some).difference(self.pieces)
            if missing and len(self.pieces) + len(missing) > self.limit:  # frequent pieces come back from the old table
                self.old, self.pieces = self.pieces, {}
                missing = set(some)
            long = self._learn(missing) if missing else {}
            known = self.pieces
            if long:  # what this text needs of the table, not a copy of all of it
                known = {p: long[p] if p in long else known[p] for p in set(some)}
            out.append(b"".join(map(known.__getitem__, some)))
        return out[0] if len(out) == 1 else b"".join(out)


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    """One per worker process and vocabulary."""
    return WordTokenizer(path)


def token_ids(text: Column, path: str) -> Column:
    """Ids of every text as little-endian unsigned 32-bit integers (binary)."""

    @F.pandas_udf("binary")
    def ids(texts: pd.Series) -> pd.Series:
        return pd.Series(list(map(tokenizer(path), texts)), dtype=object)

    return ids(text)
