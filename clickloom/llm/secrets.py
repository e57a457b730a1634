"""Secrets in text: plain patterns, and parts of a credential that count only when they stand together.

Kinds of spans, in this order:

* ``assign``, ``access``, ``hex``: a match of the kind's pattern that is long enough.
* ``linked_id``, ``linked_secret``, ``linked_endpoint``: weak candidates. Every identifier (an ``access`` span or
  a weak identifier) opens an interval of ``REACH`` code points to either side, cut at the blank lines around
  it: its scope. The sorted candidates are interval-joined with the scopes. A weak secret is reported if an
  identifier's scope holds it, a weak identifier if its scope holds a secret of any kind, and an endpoint if a
  scope holds it together with a secret. Weak candidates that overlap a plain span are not reported.

Offsets are code points, ends exclusive. Edge cases: null and empty texts have no spans; texts of any length are
searched whole; rows that repeat are searched each for itself.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "linked_id", "linked_secret", "linked_endpoint")
BASE = KINDS[:3]

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a run of 16 and more, as a run is always taken whole
LEAST = {"assign": 12, "access": 18}

WEAK_ID = re.compile(r"(?<![A-Za-z0-9])(?:A[A-Z]IA|A3T[A-Z0-9]|AGPA|AIDA|AROA|ANPA|ANVA)[A-Z0-9]{8,}(?![A-Za-z0-9])")
NAMED_ID = re.compile(r"""(?:client|account|access|user)_?(?:key_?)?id["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.-]{6,})""", re.I | re.A)
WEAK_SECRET = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{24,}={0,2}(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(r"""(?:https?|ftps?|ssh|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqps?)://[^\s"'<>]+""", re.I | re.A)
BLANK = re.compile(r"\n[ \t\r]*\n")

#: A text without any of these has no span of any kind.
SIGNS = r"""AKIA[A-Z0-9]|[0-9a-f]{16}|(?i:password|passwd|secret|token|api_?key)["']? *[:=]|(?i:client|account|access|user)_?(?i:key_?)?(?i:id)["']? *[:=]|A[A-Z3GINR][A-Z0-9]{10}"""

REACH = 400

SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
SPAN_TYPE = "array<struct<kind:string,start:bigint,end:bigint>>"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def _mixed(word: str) -> bool:
    """Upper case, lower case and digits: more likely a key than a word or a path."""
    return any(c.isupper() for c in word) and any(c.islower() for c in word) and any(c.isdigit() for c in word)


def _apart(candidates: list[tuple[int, int]], taken: list[tuple[int, int]]) -> np.ndarray:
    """The candidates that overlap none of ``taken``, by start."""
    spans = np.array(sorted(set(candidates)), dtype=np.int64).reshape(-1, 2)
    if not len(spans) or not taken:
        return spans
    other = np.array(sorted(taken), dtype=np.int64)
    furthest = np.maximum.accumulate(other[:, 1])  # of all that start before
    before = np.searchsorted(other[:, 0], spans[:, 1])
    overlap = (before > 0) & (furthest[np.maximum(before - 1, 0)] > spans[:, 0])
    return spans[~overlap]


def _held(scopes: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Interval join: (does the scope hold a span, does a scope hold the span)."""
    if not len(scopes) or not len(spans):
        return np.zeros(len(scopes), bool), np.zeros(len(spans), bool)
    first, last = np.searchsorted(spans[:, 0], scopes[:, 0]), np.searchsorted(np.maximum.accumulate(spans[:, 1]), scopes[:, 1], "right")
    held = np.zeros(len(spans) + 1, np.int64)
    some = last > first
    np.add.at(held, first[some], 1)
    np.add.at(held, last[some], -1)
    return some, np.cumsum(held[:-1]) > 0


def linked_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    taken = [(s, e) for _, s, e in base]
    weak_ids = _apart([m.span() for m in WEAK_ID.finditer(text)] + [m.span(1) for m in NAMED_ID.finditer(text)], taken)
    strong_ids = np.array(sorted((s, e) for k, s, e in base if k == "access"), dtype=np.int64).reshape(-1, 2)
    ids = np.concatenate([strong_ids, weak_ids])
    if not len(ids):
        return []
    order = np.argsort(ids[:, 0], kind="stable")
    ids, is_weak = ids[order], (order >= len(strong_ids))
    urls = [m.span() for m in ENDPOINT.finditer(text)]
    weak_secrets = _apart([m.span() for m in WEAK_SECRET.finditer(text) if _mixed(m[0])], taken + urls + [tuple(x) for x in ids.tolist()])
    endpoints = _apart(urls, taken)
    strong_secrets = np.array(sorted((s, e) for k, s, e in base if k != "access"), dtype=np.int64).reshape(-1, 2)
    edges = [0, *(p for m in BLANK.finditer(text) for p in m.span()), len(text)]
    block = np.searchsorted(edges, ids[:, 0], "right")
    low, high = np.array(edges)[block - 1], np.array([*edges, len(text)])[block]
    scopes = np.stack([np.maximum(ids[:, 0] - REACH, low), np.minimum(ids[:, 1] + REACH, high)], axis=1)
    with_strong, _ = _held(scopes, strong_secrets)
    with_weak, secret_held = _held(scopes, weak_secrets)
    complete = with_strong | with_weak
    _, endpoint_held = _held(scopes[complete], endpoints)
    found = [("linked_id", s, e) for s, e in ids[complete & is_weak].tolist()]
    found += [("linked_secret", s, e) for s, e in weak_secrets[secret_held].tolist()]
    return found + [("linked_endpoint", s, e) for s, e in endpoints[endpoint_held].tolist()]


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """All spans of a text by start, then kind."""
    base = base_spans(text)
    return sorted(base + linked_spans(text, base), key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def _suspects(texts: pa.Array) -> tuple[np.ndarray, list[str]]:
    """Places and texts of the rows that hold any sign."""
    at = np.flatnonzero(pc.fill_null(pc.match_substring_regex(texts, SIGNS), False).to_numpy(zero_copy_only=False))
    return at, texts.take(pa.array(at)).to_pylist()


def secret_spans(text: Column) -> Column:
    """Array of (kind, start, end) of every text, empty where there are none."""

    @F.arrow_udf(SPAN_TYPE)
    def spans(texts: pa.Array) -> pa.Array:
        rows: list[list[dict]] = [[]] * len(texts)
        for i, one in zip(*_suspects(texts), strict=True):
            rows[i] = [{"kind": k, "start": s, "end": e} for k, s, e in find_spans(one)]
        return pa.array(rows, type=SPAN)

    return spans(text)


def masked(text: str, mask: str) -> str:
    """``text`` with every stretch that spans cover replaced by ``mask``."""
    out, at = [], 0
    for _, start, end in find_spans(text):
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(text: Column, mask: str = "[secret]") -> Column:
    """Texts without their secrets; texts that hold none, null ones too, stay as they are."""

    @F.arrow_udf("string")
    def changed(texts: pa.Array) -> pa.Array:
        rows: list[str | None] = [None] * len(texts)
        for i, one in zip(*_suspects(texts), strict=True):
            new = masked(one, mask)
            if new != one:
                rows[i] = new
        return pa.array(rows, type=pa.string())

    return F.coalesce(changed(text), text)
