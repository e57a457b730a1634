"""Fill-in-the-middle: a document is cut twice and its parts are put in the order a model learns to fill gaps from.

A text is a sequence of units, runs of ASCII letters or single other characters. One full match of the repeated unit
keeps the end of every repetition, so the number of units and both offsets come from that list without a loop.
Where to cut and which form to write follow from a hash of the document's id and a seed, so any task that is run again
writes the same rows.

Edge cases: null counts as empty; an empty text and a text that holds a mark are written as they are (``plain``);
repeated ids are independent rows of equal cuts where the texts are equal; rows without an id are left out by the query.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = regex.compile(r"([A-Za-z]++|[^A-Za-z])*+")
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = regex.compile(r"<[PSM]>")
PLAIN, PSM, SPM = "plain", "psm", "spm"
PLAIN_FROM, SPM_BELOW = 90, 20  # of 100
CUT_FIELDS = "n long, form string, prefix_chars long, middle_chars long, output string"


def draws(key: Column, seed: int = 1) -> Column:
    """Four integers of 32 bits for a document."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"), 256)
    return F.array(*(F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)))


def unit_ends(text: str) -> list[int]:
    """Where every unit of a text ends."""
    return UNITS.fullmatch(text).ends(1)


def transformed(text: str, drawn: tuple[int, int, int, int], plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> tuple:
    """(units, form, length of the prefix, length of the middle, output) of one text."""
    ends = unit_ends(text)
    n = len(ends)
    first, second, shape, order = drawn
    if not n or shape % 100 >= plain_from or MARKS.search(text):
        return n, PLAIN, None, None, text
    ends.append(0)  # a cut after no unit, found as index -1
    low, high = sorted((first % (n + 1), second % (n + 1)))
    low, high = ends[low - 1], ends[high - 1]
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if order % 100 < spm_below:
        return n, SPM, low, high - low, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, PSM, low, high - low, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def rebuilt(output: str, form: str) -> str:
    """The text that an output was made of. No part holds a mark, and no mark overlaps another, so the first of each counts."""
    if form == PLAIN:
        return output
    head, middle = output.split(MIDDLE, 1)
    if form == PSM:
        prefix, suffix = head.removeprefix(PREFIX).split(SUFFIX, 1)
    else:
        suffix, prefix = head.removeprefix(SUFFIX).split(PREFIX, 1)
    return prefix + middle + suffix


def fill_in_middle(text: Column, key: Column, seed: int = 1, plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> Column:
    """Struct (n, form, prefix_chars, middle_chars, output) of every text."""

    @F.pandas_udf(CUT_FIELDS)
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, drawn in batches:
            rows = [transformed(t, d, plain_from, spm_below) for t, d in zip(texts, drawn, strict=True)]
            out = pd.DataFrame(rows, columns=["n", "form", "prefix_chars", "middle_chars", "output"])
            yield out.astype({"n": "int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    return cut(F.coalesce(text, F.lit("")), draws(key, seed))


def restore(output: Column, form: Column) -> Column:
    """The text again, from what was written alone."""

    @F.pandas_udf("string")
    def restored(outputs: pd.Series, forms: pd.Series) -> pd.Series:
        return pd.Series(list(map(rebuilt, outputs, forms)), dtype=object)

    return restored(output, form)
