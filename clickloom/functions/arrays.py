"""Array, map and JSON reach expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flatten_lists(c: Column) -> Column:
    return F.flatten(c)


def sort_by_freq(words: Column, freqs: Column, descending: bool = True) -> tuple[Column, Column]:
    """Two parallel arrays ordered by frequency (then word), back as two arrays."""
    sign = -1 if descending else 1
    pairs = F.zip_with(words, freqs, lambda w, f: F.struct((f * sign).alias("f"), w.alias("w")))
    ordered = F.array_sort(pairs)
    return F.transform(ordered, lambda p: p["w"]), F.transform(ordered, lambda p: p["f"] * sign)


def join_list(c: Column, separator: str = ",") -> Column:
    return F.array_join(c, separator)


def json_value(c: Column, path: str) -> Column:
    return F.get_json_object(c, path)


def cells_to_columns(df: DataFrame, arrays: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """First cell of each array in place, or one column ``<array>_<name>`` per position."""
    if names is None:
        return df.withColumns({c: F.try_element_at(c, F.lit(1)) for c in arrays})
    cells = {f"{c}_{n}": F.try_element_at(c, F.lit(i)) for c in arrays for i, n in enumerate(names, 1)}
    return df.withColumns(cells).drop(*arrays)


def has_member(c: Column, value: Column) -> Column:
    return F.array_contains(c, value)


def topic_columns(df: DataFrame, topic: str = "topic") -> DataFrame:
    """Topic struct (title, type, ..) to plain columns next to the formatted value."""
    return df.select(F.col(f"{topic}.title").alias("title"), F.col(f"{topic}.type").alias("type"), "formattedValue")


def counters_to_rows(df: DataFrame, keys: Sequence[str], counters: str, name: str = "bucket", value: str = "count") -> DataFrame:
    return df.select(*keys, F.explode(counters).alias(name, value))
