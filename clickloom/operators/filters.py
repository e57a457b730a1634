"""Predicates, recodes and column housekeeping."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.dates import epoch_seconds

SENTINELS = ("", "_")


def filter_by(df: DataFrame, criteria: Mapping[str, Any], fuzzy: bool = False, bag: str | None = None) -> DataFrame:
    """Keep rows that meet every ``column: value`` pair.

    ``None`` asks only for presence. ``fuzzy`` looks for the value inside a text or an array.
    With ``bag`` the names are keys of that map column, where a present null still counts.
    """
    for name, value in criteria.items():
        field = F.element_at(bag, name) if bag else F.col(name)
        present = F.map_contains_key(bag, name) if bag else field.isNotNull()
        if value is None:
            df = df.where(present)
        elif not fuzzy:
            df = df.where(present & (field == F.lit(value)))
        elif not bag and isinstance(df.schema[name].dataType, T.ArrayType):
            df = df.where(F.array_contains(field, value))
        else:
            df = df.where(present & field.contains(value))
    return df


def valid_events(
    events: DataFrame,
    tenants: DataFrame,
    landing: str = "landing",
    tracking: str = "tracking",
    load_event: str = "load",
) -> DataFrame:
    """Usable page views of a raw tracker log, with effective current and referrer URLs.

    ``load`` is a struct (un, ul) that is null where the raw field was missing or plain text;
    ``timestamp`` is epoch milliseconds and wins over ``datetime`` text.
    """
    is_load = F.col("event_type") == load_event
    has_stamp = F.col("timestamp").isNotNull()
    current = F.when(has_stamp & is_load, F.col("load.un")).otherwise(F.col("current_url"))
    referrer = F.when(has_stamp & is_load, F.col("load.ul")).otherwise(F.col("referrer_url"))
    usable = (
        F.col("behavior_type").isin(landing, tracking)
        & ((F.col("behavior_type") == landing) | F.coalesce(is_load, F.lit(False)))
        & F.col("uuid").isNotNull()
        & (F.col("uuid") != "_")
        & (has_stamp | F.col("datetime").isNotNull())
        & (~has_stamp | ((F.col("timestamp") != 0) & F.col("load").isNotNull()))
    )
    return (
        events.where(usable)
        .withColumns({"current_url": current, "referrer_url": referrer})
        .where(F.col("current_url").isNotNull() & (F.col("current_url") != ""))
        .where(~F.col("current_url").eqNullSafe(F.col("referrer_url")))
        .join(tenants.select("web_id").distinct(), "web_id", "left_semi")
    )


def day_window(df: DataFrame, column: str, start: dt.date, days: int = 1) -> DataFrame:
    """Half-open window of whole days on a wall-clock or epoch-second column."""
    end = start + dt.timedelta(days=days)
    if isinstance(df.schema[column].dataType, (T.IntegerType, T.LongType)):
        low, high = (epoch_seconds(F.lit(d).cast("timestamp_ntz")) for d in (start, end))
    else:
        low, high = (F.lit(d).cast(df.schema[column].dataType) for d in (start, end))
    return df.where((F.col(column) >= low) & (F.col(column) < high))


def drop_sentinels(df: DataFrame, columns: Iterable[str], extra: Iterable[str] = ()) -> DataFrame:
    bad = [*SENTINELS, *extra]
    return df.where(reduce(lambda a, b: a & b, [~F.col(c).isin(*bad) for c in columns]))


def cap_length(df: DataFrame, column: str, limit: int = 64) -> DataFrame:
    return df.where(F.char_length(column) <= limit)


def cap_number(df: DataFrame, column: str, below: int = 32767) -> DataFrame:
    return df.where(F.col(column) < below)


def recode(column: str | Column, table: Mapping[str, str]) -> Column:
    """Replace listed values, keep the others."""
    value = F.col(column) if isinstance(column, str) else column
    return F.coalesce(*[F.when(value == k, F.lit(v)) for k, v in table.items()], value)


SOURCE_NAMES = {"google search": "google", "fb": "facebook"}
TABLE_NAMES = {"youtube": "yt"}


def platform_code(platform: Column, is_fcm: Column) -> Column:
    return F.concat(platform, is_fcm.cast("int").cast("string"))


def member_tag(newmember: Column, new: str, old: str) -> Column:
    return F.when(newmember == "1", F.lit(new)).otherwise(F.lit(old))


def active_on(df: DataFrame, day: dt.date, start: str = "start_time", end: str = "end_time") -> DataFrame:
    return df.where(F.lit(day).between(F.col(start).cast("date"), F.col(end).cast("date")))


def complete_rows(df: DataFrame) -> DataFrame:
    return df.dropna("any")


def fill(df: DataFrame, value: int = 0, columns: Sequence[str] | None = None) -> DataFrame:
    return df.fillna(value, columns)


def shape_columns(
    df: DataFrame,
    add: Mapping[str, Column] | None = None,
    drop: Sequence[str] = (),
    rename: Mapping[str, str] | None = None,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Add, drop, rename and reorder columns in one call."""
    df = df.withColumns(dict(add or {})).drop(*drop).withColumnsRenamed(dict(rename or {}))
    return df.select(*order) if order else df


def or_missing(c: Column) -> Column:
    return F.coalesce(c, F.lit("_"))
