"""Per-visitor view sequences and the page-view fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.dates import date_int, epoch_seconds

VISITOR = ("web_id", "uuid")
GAP_SECONDS = 1800


def session_metrics(
    views: DataFrame,
    keys: Sequence[str] = VISITOR,
    ts: str = "ts",
    tie: str = "event_id",
    source: str = "source_domain",
    time_on_page: str = "time_on_page",
    gap: int = GAP_SECONDS,
    slice_by: Column | None = None,
) -> DataFrame:
    """Landings, exits, bounces, time on page and sticky first source for every view.

    First view: landing. Only view: exit and bounce. Last view: exit. A missing (0) time on page is
    the gap to the next view; a gap over ``gap`` seconds makes the view a bounce with time 0, even
    over a supplied time, and does not start a new landing. Later views take the first view's
    source unless that is ``'None'``.

    Every visitor is cut into time slices (hours, or ``slice_by``, which must rise with time), so that
    a bot is many tasks; neighbouring slices meet through one summary row each.
    """
    keys = list(keys)
    timed = views.withColumn("_sec", epoch_seconds(F.col(ts)))
    placed = _in_slices(timed, keys, ts, tie, source, F.date_trunc("HOUR", F.col(ts)) if slice_by is None else slice_by)

    step = F.col("_next_sec") - F.col("_sec")
    first, last = F.col("_first"), step.isNull()
    long_gap = F.coalesce(step > gap, F.lit(False))
    own_time = F.col(time_on_page).cast("long")
    result = placed.withColumns(
        {
            "landings": first.cast("long"),
            "exits": last.cast("long"),
            "bounce": (long_gap | (first & last)).cast("long"),
            time_on_page: F.when(long_gap, F.lit(0).cast("long"))
            .when(last | (own_time != 0), own_time)
            .otherwise(step),
            source: F.when(F.col("_first_source") == "None", F.col(source)).otherwise(F.col("_first_source")),
        }
    )
    return result.drop("_sec", "_next_sec", "_first", "_first_source")


def _in_slices(timed: DataFrame, keys: list[str], ts: str, tie: str, source: str, slice_by: Column) -> DataFrame:
    """Next second, first flag and first source of each view, from windows inside (visitor, slice)."""
    part = [*keys, "_slice"]
    sliced = timed.withColumn("_slice", slice_by)
    heads = sliced.groupBy(*part).agg(
        F.min("_sec").alias("_head"), F.min_by(source, F.struct(ts, tie)).alias("_source")
    )
    line = Window.partitionBy(*keys).orderBy("_slice")
    edges = heads.select(
        *part,
        F.lead("_head").over(line).alias("_next_head"),
        F.lag("_head").over(line).isNull().alias("_first_slice"),
        F.first("_source").over(line.rowsBetween(Window.unboundedPreceding, 0)).alias("_first_source"),
    )
    inside = Window.partitionBy(*part).orderBy(ts, tie)
    numbered = sliced.withColumns({"_lead": F.lead("_sec").over(inside), "_number": F.row_number().over(inside)})
    joined = numbered.join(edges, part).withColumns(
        {
            "_next_sec": F.coalesce("_lead", "_next_head"),
            "_first": F.col("_first_slice") & (F.col("_number") == 1),
        }
    )
    return joined.drop("_slice", "_lead", "_number", "_next_head", "_first_slice")


def pageview_facts(
    views: DataFrame, time: Column, keys: Sequence[str] = ("web_id", "article_id", "source_domain")
) -> DataFrame:
    """Hourly sums per (tenant, article, source); views without a known source are left out."""
    stamped = views.where(F.col("source_domain") != "None").withColumns(
        {"hour": F.hour(time), "date": date_int(time)}
    )
    return stamped.groupBy(*keys, "date", "hour").agg(
        F.count("*").alias("pageviews"),
        *[F.sum(m).alias(m) for m in ("landings", "exits", "bounce", "time_on_page")],
    )


def true_sessions(
    views: DataFrame, keys: Sequence[str] = VISITOR, ts: str = "ts", gap: int = GAP_SECONDS
) -> DataFrame:
    """Sessions separated by at least ``gap`` seconds of silence, one row each.

    Sessions are numbered inside hours of a visitor; each hour's summary row tells whether its first view goes
    on with the session before and how many sessions came earlier. Hours of one session then meet in an
    ordinary aggregate, so no task holds all views of a visitor.
    """
    keys = list(keys)
    part = [*keys, "_slice"]
    sliced = views.select(*keys, F.col(ts).alias("_ts"), F.date_trunc("HOUR", F.col(ts)).alias("_slice"))
    inside = Window.partitionBy(*part).orderBy("_ts")
    pause = F.unix_micros(F.col("_ts").cast("timestamp")) - F.unix_micros(F.lag("_ts").over(inside).cast("timestamp"))
    starts = F.when(pause >= gap * 1_000_000, 1).otherwise(0)
    numbered = sliced.withColumn("_start", starts).withColumn("_number", F.sum("_start").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    pieces = numbered.groupBy(*part, "_number").agg(F.count("*").alias("views"), F.min("_ts").alias("first_view"), F.max("_ts").alias("last_view"))
    # at most one piece an hour and session from here on
    line = Window.partitionBy(*keys).orderBy("first_view", "_number")
    silence = F.unix_micros(F.col("first_view").cast("timestamp")) - F.unix_micros(F.lag("last_view").over(line).cast("timestamp"))
    opened = pieces.withColumn("_new", F.when(silence < gap * 1_000_000, 0).otherwise(1))
    sessions = opened.withColumn("_session", F.sum("_new").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    return (
        sessions.groupBy(*keys, "_session")
        .agg(F.sum("views").alias("views"), F.min("first_view").alias("first_view"), F.max("last_view").alias("last_view"))
        .drop("_session")
    )
