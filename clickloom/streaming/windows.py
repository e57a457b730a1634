"""Stateless and natively stateful stream operators: time buckets, sessions, de-duplication."""

from __future__ import annotations

from collections.abc import Sequence
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

LATE = "10 minutes"


def hourly(stream: DataFrame, keys: Sequence[str], ts: str = "ts", late: str = LATE) -> DataFrame:
    """Views per key and hour; an hour closes once the watermark has passed it."""
    return _counts(stream, keys, F.window(ts, "1 hour"), ts, late)


def buckets(stream: DataFrame, keys: Sequence[str], ts: str = "ts", hours: int = 2, late: str = LATE) -> DataFrame:
    """Half-open buckets of some hours: a row on an edge belongs to the later bucket only."""
    return _counts(stream, keys, F.window(ts, f"{hours} hours"), ts, late)


def rolling(
    stream: DataFrame, keys: Sequence[str], ts: str = "ts", days: int = 7, late: str = LATE
) -> DataFrame:
    """Windows of several days that start every day."""
    return _counts(stream, keys, F.window(ts, f"{days} days", "1 day"), ts, late)


def sessions(stream: DataFrame, keys: Sequence[str], ts: str = "ts", gap: str = "30 minutes", late: str = LATE) -> DataFrame:
    """Visits separated by ``gap`` of silence."""
    return _counts(stream, keys, F.session_window(ts, gap), ts, late)


def _counts(stream: DataFrame, keys: Sequence[str], span: F.Column, ts: str, late: str) -> DataFrame:
    named = span.alias("span")
    counted = stream.withWatermark(ts, late).groupBy(*keys, named).agg(F.count("*").alias("views"))
    return counted.select(*keys, F.col("span.start").alias("start"), F.col("span.end").alias("end"), "views")


def dedupe(stream: DataFrame, keys: Sequence[str], ts: str = "ts", late: str = "1 day") -> DataFrame:
    """First row per key inside the watermark."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))


class LateRows(StreamingQueryListener):
    """Rows dropped for lateness by every query of a session, from each of its progress reports.

    A query itself keeps its last reports only. Reports come some time after their batch: :meth:`total` waits for those
    of a query that has ended.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.dropped: dict[str, int] = {}
        self.ended: dict[str, Event] = {}

    def __enter__(self) -> LateRows:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_: object) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        self.ended.setdefault(str(event.runId), Event())

    def onQueryProgress(self, event) -> None:
        rows = sum(int(op.numRowsDroppedByWatermark) for op in event.progress.stateOperators)
        run = str(event.progress.runId)
        self.dropped[run] = self.dropped.get(run, 0) + rows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.setdefault(str(event.runId), Event()).set()

    def total(self, query: StreamingQuery, seconds: float = 60) -> int:
        """Rows that this run of a query has dropped; the run has ended."""
        run = str(query.runId)
        if not self.ended.setdefault(run, Event()).wait(seconds):
            raise TimeoutError(f"no report of the end of run {run}")
        return self.dropped.get(run, 0)
