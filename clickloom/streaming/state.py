"""Keyed state with an end: exact session metrics, running tag lists and hour deltas over streams.

Each is a ``transformWithState`` processor on Spark's own state store, so checkpoints, restarts and replayed batches are
Spark's. Event-time timers end the state: what the watermark has left behind for long enough is emitted where it is
still owed and then removed, so state follows the active keys and not the history. Rows behind the watermark are dropped
and counted by Spark (``windows.LateRows``).

A call to a processor and each of its reads and writes of state cost far more than a row. Visitors and users are therefore
kept many to a slot, by hash: a batch calls a touched slot once, reads its rows as one (arrays) and writes them as one. A
slot's rows are one task's work, so ``slots`` should grow with the active keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from clickloom.functions.dates import epoch_seconds
from clickloom.operators.sessions import GAP_SECONDS

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_MS = 86_400_000
SLOTS = 1 << 9


def with_state_store(spark: SparkSession) -> None:
    """Processors need the RocksDB store; another one that the session names is left as it is."""
    if spark.conf.get(STORE).endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(STORE, ROCKSDB)


class _Timed(StatefulProcessor):
    """A timer that fires when nothing is due changes nothing, so old timers are left to run out."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def wake_at(self, ms: int | None) -> None:
        if ms is not None:
            self.handle.registerTimer(ms)

    def close(self) -> None:
        pass


def _slot(keys: list[str], slots: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(slots))


def _columns(fields: str) -> str:
    """The schema of many rows as one, with an array per field."""
    return ", ".join("{} array<{}>".format(*f.split()) for f in fields.split(", "))


def _listed(state) -> list[tuple]:
    return list(zip(*state.get())) if state.exists() else []


def _store(state, rows: list[tuple]) -> None:
    if rows:
        state.update(tuple(map(list, zip(*rows))))
    else:
        state.clear()


VIEW = "us long, event_id long, sec long, source string, spent long, web_id string, uuid string"
SESSION = "event_id long, source_domain string, time_on_page long, landings long, exits long, bounce long"


class SessionViews(_Timed):
    """Views wait until the watermark has passed them, then get their place in the visitor's time order.

    The last placed view stays open until its successor comes or the visitor has been silent for ``silence`` seconds
    of event time; then it is an exit and the visitor's state goes.
    """

    def __init__(self, gap: int, silence: int) -> None:
        self.gap, self.silence = gap, silence

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.waiting = handle.getValueState("waiting", _columns(VIEW))
        self.open = handle.getValueState("open", _columns(f"{VIEW}, landing long, first_source string"))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        fresh = []
        for views in rows:
            spent = [None if pd.isna(v) else int(v) for v in views["own_time"]]
            texts = ([None if pd.isna(v) else v for v in views[c]] for c in ("own_source", "web_id", "uuid"))
            source, *who = texts
            fresh.extend(zip(*(views[c].tolist() for c in ("at_us", "event_id", "at_sec")), source, spent, *who))
        yield self._placed(fresh, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._placed([], timerValues.getCurrentWatermarkInMs())

    def _placed(self, fresh: list[tuple], watermark: int) -> pd.DataFrame:
        ready, later = [], []
        for view in (*_listed(self.waiting), *fresh):
            (ready if view[0] <= watermark * 1000 else later).append(view)
        ready.sort(key=lambda v: v[:2])
        last = {view[5:7]: view for view in _listed(self.open)}
        out = []
        for view in ready:
            who = view[5:7]
            prior = last.get(who)
            if prior is not None:
                out.append(self._row(prior, view[2]))
            last[who] = (*view, int(prior is None), view[3] if prior is None else prior[8])
        if fresh or ready:
            _store(self.waiting, later)
        expected = {view[5:7] for view in later}
        due = {who: -(-view[0] // 1000) + self.silence * 1000 for who, view in last.items()}
        over = [who for who, ms in due.items() if ms <= watermark and who not in expected]
        for who in over:
            out.append(self._row(last.pop(who), None))
            del due[who]
        if ready or over:
            _store(self.open, list(last.values()))
        wakes = [ms for ms in due.values() if ms > watermark]
        if later:
            wakes.append(-(-max(v[0] for v in later) // 1000))
        self.wake_at(max(min(wakes), watermark + 1) if wakes else None)
        names = [f.split()[0] for f in SESSION.split(", ")]
        return pd.DataFrame(out, columns=["web_id", "uuid", *names]).astype({"time_on_page": "Int64"})

    def _row(self, view: tuple, next_sec: int | None) -> tuple:
        _, event, sec, source, spent, web_id, uuid, landing, first = view
        step = None if next_sec is None else next_sec - sec
        long_gap = step is not None and step > self.gap
        kept = 0 if long_gap else spent if step is None or spent is None or spent != 0 else step
        source = source if first == "None" else first
        return web_id, uuid, event, source, kept, landing, int(step is None), int(long_gap or (step is None and landing == 1))


def session_views(
    stream: DataFrame,
    instant: Column,
    ts: str = "ts",
    late: str = "10 minutes",
    silence: int = 30 * 86_400,
    gap: int = GAP_SECONDS,
    source: str = "source_domain",
    time_on_page: str = "time_on_page",
    slots: int = SLOTS,
) -> DataFrame:
    """Session metrics per view (web_id, uuid, event_id, ..) of a stream, each view once and for good.

    Landings, exits, bounces, time on page and sticky source are those of ``session_metrics``. ``instant`` is the
    view's time as a timestamp; views may be out of order by up to ``late``. A visitor who comes back after ``silence``
    seconds is a new one.
    """
    with_state_store(stream.sparkSession)
    keys = ["web_id", "uuid"]
    rows = stream.select(
        *keys, "event_id", instant.alias("at_time"), F.unix_micros(instant).alias("at_us"), epoch_seconds(F.col(ts)).cast("long").alias("at_sec"),
        F.col(source).alias("own_source"), F.col(time_on_page).cast("long").alias("own_time"), _slot(keys, slots).alias("slot"),
    ).withWatermark("at_time", late)
    return rows.groupBy("slot").transformWithStateInPandas(
        SessionViews(gap, silence), f"web_id string, uuid string, {SESSION}", "Append", "EventTime"
    )


def at_hour(date: Column, hour: Column) -> Column:
    """The instant of an hour of a day that is a number such as 20240131, in UTC."""
    return F.timestamp_seconds(F.unix_date(F.to_date(date.cast("string"), "yyyyMMdd")) * 86_400 + hour * 3600)


TAG = "web_id string, uuid string, keyword string, freq long"


class TagCounts(_Timed):
    """Count and last day of each of a user's tags; a tag that has not been seen for ``days`` goes."""

    def __init__(self, days: int) -> None:
        self.days = days

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.tags = handle.getValueState("tags", _columns(f"{TAG}, last long"))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        tags = self._kept(timerValues.getCurrentWatermarkInMs())
        found = set()
        for given in rows:
            names = ([None if pd.isna(v) else v for v in given[c]] for c in ("web_id", "uuid", "keyword"))
            for *tag, ms in zip(*names, given["at_ms"].tolist()):
                freq, last = tags.get(tag := tuple(tag), (0, 0))
                tags[tag] = freq + 1, max(last, ms)
                found.add(tag)
        self._store(tags)
        yield self._frame([(*tag, tags[tag][0]) for tag in found])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._store(self._kept(timerValues.getCurrentWatermarkInMs()))
        yield self._frame([])

    def _kept(self, watermark: int) -> dict[tuple, tuple[int, int]]:
        return {row[:3]: row[3:] for row in _listed(self.tags) if row[4] + self.days * DAY_MS > watermark}

    def _store(self, tags: dict[tuple, tuple[int, int]]) -> None:
        _store(self.tags, [(*tag, *seen) for tag, seen in tags.items()])
        self.wake_at(min((last + self.days * DAY_MS for _, last in tags.values()), default=None))

    def _frame(self, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["web_id", "uuid", "keyword", "freq"]).astype({"freq": "int64"})


def merge_state(stream: DataFrame, instant: Column, days: int = 91, late: str = "1 day", slots: int = SLOTS) -> DataFrame:
    """Running count per (web_id, uuid, keyword): a user's stored list, merged with each batch.

    ``instant`` is when a tag was given; tags not given again for ``days`` leave the list and start anew.
    """
    with_state_store(stream.sparkSession)
    rows = stream.withColumn("at_time", instant).withColumn("at_ms", F.unix_millis("at_time")).withWatermark("at_time", late)
    slot = _slot(["web_id", "uuid"], slots).alias("slot")
    return rows.select("web_id", "uuid", "keyword", "at_time", "at_ms", slot).groupBy("slot").transformWithStateInPandas(
        TagCounts(days), TAG, "Update", "EventTime"
    )


DELTA = ("web_id", "article_id", "date", "hour", "pageviews", "pageviews_hour")


class HourDeltas(_Timed):
    """The largest snapshot of every hour of one article and day, until the day is over."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.hours = handle.getMapState("hours", "hour int", "pageviews long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        fresh: dict[int, int] = {}
        end = 0
        for snapshots in rows:
            end = max(end, int(snapshots["day_end"].max()))
            for hour, value in zip(snapshots["hour"], snapshots["pageviews"]):
                fresh[int(hour)] = max(int(value), fresh.get(int(hour), 0))
        seen = {k[0]: v[0] for k, v in self.hours.iterator()} if self.hours.exists() else {}
        for hour, value in fresh.items():
            seen[hour] = max(value, seen.get(hour, 0))
            self.hours.updateValue((hour,), (seen[hour],))
        self.wake_at(max(end, timerValues.getCurrentWatermarkInMs() + 1))
        out = []
        for hour in sorted(h for h in seen if h in fresh or h - 1 in fresh):
            value, before = seen[hour], seen.get(hour - 1)
            known = 0 if before is None else value - before
            lift = (before or 0) == 0 and known == 0 and value != 0
            out.append((*key, hour, value, value if hour == 0 or lift else known))
        yield pd.DataFrame(out, columns=list(DELTA))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.hours.clear()
        yield pd.DataFrame(columns=list(DELTA)).astype(dict.fromkeys(DELTA[2:], "int64"))


def hour_deltas(stream: DataFrame, late: str = "1 day") -> DataFrame:
    """Hour deltas of cumulative snapshots that arrive in any number of batches.

    Input (web_id, article_id, date, hour, pageviews); a later snapshot of the next hour is emitted
    again when its predecessor changes, for an upsert sink on (web_id, article_id, date, hour). A day's snapshots
    are forgotten once the watermark, ``late`` behind the newest hour, has passed its end.
    """
    with_state_store(stream.sparkSession)
    day_end = (F.unix_date(F.to_date(F.col("date").cast("string"), "yyyyMMdd")).cast("long") + 1) * DAY_MS
    rows = stream.withColumns({"at_time": at_hour(F.col("date"), F.col("hour")), "day_end": day_end}).withWatermark("at_time", late)
    kinds = "web_id string, article_id string, date int, hour int, pageviews long, pageviews_hour long"
    return rows.groupBy("web_id", "article_id", "date").transformWithStateInPandas(HourDeltas(), kinds, "Update", "EventTime")
