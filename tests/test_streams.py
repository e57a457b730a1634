"""Streams with state: restarts, late rows, and state that ends."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from clickloom.functions.dates import utc_instant
from clickloom.streaming import sinks, state, windows
from tests.test_sessions import SCHEMA, START, collected, expected, make_views


def stateful(query):
    return [int(op["numRowsTotal"]) for p in query.recentProgress for op in p["stateOperators"]]


class Views:
    """A folder that views arrive in, and the table that session_views appends to."""

    def __init__(self, spark, folder, **how):
        self.spark, self.how = spark, how
        self.source, self.spot, self.root = (f"{folder}/{n}" for n in ("in", "checkpoint", "out"))

    def arrive(self, rows):
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.source)
        stream = self.spark.readStream.schema(SCHEMA).parquet(self.source)
        views = state.session_views(stream, utc_instant(F.col("ts")), **self.how)
        writer = views.writeStream.outputMode("append").format("parquet").option("path", self.root)
        query = writer.option("checkpointLocation", self.spot).trigger(availableNow=True).start()
        query.awaitTermination()
        return query

    def found(self):
        return self.spark.read.parquet(self.root)


def ending(rows, days=100):
    return (-1, max(r[1] for r in rows) + dt.timedelta(days=days), "w", "end", "None", 0)


@pytest.fixture(scope="module")
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_session_views_equal_the_batch_result(spark, tmp_path, few_partitions):
    rows = sorted(make_views(8, 25, 9), key=lambda r: (r[1], r[0]))
    views = Views(spark, tmp_path)
    third = len(rows) // 3
    parts = [rows[:third], rows[third : 2 * third], rows[2 * third :]]
    for part in parts:
        random.Random(1).shuffle(part)
        views.arrive(part)  # each arrival starts a new query from the checkpoint
    views.arrive([ending(rows)])
    assert collected(views.found().where("event_id >= 0")) == expected(rows)
    assert views.found().where("event_id >= 0").count() == len(rows)


def test_views_out_of_order_and_late(spark, tmp_path, few_partitions):
    at = lambda minutes: START + dt.timedelta(minutes=minutes)
    views = Views(spark, tmp_path, late="30 minutes")
    views.arrive([(0, at(60), "w", "a", "fb", 0), (1, at(70), "w", "a", "line", 0)])
    views.arrive([(2, at(50), "w", "a", "google", 0), (3, at(75), "w", "a", "None", 0)])  # 20 minutes late: in time
    with windows.LateRows(spark) as reports:
        query = views.arrive([(4, at(10), "w", "a", "bing", 0), (5, at(200), "w", "b", "x", 0)])  # an hour late
        assert reports.total(query) == 1
    views.arrive([(-1, at(200_000), "w", "end", "None", 0)])
    got = collected(views.found().where("event_id >= 0"))
    assert got == {
        2: ("google", 600, 1, 0, 0), 0: ("google", 600, 0, 0, 0), 1: ("google", 300, 0, 0, 0), 3: ("google", 0, 0, 1, 0),
        5: ("x", 0, 1, 1, 1),
    }


def test_closed_visits_leave_the_state(spark, tmp_path, few_partitions):
    views = Views(spark, tmp_path, silence=3600)
    first = [(i, START + dt.timedelta(seconds=i), "w", f"u{i}", "fb", 0) for i in range(40)]
    full = max(stateful(views.arrive(first)))
    query = views.arrive([ending(first, 1)])
    assert stateful(query)[-1] < full / 4
    again = (90, START + dt.timedelta(days=2), "w", "u0", "line", 0)
    views.arrive([again])
    views.arrive([ending([again])])
    assert collected(views.found())[90] == ("line", 0, 1, 1, 1)  # a new visitor after so long a silence


def test_tags_expire(spark, tmp_path, few_partitions):
    schema = "web_id string, uuid string, keyword string, date int, hour int"
    source, spot = f"{tmp_path}/in", f"{tmp_path}/checkpoint"
    seen = []

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        counts = state.merge_state(stream, state.at_hour(F.col("date"), F.col("hour")), days=7, late="1 hour")
        return sinks.run_available(counts, lambda b, _: seen.append({(r.uuid, r.keyword): r.freq for r in b.collect()}), spot)

    arrive([("w", "a", "x", 20240101, 3), ("w", "a", "x", 20240101, 4), ("w", "a", "y", 20240101, 5), *[("w", f"u{i}", "z", 20240101, 1) for i in range(30)]])
    full = max(stateful(arrive([("w", "a", "x", 20240105, 0)])))
    assert seen[-1] == {("a", "x"): 3} or {("a", "x"): 3} in seen
    query = arrive([("w", "b", "x", 20240110, 0)])
    assert stateful(query)[-1] < full / 4
    arrive([("w", "a", "x", 20240110, 1), ("w", "a", "y", 20240110, 1)])
    latest = {k: v for batch in seen for k, v in batch.items()}
    assert latest["a", "x"] == 4 and latest["a", "y"] == 1  # y was gone, x was not


def test_hours_are_forgotten_after_their_day(spark, tmp_path, few_partitions):
    schema = "web_id string, article_id string, date int, hour int, pageviews long"
    source, spot = f"{tmp_path}/in", f"{tmp_path}/checkpoint"
    seen = {}

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        keep = lambda b, _: seen.update({(r.article_id, r.date, r.hour): r.pageviews_hour for r in b.collect()})
        return sinks.run_available(state.hour_deltas(stream, late="2 hours"), keep, spot)

    arrive([("w", "a", 20240101, 0, 5), ("w", "a", 20240101, 2, 9), *[("w", f"b{i}", 20240101, 1, 1) for i in range(30)]])
    full = max(stateful(arrive([("w", "a", 20240101, 1, 6)])))
    assert seen["a", 20240101, 0] == 5 and seen["a", 20240101, 1] == 1 and seen["a", 20240101, 2] == 3
    assert stateful(arrive([("w", "a", 20240102, 5, 2)]))[-1] < full / 4


def test_late_rows_of_many_batches_count(spark, tmp_path, few_partitions):
    """More batches than a query remembers reports of."""
    source, spot = f"{tmp_path}/in", f"{tmp_path}/checkpoint"
    base = spark.createDataFrame([(0, START + dt.timedelta(days=50))], "id long, ts timestamp_ntz").select("id", utc_instant(F.col("ts")).alias("ts"))
    base.coalesce(1).write.parquet(source)
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "4")
    try:
        def run():
            stream = spark.readStream.schema(base.schema).option("maxFilesPerTrigger", 1).parquet(source)
            return sinks.run_available(windows.hourly(stream, ["id"]), lambda b, _: b.count(), spot)

        run()
        for i in range(9):
            base.withColumn("ts", F.col("ts") - F.expr("interval 40 days")).withColumn("id", F.lit(i).cast("long")).coalesce(1).write.mode("append").parquet(source)
        with windows.LateRows(spark) as reports:
            query = run()
            assert reports.total(query) == 9 and len(query.recentProgress) <= 4
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)


def test_visitors_share_a_slot(spark, tmp_path, few_partitions):
    """One call and one list for all visitors of a slot, and the same result as for each alone."""
    rows = sorted(make_views(6, 20, 4), key=lambda r: (r[1], r[0]))
    views = Views(spark, tmp_path, slots=1)
    views.arrive(rows[: len(rows) // 2])
    full = max(stateful(views.arrive(rows[len(rows) // 2 :])))
    assert full <= 8, full  # lists and timers, not visitors
    views.arrive([ending(rows)])
    assert collected(views.found().where("event_id >= 0")) == expected(rows)

    schema = "web_id string, uuid string, keyword string, date int, hour int"
    source, spot, seen = f"{tmp_path}/tags", f"{tmp_path}/spot", {}
    for day in (1, 2):
        given = [("w", f"u{i}", f"k{k % 3}", 20240100 + day, 3) for i in range(20) for k in range(5)]
        spark.createDataFrame(given, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        counts = state.merge_state(stream, state.at_hour(F.col("date"), F.col("hour")), slots=1)
        query = sinks.run_available(counts, lambda b, _: seen.update({(r.uuid, r.keyword): r.freq for r in b.collect()}), spot)
    assert max(stateful(query)) <= 4
    assert seen == {(f"u{i}", f"k{k}"): 2 * (2 if k < 2 else 1) for i in range(20) for k in range(3)}
