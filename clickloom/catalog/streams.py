"""Z*: stream operators over the events file as a stream; the result equals the batch result."""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.catalog.registry import query, with_
from clickloom.catalog.tables import BROWSE, FACTS_BASE, SESSIONS, TAGS, browse, facts, table, tags
from clickloom.functions.dates import epoch_seconds, utc_clock, utc_instant
from clickloom.session import scratch_path
from clickloom.sinks import merge
from clickloom.streaming import sinks, state, windows


def as_stream(df, files_per_batch=None):
    """The rows of ``df`` as a file stream, in one batch or in several."""
    path = scratch_path(df.sparkSession, "stream-input")
    df.write.parquet(path)
    reader = df.sparkSession.readStream.schema(df.schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)


def in_three_parts(df, order, batch, checkpoint):
    """Let the rows arrive in three parts along ``order``, running the stream after each arrival."""
    spark = df.sparkSession
    path = scratch_path(spark, "stream-input")
    low, high = df.agg(F.percentile_approx(order, [1 / 3, 2 / 3])).first()[0]
    for part in (order <= low, (order > low) & (order <= high), order > high):
        df.where(part).write.mode("append").parquet(path)
        sinks.run_available(spark.readStream.schema(df.schema).parquet(path), batch, checkpoint, "append")


def event_stream(spark, sf):
    events = table(spark, sf, "events").select("event_id", utc_instant(F.col("ts")).alias("ts"), "user_id", "event_type")
    return as_stream(events)


def shown(df):
    return df.withColumns({c: F.date_format(utc_clock(F.col(c)), "yyyy-MM-dd HH:mm") for c in ("start", "end")})


@query(
    "Z1_hourly_stream",
    """SELECT event_type, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS start,
  strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M') AS "end", count(*) AS views FROM events GROUP BY 1, 2, 3""",
)
def hourly_stream(spark, sf):
    return shown(sinks.run_to_table(windows.hourly(event_stream(spark, sf), ["event_type"]), ["event_type", "start"]))


@query(
    "Z2_two_hour_buckets",
    """SELECT user_id, strftime(time_bucket(INTERVAL 2 HOUR, ts, TIMESTAMP '2024-01-01'), '%Y-%m-%d %H:%M') AS start,
  strftime(time_bucket(INTERVAL 2 HOUR, ts, TIMESTAMP '2024-01-01') + INTERVAL 2 HOUR, '%Y-%m-%d %H:%M') AS "end", count(*) AS views
FROM events GROUP BY 1, 2, 3""",
)
def two_hour_buckets(spark, sf):
    return shown(sinks.run_to_table(windows.buckets(event_stream(spark, sf), ["user_id"]), ["user_id", "start"]))


@query(
    "Z3_session_stream",
    with_(BROWSE, SESSIONS, select="SELECT web_id, uuid, event_id, source_domain, time_on_page, landings, exits, bounce FROM sess"),
)
def session_stream(spark, sf):
    """Exact session metrics over three arrivals in time order; one far later view ends the last visits."""
    root, spot, path = (scratch_path(spark, f"session-{name}") for name in ("stream", "checkpoint", "input"))
    views = browse(spark, sf)
    seconds = epoch_seconds(F.col("ts"))
    low, high = views.agg(F.percentile_approx(seconds, [1 / 3, 2 / 3])).first()[0]
    parts = [views.where(p) for p in (seconds <= low, (seconds > low) & (seconds <= high), seconds > high)]
    end = views.agg((F.max("ts") + F.expr("interval 400 days")).alias("end"))
    flush = views.limit(1).withColumn("uuid", F.lit("end")).join(end).withColumn("ts", F.col("end")).drop("end")
    for part in (*parts, flush):
        part.write.mode("append").parquet(path)
        stream = state.session_views(spark.readStream.schema(views.schema).parquet(path), utc_instant(F.col("ts")))
        sinks.append_to_files(stream, root, spot)
    return spark.read.parquet(root)


@query(
    "Z3_session_windows",
    """SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M') AS start, count(*) AS views FROM (
  SELECT *, sum(is_new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid FROM (
    SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) < 1800000000 THEN 0 ELSE 1 END AS is_new
    FROM events)) GROUP BY user_id, sid""",
)
def session_windows(spark, sf):
    """Appended once the watermark closes a session; one far later row closes the last ones."""
    events = table(spark, sf, "events").select("event_id", utc_instant(F.col("ts")).alias("ts"), "user_id")
    flush = events.agg(
        F.max("event_id").alias("event_id"), (F.max("ts") + F.expr("interval 400 days")).alias("ts"),
        F.lit(-1).cast("long").alias("user_id"),
    )
    root, spot = scratch_path(spark, "session-windows"), scratch_path(spark, "session-windows-checkpoint")
    path = scratch_path(spark, "stream-input")
    events.write.parquet(path)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 8).parquet(path)
    sinks.append_to_files(windows.sessions(stream, ["user_id"]), root, spot)
    flush.select(*events.columns).write.mode("append").parquet(path)
    sinks.append_to_files(windows.sessions(stream, ["user_id"]), root, spot)
    done = spark.read.parquet(root)
    return done.select("user_id", F.date_format(utc_clock(F.col("start")), "yyyy-MM-dd HH:mm").alias("start"), "views")


@query(
    "Z4_rolling_windows",
    """WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day FROM events), spans(days) AS (VALUES (1), (7), (30)),
b AS (SELECT days, unnest(range(days)) AS back FROM spans)
SELECT days, event_type, strftime(day - CAST(back AS INTEGER), '%Y-%m-%d %H:%M') AS start,
  strftime(day - CAST(back AS INTEGER) + CAST(days AS INTEGER), '%Y-%m-%d %H:%M') AS "end", count(*) AS views
FROM d, b GROUP BY 1, 2, 3, 4""",
)
def rolling_windows(spark, sf):
    """Days, weeks and months that begin every day."""
    stream = event_stream(spark, sf)
    spans = (sinks.run_to_table(windows.rolling(stream, ["event_type"], days=d), ["event_type", "start"]).withColumn("days", F.lit(d)) for d in (1, 7, 30))
    return shown(functools.reduce(DataFrame.unionByName, spans))


@query(
    "Z5_upsert_sink",
    """SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1""",
)
def upsert_sink(spark, sf):
    """Latest event per user over three micro-batches."""
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type")
    root = scratch_path(spark, "upserted")
    batch = sinks.upsert_sink(root, ["user_id"], newest=[F.desc("event_id")])
    in_three_parts(events, F.col("event_id"), batch, scratch_path(spark, "upsert-checkpoint"))
    return merge.read_merged(spark, root)


@query(
    "Z6_merge_state",
    with_(TAGS, select="SELECT web_id, uuid, usertag AS keyword, count(*) AS freq FROM tags GROUP BY 1, 2, 3"),
)
def merge_state(spark, sf):
    rows = tags(spark, sf).select("web_id", "uuid", F.col("usertag").alias("keyword"), "date", "hour")
    given = state.at_hour(F.col("date"), F.col("hour"))
    # the parts are no days: rows may be as late as the table is long
    counts = state.merge_state(as_stream(rows.repartition(3), 1), given, late="60 days")
    return sinks.run_to_table(counts, ["web_id", "uuid", "keyword"])


@query(
    "Z7_expire",
    with_(TAGS, select="SELECT event_id, usertag FROM tags WHERE date >= 20240112"),
)
def expire(spark, sf):
    rows = tags(spark, sf).withColumn("expired_date", F.to_date(F.col("date").cast("string"), "yyyyMMdd") + 4)
    return merge.drop_expired(rows, dt.date(2024, 1, 16)).select("event_id", "usertag")


@query("Z8_dedupe_stream", "SELECT DISTINCT user_id, event_type FROM events")
def dedupe_stream(spark, sf):
    unique = windows.dedupe(event_stream(spark, sf), ["user_id", "event_type"], late="60 days")
    root = scratch_path(spark, "deduped")
    sinks.append_to_files(unique, root, scratch_path(spark, "dedupe-checkpoint"))
    return spark.read.parquet(root).select("user_id", "event_type")


@query(
    "Z9_hour_delta_stream",
    with_(
        *FACTS_BASE,
        """cum AS (SELECT *, CAST(sum(n) OVER (PARTITION BY web_id, article_id, date ORDER BY hour) AS BIGINT) AS pageviews
  FROM (SELECT web_id, article_id, date, hour, sum(pageviews) AS n FROM facts GROUP BY ALL)),
joined AS (SELECT c.web_id, c.article_id, c.date, c.hour, c.pageviews, p.pageviews AS before FROM cum c
  LEFT JOIN cum p ON p.web_id = c.web_id AND p.article_id = c.article_id AND p.date = c.date AND p.hour = c.hour - 1)""",
        select="""SELECT web_id, article_id, date, hour, pageviews, CASE WHEN hour = 0 THEN pageviews
  WHEN COALESCE(before, 0) = 0 AND COALESCE(pageviews - before, 0) = 0 THEN pageviews
  ELSE COALESCE(pageviews - before, 0) END AS pageviews_hour FROM joined""",
    ),
)
def hour_delta_stream(spark, sf):
    from clickloom.operators.trends import cumulative_by_hour

    snapshots = cumulative_by_hour(facts(spark, sf), ["web_id", "article_id", "date"])
    stream = as_stream(snapshots.repartition(2, "hour"), 1)
    return sinks.run_to_table(state.hour_deltas(stream, late="60 days"), ["web_id", "article_id", "date", "hour"])


@query("Z10_late_rows", "SELECT CAST(count(*) AS BIGINT) AS late FROM events WHERE event_type = 'error'")
def late_rows(spark, sf):
    """Error events arrive again, two months late, after everything else has moved the watermark."""
    events = table(spark, sf, "events").select("event_id", utc_instant(F.col("ts")).alias("ts"), "user_id", "event_type")
    path, spot = scratch_path(spark, "stream-input"), scratch_path(spark, "late-checkpoint")
    root = scratch_path(spark, "late-table")
    events.write.parquet(path)
    stream = spark.readStream.schema(events.schema).parquet(path)
    counted = windows.hourly(stream, ["event_type", "event_id"])
    batch = sinks.upsert_sink(root, ["event_type", "event_id", "start"])
    sinks.run_available(counted, batch, spot)
    old = events.where(F.col("event_type") == "error").withColumn("ts", F.col("ts") - F.expr("interval 60 days"))
    old.write.mode("append").parquet(path)
    with windows.LateRows(spark) as reports:
        late = reports.total(sinks.run_available(counted, batch, spot))
    return events.groupBy().agg(F.lit(late).cast("long").alias("late"))
