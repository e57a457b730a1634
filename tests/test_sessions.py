"""Session metrics, retention and moving averages against short restatements of the rules."""

import datetime as dt
import random

from pyspark.sql import functions as F

from clickloom.operators import ranking, sessions, usertags
from clickloom.sinks.merge import write_table

START = dt.datetime(2024, 1, 1)
SCHEMA = "event_id long, ts timestamp_ntz, web_id string, uuid string, source_domain string, time_on_page long"


def make_views(seed, users, views):
    rng = random.Random(seed)
    rows, event = [], 0
    for user in range(users):
        clock = START + dt.timedelta(minutes=rng.randint(0, 500))
        for _ in range(rng.randint(1, views)):
            clock += dt.timedelta(seconds=rng.choice([0, 1, 30, 1799, 1800, 1801, 5000]))
            rows.append((event, clock, "w", f"u{user}", rng.choice(["None", "fb", "line"]), rng.choice([0, 0, 7])))
            event += 1
    return rows


def expected(rows):
    out = {}
    users = {}
    for row in sorted(rows, key=lambda r: (r[1], r[0])):
        users.setdefault(row[3], []).append(row)
    for seq in users.values():
        first = seq[0][4]
        for i, (event, ts, _, _, source, spent) in enumerate(seq):
            last = i == len(seq) - 1
            gap = None if last else int((seq[i + 1][1] - ts).total_seconds())
            bounce = int((gap or 0) > 1800 or (i == 0 and last))
            if gap is not None:
                spent = 0 if gap > 1800 else (spent or gap)
            out[event] = (source if first == "None" else first, spent, int(i == 0), int(last), bounce)
    return out


def collected(df):
    rows = df.select("event_id", "source_domain", "time_on_page", "landings", "exits", "bounce").collect()
    return {r[0]: tuple(r[1:]) for r in rows}


def test_session_metrics_match_rule_for_any_slicing(spark):
    rows = make_views(3, 40, 12)
    views = spark.createDataFrame(rows, SCHEMA)
    want = expected(rows)
    assert collected(sessions.session_metrics(views)) == want
    assert collected(sessions.session_metrics(views, slice_by=F.date_trunc("MINUTE", "ts"))) == want
    assert collected(sessions.session_metrics(views, slice_by=F.lit(0))) == want


def test_gap_edges(spark):
    rows = [
        (0, START, "w", "edge", "fb", 0),
        (1, START + dt.timedelta(seconds=1800), "w", "edge", "line", 5),
        (2, START + dt.timedelta(seconds=3601), "w", "edge", "line", 0),
    ]
    got = collected(sessions.session_metrics(spark.createDataFrame(rows, SCHEMA)))
    assert got[0] == ("fb", 1800, 1, 0, 0)  # exactly 1800 s is no bounce
    assert got[1] == ("fb", 0, 0, 0, 1)  # 1801 s overrides the supplied time and is no new landing
    assert got[2] == ("fb", 0, 0, 1, 0)


def test_retention_keeps_crossing_bucket(spark):
    stats = [
        ("w", "at", 20240102, 2, 3), ("w", "at", 20240101, 0, 7),  # total = limit: all stay
        ("w", "over", 20240103, 0, 4), ("w", "over", 20240102, 8, 5), ("w", "over", 20240102, 6, 2),
        ("w", "over", 20240102, 4, 9),  # 4 + 5 < 10, the 2 crosses, the 9 goes
    ]
    df = spark.createDataFrame(stats, "web_id string, uuid string, date int, hour int, num_usertag long")
    kept = {(r.uuid, r.date, r.hour) for r in usertags.retained_buckets(df, 10).collect()}
    assert kept == {(s[1], s[2], s[3]) for s in stats[:5]}


def test_moving_average_over_blocks(spark):
    values = [float(x) for x in random.Random(1).sample(range(1000), 100)]
    df = spark.createDataFrame([("k", i, v) for i, v in enumerate(values)], "k string, i long, v double")
    slices = F.floor(F.col("i") / 7)
    got = ranking.moving_average(df, ["k"], [F.col("i")], "v", 5, slices, block=8).orderBy("i").collect()
    want = [sum(values[max(0, i - 4) : i + 1]) / len(values[max(0, i - 4) : i + 1]) for i in range(100)]
    assert [round(r.average, 9) for r in got] == [round(w, 9) for w in want]
    blocks = ranking.moving_average(df, ["k"], [F.col("i")], "v", 7, slices, mode="fixing").orderBy("block").collect()
    assert len(blocks) == 14
    assert round(blocks[3].average, 9) == round(sum(values[21:28]) / 7, 9)


def test_two_stage_top_k_equals_plain_sort(spark):
    rng = random.Random(4)
    rows = [("hot" if rng.random() < 0.7 else "cold", rng.randint(0, 50), i) for i in range(6000)]
    df = spark.createDataFrame(rows, "k string, v int, i long")
    got = ranking.top_k(df, ["k"], [F.desc("v"), F.asc("i")], 1500, rank="rk").collect()
    for key in ("hot", "cold"):
        want = sorted((r for r in rows if r[0] == key), key=lambda r: (-r[1], r[2]))[:1500]
        assert [r.i for r in sorted((g for g in got if g.k == key), key=lambda g: g.rk)] == [w[2] for w in want]


def test_write_table_overwrites(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    write_table(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3
