"""User tag jobs: subscribers, shops, members, time buckets, users without tokens."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.dates import hour_bucket
from clickloom.operators import usertags
from clickloom.operators.filters import cap_length, day_window, drop_sentinels, member_tag, platform_code
from clickloom.operators.joins import salted_join
from clickloom.operators.ranking import keep_first


def subscriber_tags(
    log: DataFrame, articles: DataFrame, tokens: DataFrame, day: dt.date, keep_days: int = 4, ts: str = "ts"
) -> DataFrame:
    """Tags of one day's readers. ``tokens`` is (uuid, token, os_platform, is_fcm)."""
    coded = tokens.select("uuid", "token", platform_code(F.col("os_platform"), F.col("is_fcm")).alias("code"))
    expires = F.lit(day + dt.timedelta(days=keep_days))
    return usertags.user_tags(day_window(log, ts, day), articles, coded, expires)


def shop_tags(
    log: DataFrame, items: DataFrame, tokens: DataFrame, today: dt.date, keep_days: int = 4
) -> DataFrame:
    """Tags from viewed products.

    ``log`` is (web_id, uuid, product_id) with ids from URL signatures, ``items`` (web_id,
    product_id, keyword_list). Views are de-duplicated per user and product.
    """
    seen = drop_sentinels(log, ["product_id"]).withColumnRenamed("product_id", "article_id")
    named = items.withColumnRenamed("product_id", "article_id").withColumn("is_cut", F.lit(1))
    coded = tokens.select("uuid", "token", platform_code(F.col("os_platform"), F.col("is_fcm")).alias("code"))
    return usertags.user_tags(seen, named, coded, F.lit(today + dt.timedelta(days=keep_days)))


def member_tags(
    members: DataFrame, today: dt.date, new: str = "new customer", old: str = "old customer", keep_days: int = 7
) -> tuple[DataFrame, DataFrame]:
    """New/returning customer tags and their counts, without a threshold."""
    known = drop_sentinels(members, ["member"])
    tags = known.select(
        "web_id", "token", "uuid",
        platform_code(F.col("os_platform"), F.col("is_fcm")).alias("code"),
        member_tag(F.col("member"), new, old).alias("usertag"),
        F.lit(today + dt.timedelta(days=keep_days)).alias("expired_date"),
    )
    counts = usertags.tag_counts(tags).withColumns(
        {"expired_date": F.lit(today + dt.timedelta(days=keep_days)), "enable": F.lit(1)}
    )
    return tags, counts


def bucket_tags(
    log: DataFrame, articles: DataFrame, limit: int = 50, hours: int = 2, ts: str = "ts", spread: int = 8,
    longest: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Tags per user and two-hour bucket with retention: (kept tags, kept bucket counts).

    One row per (user, tag, bucket), the one of the smallest article id. Tags of more than ``longest`` characters
    are left out if it is given.
    """
    stamped = log.select(
        "web_id", "uuid", "article_id", F.to_date(ts).alias("date"), hour_bucket(F.col(ts), hours).alias("hour")
    ).distinct()
    rows = salted_join(stamped, articles, ["web_id", "article_id"], spread=spread)
    tagged = rows.withColumn("usertag", F.explode("keyword_list")).drop("keyword_list")
    tagged = tagged if longest is None else cap_length(tagged, "usertag", longest)
    once = keep_first(tagged, ["web_id", "uuid", "usertag", "date", "hour"], [F.asc("article_id")])
    stats = usertags.bucket_stats(once)
    return usertags.retain_recent(once, stats, limit), usertags.retained_buckets(stats, limit)


def uuid_tags(log: DataFrame, articles: DataFrame, day: dt.date, ts: str = "ts") -> DataFrame:
    """Tags of users without registrations."""
    return usertags.user_tags(day_window(log, ts, day), articles, None, F.lit(day))
