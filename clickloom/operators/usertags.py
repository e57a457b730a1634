"""User tags: counting, thresholds, retention and ranking."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators.joins import flag_blacklist, salted_join
from clickloom.operators.ranking import keep_first, top_k
from clickloom.session import materialise

MANY_TAGS = 500
TAG_KEYS = ("web_id", "usertag", "uuid", "article_id")


def tag_counts(tags: DataFrame, approximate: bool = False) -> DataFrame:
    """Term frequency, distinct tokens and distinct users per tag.

    Exact counts de-duplicate (tag, token) and (tag, user) pairs before they meet at the tag, so a
    hot tag is spread over its users. ``approximate`` trades that for one pass of sketches.
    """
    distinct = F.approx_count_distinct if approximate else F.countDistinct
    return tags.groupBy("web_id", "usertag").agg(
        F.count("*").alias("term_freq"),
        distinct("token").alias("token_count"),
        distinct("uuid").alias("uuid_count"),
    )


def tag_limits(counts: DataFrame, value: str = "token_count", many: int = MANY_TAGS) -> DataFrame:
    """Per tenant: number of tags ``n`` and the count a tag must exceed.

    Below ``many`` tags the limit is mean - 50. From there on it is the linear percentile at rank
    (1 - many/n) * (n - 1). The percentile is read from the histogram of distinct counts, which
    stays small where a tenant has very many tags.
    """
    bars = counts.groupBy("web_id", F.col(value).alias("_v")).agg(F.count("*").alias("_c"))
    line = Window.partitionBy("web_id").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("web_id")
    stacked = bars.withColumns(
        {
            "_upto": F.sum("_c").over(line),
            "n": F.sum("_c").over(whole),
            "_mean": F.sum(F.col("_v") * F.col("_c")).over(whole) / F.sum("_c").over(whole),
        }
    )
    rank = (1 - many / F.col("n")) * (F.col("n") - 1)
    low, high = F.floor(rank), F.ceil(rank)
    picked = stacked.groupBy("web_id", "n", "_mean").agg(
        F.min(F.when(F.col("_upto") > low, F.col("_v"))).alias("_low"),
        F.min(F.when(F.col("_upto") > high, F.col("_v"))).alias("_high"),
    )
    percentile = F.col("_low") + (F.col("_high") - F.col("_low")) * (rank - low)
    limit = F.when(F.col("n") < many, F.col("_mean") - 50).otherwise(percentile)
    return picked.select("web_id", "n", limit.alias("freq_limit"))


def above_threshold(counts: DataFrame, value: str = "token_count", many: int = MANY_TAGS) -> DataFrame:
    """Tags over their tenant's limit; small tenants also need a count over 2."""
    limits = tag_limits(counts, value, many)
    # one row per tenant against one row per tag
    joined = counts.join(limits, "web_id")
    enough = (F.col("n") >= many) | (F.col(value) > 2)
    return joined.where(enough & (F.col(value) > F.col("freq_limit"))).drop("n", "freq_limit")


def usertag_report(
    tags: DataFrame, black: DataFrame, expired_date: dt.date | Column, many: int = MANY_TAGS, approximate: bool = False
) -> DataFrame:
    """Counted, flagged and thresholded tags. ``black`` is (web_id, usertag).

    The counts, one row per tag, are stored once: limits and report both start from them.
    """
    when = expired_date if isinstance(expired_date, Column) else F.lit(expired_date)
    counts = materialise(tag_counts(tags, approximate), "tag-counts")
    flagged = flag_blacklist(counts, black, ["web_id", "usertag"])
    return above_threshold(flagged.withColumn("expired_date", when), many=many)


def user_tags(
    views: DataFrame,
    articles: DataFrame,
    tokens: DataFrame | None,
    expired_date: dt.date | Column,
    spread: int = 8,
) -> DataFrame:
    """One tag row per (tenant, tag, user, article).

    ``articles`` is (web_id, article_id, keyword_list, is_cut). The log is reduced to distinct
    (user, article) pairs before any join, and both joins cut hot articles and users into slices.
    """
    when = expired_date if isinstance(expired_date, Column) else F.lit(expired_date)
    pairs = views.select("web_id", "uuid", "article_id").distinct()
    rows = salted_join(pairs, articles, ["web_id", "article_id"], spread=spread)
    rows = rows.withColumn("usertag", F.explode(F.array_distinct("keyword_list"))).drop("keyword_list")
    rows = rows.where(F.col("usertag") != "")
    if tokens is not None:
        # one user may own several registrations; one of them represents every tag row of theirs, so it is chosen
        # before any registration travels in slices
        one = keep_first(tokens.dropna("any"), ["uuid"], [F.asc("token")])
        rows = salted_join(rows, one, ["uuid"], spread=spread).dropna("any")
        rows = keep_first(rows, list(TAG_KEYS), [F.asc("token")])
    return rows.withColumn("expired_date", when)


def bucket_stats(tags: DataFrame, keys: Sequence[str] = ("web_id", "uuid", "date", "hour")) -> DataFrame:
    return tags.groupBy(*keys).agg(F.count("*").alias("num_usertag"))


def heavy_users(stats: DataFrame, limit: int, keys: Sequence[str] = ("web_id", "uuid")) -> DataFrame:
    return stats.groupBy(*keys).agg(F.sum("num_usertag").alias("n")).where(F.col("n") > limit)


def retained_buckets(stats: DataFrame, limit: int, keys: Sequence[str] = ("web_id", "uuid")) -> DataFrame:
    """Newest buckets of each user up to and including the one that reaches ``limit`` tags.

    Windows run over bucket rows (a user has at most a few per day), never over tags.
    """
    newest = Window.partitionBy(*keys).orderBy(F.desc("date"), F.desc("hour"))
    before = F.sum("num_usertag").over(newest.rowsBetween(Window.unboundedPreceding, -1))
    kept = stats.withColumn("_before", F.coalesce(before, F.lit(0)))
    return kept.where(F.col("_before") < limit).drop("_before")


def retain_recent(tags: DataFrame, stats: DataFrame, limit: int) -> DataFrame:
    """Tag rows that fall into retained buckets (a key is one user's few hours, so it is never hot)."""
    keys = ["web_id", "uuid", "date", "hour"]
    return tags.join(retained_buckets(stats, limit).select(*keys), keys, "left_semi")


def rank_user_tags(
    old: DataFrame,
    new: DataFrame,
    prices: DataFrame,
    limit: int = 100,
    challengers: int = 10,
    sample: int | None = None,
) -> DataFrame:
    """Merged tag list per user: the ``limit`` most frequent, with price challengers swapped in.

    ``old`` and ``new`` are (web_id, uuid, keyword, freq). The next ``challengers`` keywords are
    matched in price order with a fixed sample (hash order, a fifth of the limit) of kept keywords
    in rising price; a challenger that is worth more takes the slot.
    """
    who = ["web_id", "uuid"]
    sample = sample or max(limit // 5, 1)
    merged = (
        old.select(*who, "keyword", "freq")
        .unionByName(new.select(*who, "keyword", "freq"))
        .groupBy(*who, "keyword")
        .agg(F.sum("freq").alias("freq"))
    )
    by_freq = [F.desc("freq"), F.asc("keyword")]
    ranked = top_k(merged, who, by_freq, limit + challengers, rank="_rank")
    priced = ranked.join(prices.select("keyword", "price"), "keyword", "left").fillna(0, ["price"])

    # from here on a user has at most limit + challengers rows
    kept = priced.where(F.col("_rank") <= limit)
    rivals = priced.where(F.col("_rank") > limit)
    picks = top_k(kept, who, [F.asc(F.md5("keyword"))], sample)
    weakest = Window.partitionBy(*who).orderBy(F.asc("price"), F.asc("keyword"))
    dearest = Window.partitionBy(*who).orderBy(F.desc("price"), F.asc("keyword"))
    slots = picks.select(
        *who, F.col("keyword").alias("_weak"), F.col("price").alias("_weak_price"),
        F.row_number().over(weakest).alias("_slot"),
    )
    offers = rivals.select(
        *who, F.col("keyword").alias("_rival"), F.col("freq").alias("_rival_freq"),
        F.col("price").alias("_rival_price"), F.row_number().over(dearest).alias("_slot"),
    )
    swaps = slots.join(offers, [*who, "_slot"]).where(F.col("_rival_price") > F.col("_weak_price"))
    swaps = swaps.select(*who, F.col("_weak").alias("keyword"), "_rival", "_rival_freq")
    return kept.join(swaps, [*who, "keyword"], "left").select(
        *who,
        F.coalesce("_rival", "keyword").alias("keyword"),
        F.coalesce("_rival_freq", "freq").alias("freq"),
    )
