"""Set operations and keyword dictionaries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def minus(df: DataFrame, other: DataFrame) -> DataFrame:
    return df.subtract(other)


def distinct_words(df: DataFrame, word: str = "word") -> DataFrame:
    return df.select(word).distinct().orderBy(word)


def distinct_tags(df: DataFrame, tags: Column, out: str = "keyword") -> DataFrame:
    """Distinct trimmed, non-empty members of an array column."""
    trimmed = F.transform(tags, lambda t: F.trim(t))
    return df.select(F.explode(trimmed).alias(out)).where(F.col(out) != "").distinct()


def term_counts(df: DataFrame, keys: Sequence[str], term: str, out: str = "freq") -> DataFrame:
    return df.groupBy(*keys, term).agg(F.count("*").alias(out))


def intersect_ordered(words: Column, allowed: Column) -> Column:
    """Members of ``words`` that ``allowed`` has, in the order and multiplicity of ``words``."""
    return F.filter(words, lambda w: F.array_contains(allowed, w))


def keyword_dictionary(
    added: DataFrame, trends: DataFrame, priced: DataFrame, bw_list: DataFrame, every: str = "all"
) -> DataFrame:
    """(web_id, keyword): ``*`` rows hold for every tenant, the others are tenant whitelists."""
    star = F.lit("*").alias("web_id")
    related = F.explode(F.concat(F.array("keyword"), "related_queries"))
    white = bw_list.where(F.col("property") == 1)
    frames = [
        added.select(star, F.col("word").alias("keyword")),
        trends.where(F.size("related_queries") > 0).select(star, related.alias("keyword")),
        priced.where(F.col("low_price") != 0).select(star, "keyword"),
        white.select(
            F.when(F.col("web_id") == every, "*").otherwise(F.col("web_id")).alias("web_id"),
            F.col("name").alias("keyword"),
        ),
    ]
    return union_all(*frames).distinct()


def bw_lists(bw_list: DataFrame, tenants: DataFrame) -> DataFrame:
    """(web_id, keyword, property): 0 black, 1 white; tenant display names count as black.

    ``tenants.name`` is a JSON array of names.
    """
    names = F.explode(F.from_json("name", T.ArrayType(T.StringType())))
    own = tenants.select("web_id", names.alias("keyword"), F.lit(0).alias("property"))
    listed = bw_list.select("web_id", F.col("name").alias("keyword"), F.col("property").cast("int"))
    return union_all(listed, own).distinct()
