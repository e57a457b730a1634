"""Join shapes. Sizes decide the strategy (AQE); hints appear only where a bound is proven."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.ranking import keep_first, top_k, top_n


def salted_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", spread: int = 8
) -> DataFrame:
    """Equi join that cuts every left key into ``spread`` slices and repeats the right side per slice.

    For a large skewed left and a smaller right. Left-driven join types only. Spark takes an exploded row for one row and
    would broadcast all copies of a side that fits the threshold only once, so such a side is merged.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("salting keeps only left-driven joins exact")
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(spread)).cast("int")
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    if _fits_once_only(right, spread):
        copies = copies.hint("merge")
    return left.withColumn("_salt", salt).join(copies, [*on, "_salt"], how).drop("_salt")


def _fits_once_only(df: DataFrame, copies: int) -> bool:
    """Whether Spark would broadcast ``df`` by its estimate, but not ``copies`` of it."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    most = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return size <= most < size * copies


def natural_join(left: DataFrame, right: DataFrame, spread: int | None = None) -> DataFrame:
    """Inner join on every shared column."""
    on = [c for c in left.columns if c in set(right.columns)]
    return salted_join(left, right, on, spread=spread) if spread else left.join(right, on)


def join_complete(left: DataFrame, right: DataFrame, on: Sequence[str], spread: int | None = None) -> DataFrame:
    """Left join followed by dropping any row with a null: an inner join without nulls."""
    joined = salted_join(left, right, on, spread=spread) if spread else left.join(right, list(on))
    return joined.dropna("any")


def lookup_default(
    df: DataFrame, lookup: DataFrame, on: Sequence[str], defaults: Mapping[str, Column]
) -> DataFrame:
    """Left join that fills looked-up columns with a default where nothing matched."""
    joined = df.join(lookup.select(*on, *defaults), list(on), "left")
    return joined.withColumns({name: F.coalesce(F.col(name), value) for name, value in defaults.items()})


def align_now_last(now: DataFrame, last: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Current rows with the previous snapshot's value; keys only seen before are dropped."""
    before = last.select(*keys, F.col(value).alias(f"{value}_last"))
    return now.join(before, list(keys), "left")


def keep_in(df: DataFrame, members: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(members.select(*on).dropna(), list(on), "left_semi")


def keep_not_in(df: DataFrame, members: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(members.select(*on).dropna(), list(on), "left_anti")


def flag_blacklist(df: DataFrame, black: DataFrame, on: Sequence[str], out: str = "enable") -> DataFrame:
    """``out`` is 0 for listed rows and 1 for the others."""
    listed = black.select(*on).distinct().withColumn("_listed", F.lit(True))
    joined = df.join(listed, list(on), "left")
    return joined.withColumn(out, F.when(F.col("_listed"), 0).otherwise(1)).drop("_listed")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return keep_first(df, keys, order)


def top_similar(
    similarity: DataFrame,
    tenant: str = "web_id",
    main: str = "main_product_id",
    other: str = "similarity_product_id",
    score: str = "text_similarity",
    wide: int = 3,
    products: int | None = None,
) -> DataFrame:
    """The ``wide`` most similar products per product as columns sim1.., of all products or of the first ``products``.

    A score of exactly 1 marks a copy and is left out; products with too few partners are dropped.
    """
    ranked = top_k(
        similarity.where(F.col(score) != 1),
        [tenant, main],
        [F.desc(score), F.asc(other)],
        wide,
        rank="_sim",
    )
    names = [f"sim{i}" for i in range(1, wide + 1)]
    spread = ranked.groupBy(tenant, main).pivot("_sim", list(range(1, wide + 1))).agg(F.first(other))
    for i, name in enumerate(names, 1):
        spread = spread.withColumnRenamed(str(i), name)
    complete = spread.dropna("any", subset=names)
    return complete if products is None else top_k(complete, [tenant], [F.asc(main)], products)


def cross_hot(
    facts: DataFrame,
    bridge: DataFrame,
    key: str,
    measures: Iterable[str],
    order_by: str = "pageviews",
    n: int = 500,
    mentioned: str = "article_id",
) -> DataFrame:
    """Hottest keys over all tenants with the number of bridge rows that mention each of them.

    The bridge is counted per key first; it is not cut by date unless the caller does so.
    """
    totals = facts.groupBy(key).agg(*[F.sum(m).alias(m) for m in measures])
    hot = top_n(totals, [F.desc(order_by), F.asc(key)], n)
    counts = bridge.groupBy(key).agg(F.count(mentioned).alias("mentioned_articles"))
    return hot.join(counts, key)


def enrich_by_url(
    rows: DataFrame, items: DataFrame, url_key: Column, item_key: Column, columns: Sequence[str]
) -> DataFrame:
    """Attach item columns by normalised URL (the same rule on both sides), ``_`` when unknown."""
    keyed = items.select(item_key.alias("_key"), *columns)
    lookup = keep_first(keyed, ["_key"], [F.asc_nulls_last(c) for c in columns])
    joined = rows.withColumn("_key", url_key).join(lookup, "_key", "left").drop("_key")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit("_")) for c in columns})


def enrich_by_title(rows: DataFrame, items: DataFrame, keep_unknown: bool = True) -> DataFrame:
    """Product id by title; ``_`` when unknown."""
    lookup = keep_first(items.select("title", "product_id"), ["title"], [F.asc("product_id")])
    joined = rows.drop("product_id").join(lookup, "title", "left")
    joined = joined.withColumn("product_id", F.coalesce("product_id", F.lit("_")))
    return joined if keep_unknown else joined.where(F.col("product_id") != "_")
