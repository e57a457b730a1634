"""Documents to packed training sequences, in stages that are written and read again one after the other."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.llm import ngram_join, quality, secrets
from clickloom.llm.catalog import packed_documents
from clickloom.llm.common import keyed, read
from clickloom.session import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels beside the documents.

    Without a label of any of them all are kept.
    """
    model = quality.trained(docs, read(spark, sf_dir, "labels"))
    if model == quality.UNKNOWN:
        return docs
    return docs.where(quality.score(F.col("text"), model) >= quality.KEEP)


def keep_one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near copies; documents without an id go."""
    groups = ngram_join.similar_documents(docs.select("doc_id", "text"))
    key = F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id")
    # fewer documents go than stay, so this is the list that travels to the texts
    kept = keyed(docs, "doc_id").join(materialise(groups.where("doc_id <> component_id").select(key), "others"), "doc_id", "left_anti")
    again = materialise(kept.groupBy("doc_id").count().where("count > 1").select("doc_id"), "again")
    if again.isEmpty():
        return kept
    # rows that repeat an id are one document: the smallest text stands for it, as in the join
    by_text = Window.partitionBy("doc_id").orderBy(F.coalesce("text", F.lit("")))
    several = kept.join(again, "doc_id", "left_semi")
    one = several.select(F.struct("*").alias("doc"), F.row_number().over(by_text).alias("nth")).where("nth = 1").select("doc.*")
    return kept.join(again, "doc_id", "left_anti").unionByName(one)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked and their lengths counted anew."""
    masked = docs.withColumn("text", secrets.redact(F.col("text")))
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document goes in training sequences."""
    return packed_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("near_copies", keep_one_of_copies),
    ("secrets", mask_secrets),
    ("packing", pack),
]

ORACLE_SQL: str | None = None  # a learned classifier has no SQL; tests/llm hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
