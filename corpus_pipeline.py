"""The corpus pipeline: documents are classified, ruled, de-duplicated, mixed and packed.

Each stage takes ``(spark, docs, sf_dir)``, works on all that the one before kept, and returns the columns of ``docs``; the
last returns the packed pieces. Between stages the rows are written as Parquet in the shared folder and read again, so a
lost executor costs its tasks only. An empty table passes through every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recado.llm import mix, neardup, pack, quality, rules
from recado.session import scratch_dir
from recado.sources.staging import remove, scratch_scope

LEAST_QUALITY = 0.3


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is ``LEAST_QUALITY`` or more; learnt from the labels of the documents at hand."""
    weights = quality.train(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))
    scored = quality.score(docs.select(F.struct(*docs.columns).alias("_row"), F.col("text").alias("_text")), weights,
                           text="_text", to="_score", keep=["_row"])
    return scored.where(F.col("_score") >= LEAST_QUALITY).select("_row.*")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are good by the weighed votes of the others."""
    return rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id."""
    return neardup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares: a row for each time that a document is taken."""
    return mix.mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece with its training sequence and offset."""
    return pack.packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing),
]

ORACLE_SQL = None  # a trained classifier, expectation-maximisation and token ids are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage stages, and the rows that the next has read, are deleted; the last rows stay."""
    docs, before = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_dir(spark, f"stage-{name}")
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
