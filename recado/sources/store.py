"""The stored results: a table partitioned by date that new results are merged into."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recado.operators.upsert import upsert_results
from recado.sources.files import RESULT_COLUMNS, RESULT_SCHEMA
from recado.sources.staging import STORED, remove, scratch_scope, staged

FILE_ROWS = 1_000_000  # rows of a date that make one file


def read_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RESULT_SCHEMA).parquet(path).select(*RESULT_COLUMNS)


def stored_on(spark: SparkSession, path: str, dates: list[date | None]) -> DataFrame:
    """Stored rows of these dates: a filter on the partition column, so no other folder is listed or read."""
    day = F.col("interaction_date")
    wanted = day.isin([d for d in dates if d is not None])
    return read_store(spark, path).where(wanted | day.isNull() if None in dates else wanted)


def merge_into_store(new: DataFrame, path: str) -> None:
    """Upsert: only the dates that occur in ``new`` are read and rewritten.

    The dates of one batch, a few hundred days at most, come to the driver. The merged dates are stored in the shared
    folder first, so no file is replaced while it is read. Running it again with the same rows changes nothing.
    """
    spark = new.sparkSession
    with scratch_scope(spark):
        new = staged(new.select(*RESULT_COLUMNS), "new-results")
        dates = [r["interaction_date"] for r in new.select("interaction_date").distinct().collect()]
        stored = _stored_on(spark, path, dates)
        _rewrite(new if stored is None else staged(upsert_results(stored, new), "merged-results"), path)


def replace_texts(new: DataFrame, before: DataFrame, path: str) -> None:
    """Put the rows of ``new`` in place of all stored rows of their texts, one of which each text has at most.

    ``before`` (``interaction_date``) names the dates where such rows stand. Those dates and the new ones are read and rewritten; a
    date that is left without a row loses its folder. Running it again changes nothing.
    """
    spark = new.sparkSession
    with scratch_scope(spark):
        new = staged(new.select(*RESULT_COLUMNS), "new-results")
        touched = new.select("interaction_date").unionByName(before.select("interaction_date")).distinct()
        dates = [r["interaction_date"] for r in touched.collect()]
        stored = _stored_on(spark, path, dates)
        merged = new if stored is None else staged(upsert_results(stored, new, others=()), "merged-results")
        left = _rewrite(merged, path)
        for day in set(dates) - left:
            remove(spark, f"{path}/interaction_date={'__HIVE_DEFAULT_PARTITION__' if day is None else day}")


def _stored_on(spark: SparkSession, path: str, dates: list[date | None]) -> DataFrame | None:
    try:
        return stored_on(spark, path, dates)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _rewrite(merged: DataFrame, path: str) -> set[date | None]:
    """Write the merged dates, from a staged table; those that have rows."""
    sizes = {r["interaction_date"]: r["n"] for r in merged.groupBy("interaction_date").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = 1 + max(sizes.values(), default=0) // FILE_ROWS
    (merged.repartition("interaction_date", F.pmod(F.xxhash64("original_text"), F.lit(parts)))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**STORED)
     .partitionBy("interaction_date").parquet(path))
    return set(sizes)
