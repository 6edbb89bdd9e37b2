"""Tables that only grow: each batch writes a folder of its own, so a repeated batch replaces itself.

A later row of a key stands for the earlier ones, or all rows of a key are added up or compared; nothing that is written is
changed, so a batch costs what it brings. Readers look at batches up to a number, and so never at a batch that is half done.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recado.operators.skew import broadcast_if_small
from recado.sources.staging import STORED

KEYS = 1_000_000  # keys of a batch that are broadcast to find their rows; more are joined


def append(df: DataFrame, path: str, batch: int) -> None:
    df.write.mode("overwrite").options(**STORED).parquet(f"{path}/batch={batch}")


def read(spark: SparkSession, path: str, schema: T.StructType | str, after: int = -1, upto: int | None = None) -> DataFrame:
    """Rows with ``batch``, of batches beyond ``after`` and up to ``upto``; none where nothing has been written."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    with_batch = T.StructType([f for f in schema if f.name != "batch"]).add("batch", "long")
    try:
        log = spark.read.schema(with_batch).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], with_batch)
    beyond = F.col("batch") > after
    return log.where(beyond if upto is None else beyond & (F.col("batch") <= upto))


def of_keys(log: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of the log whose columns ``keys.columns`` (NULLs are equal) are among ``keys``.

    Few keys are broadcast, so the log is scanned where it lies; many are joined, and Spark sets a Bloom filter before the shuffle.
    """
    wanted = keys.distinct().select(*[F.col(c).alias(f"_k_{c}") for c in keys.columns])
    same: Column = F.lit(True)
    for c in keys.columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    return log.join(broadcast_if_small(wanted, KEYS), same, "left_semi")


def latest(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of each key's last batch; a batch writes one row a key."""
    newest = W.partitionBy(*keys).orderBy(F.col("batch").desc())
    return log.withColumn("_age", F.row_number().over(newest)).where("_age = 1").drop("_age")
