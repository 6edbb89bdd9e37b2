"""Comments out of raw interaction records, as they come or as they were landed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def extract_comments(df: DataFrame, network_key: str, brand: str, since: str, id_column: str | None = None) -> DataFrame:
    """Comments of one network since a date, without the brand's own.

    ``df`` has ``created_at``, ``social_media`` (JSON with ``user_name`` and ``key``), ``url``, ``text``.
    The date test is on the bare column, so the scan can use it. A NULL user name is not "other than
    the brand" and goes. Without an ``id_column`` the id is a digest of the row, and equal rows are one.
    """
    stamped = isinstance(df.schema["created_at"].dataType, (T.TimestampType, T.TimestampNTZType))
    cutoff = F.lit(since).cast("timestamp") if stamped else F.lit(since)
    user = F.get_json_object("social_media", "$.user_name")
    found = df.where(
        (F.col("created_at") >= cutoff)
        & (F.lower(user) != brand.lower())
        & (F.get_json_object("social_media", "$.key") == network_key))
    comments = found.select(
        _row_id(df, id_column).alias("comment_id"),
        F.date_trunc("day", F.col("created_at").try_cast("timestamp")).alias("interaction_date"),
        user.alias("user_name"), "url", "text")
    return comments if id_column else comments.dropDuplicates(["comment_id"])


def _row_id(df: DataFrame, id_column: str | None):
    if id_column:
        return F.col(id_column)
    return F.sha2(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}), 256)


def land_interactions(df: DataFrame, path: str, batch: str) -> None:
    """Write one delivery of interaction records to the landing table: JSON read once, into a VARIANT, in folders by day.

    A delivery that comes again under its name replaces itself. Days of any size are written in even files. A ``created_at`` that
    cannot be read has the NULL day; JSON that cannot be read is NULL. ``row_id`` is the digest of the record as it came.
    """
    landed = df.select(
        *[x for x in df.columns if x not in ("created_at", "social_media", "row_id", "created_day")],
        _row_id(df, None).alias("row_id"), F.col("created_at").try_cast("timestamp").alias("created_at"),
        F.try_parse_json(F.col("social_media")).alias("social_media"))
    days = landed.withColumn("created_day", F.to_date("created_at"))
    days.hint("rebalance", F.col("created_day")).write.mode("overwrite").partitionBy("created_day").parquet(f"{path.rstrip('/')}/batch={batch}")


def extract_landed(spark: SparkSession, path: str, network_key: str, brand: str, since: str, id_column: str | None = None) -> DataFrame:
    """What `extract_comments` gives, from the landing table. Only folders of days from ``since`` on are listed and read.

    ``since`` is compared as a time, so dates need not be written in ISO order; records of the NULL day are not extracted. A user name
    that is an object or array is none. Without an ``id_column`` the id is ``row_id``, and equal records are one, also over deliveries.
    """
    landed = spark.read.option("mergeSchema", "true").parquet(path)
    user = F.try_variant_get("social_media", "$.user_name", "string")
    cutoff = F.lit(since).cast("timestamp")
    found = landed.where(
        (F.col("created_day") >= F.to_date(cutoff)) & (F.col("created_at") >= cutoff)
        & (F.lower(user) != brand.lower())
        & (F.try_variant_get("social_media", "$.key", "string") == network_key))
    comments = found.select(
        F.col(id_column or "row_id").alias("comment_id"), F.date_trunc("day", "created_at").alias("interaction_date"),
        user.alias("user_name"), "url", "text")
    return comments if id_column else comments.dropDuplicates(["comment_id"])
