"""Steps on whole comments, before any text is changed.

A comment has ``interaction_date``, ``user_name``, ``url``, ``text`` and, where the source has them,
``comment_id`` and ``content_type``. What tells comments apart is the id together with the digest of the
text (`IDENTITY`): overlapping extracts bring a comment several times, edited comments keep their id, and
sources without ids get derived ones (`with_ids`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from recado.functions import text as t
from recado.operators.skew import attach, broadcast_if_small
from recado.sources.staging import staged

IDENTITY = ("comment_id", "text_key")
TIES = ("url", "content_type")
HOT_COPIES = 1_000  # equal copies of a comment that are shuffled one by one at most


def with_ids(df: DataFrame) -> DataFrame:
    """``df`` with a ``comment_id`` on every row: where there is none, a digest of what the row says.

    Derived numbers are negative, so they meet no id that a source counts up. Equal rows get equal ids. To be called
    before dates are parsed, as their text takes part.
    """
    if "comment_id" not in df.columns:
        df = df.withColumn("comment_id", F.lit(None).cast("bigint"))
    if "content_type" not in df.columns:
        df = df.withColumn("content_type", F.lit(None).cast("string"))
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in ("user_name", "interaction_date", "url", "content_type", "text")]
    kind = df.schema["comment_id"].dataType
    if isinstance(kind, StringType):
        derived = F.sha2(F.concat_ws("\x01", *parts), 256)
    else:
        derived = -1 - F.shiftrightunsigned(F.xxhash64(*parts), 1)
    return df.withColumn("comment_id", F.coalesce("comment_id", derived.cast(kind)))


def with_text_key(df: DataFrame) -> DataFrame:
    return df if "text_key" in df.columns else df.withColumn("text_key", t.text_key(F.col("text")))


def texts_once(df: DataFrame) -> DataFrame:
    """``(comment_id, text_key, text)``, one row for each id and text; joins by both find it in one partition."""
    order = Window.partitionBy(*IDENTITY).orderBy(F.lit(0))
    return (with_text_key(df.select("comment_id", *[x for x in ("text", "text_key") if x in df.columns])).withColumn("_copy", F.row_number().over(order))
            .where(F.col("_copy") == 1).drop("_copy"))


def texts_dealt(df: DataFrame, tasks: int, hot_copies: int = HOT_COPIES) -> DataFrame:
    """`texts_once` dealt into ``tasks`` partitions by `IDENTITY`, with one shuffle of the texts.

    A shuffle whose partitions are given takes every copy, so comments with over ``hot_copies`` equal ones, counted first, are cut
    to one copy a map task as in `texts_once`.
    """
    keyed = with_text_key(df.select("comment_id", "text"))
    copies = keyed.groupBy(*IDENTITY).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_copies).select(*IDENTITY)
    hot = staged(copies, "hot-copies")
    if not hot.isEmpty():
        hot = broadcast_if_small(hot)
        keyed = keyed.join(hot, list(IDENTITY), "left_anti").unionByName(texts_once(keyed.join(hot, list(IDENTITY), "left_semi")))
    return texts_once(keyed.repartition(tasks, *IDENTITY))


def has_good_date() -> Column:
    return F.col("interaction_date").isNull() | F.try_to_timestamp(F.col("interaction_date").cast("string")).isNotNull()


def bad_dates(df: DataFrame) -> DataFrame:
    """Rows whose date is there but cannot be read, as they came: the rejected table of tolerant runs."""
    return df.where(~has_good_date())


def drop_null_text(df: DataFrame) -> DataFrame:
    return df.where(F.col("text").isNotNull())


def parse_dates(df: DataFrame, strict: bool = True) -> DataFrame:
    """``interaction_date`` as a timestamp. Strict parsing fails on a bad date; otherwise it is NULL."""
    parse = F.to_timestamp if strict else F.try_to_timestamp
    return df.withColumn("interaction_date", parse(F.col("interaction_date")))


def dedupe_comments(df: DataFrame) -> DataFrame:
    """One comment per text and user (NULL users are equal): the earliest, then the lowest id, then the first by `TIES`, so the choice
    hangs on what the comments say and not on how they arrive.

    Spark cuts each map task's rows to one per key before the shuffle, so a text copied a million
    times reaches the reducer once per map task. A ``text_key`` that is there already stands for the text.
    """
    key = Window.partitionBy("text_key", "user_name").orderBy("interaction_date", "comment_id", *[x for x in TIES if x in df.columns])
    return (with_text_key(df).withColumn("_rank", F.row_number().over(key)).where(F.col("_rank") == 1)
            .select(*df.columns))


def duplicate_ratio(df: DataFrame) -> DataFrame:
    """Percentage of comments that repeat another one's text and user, to 2 decimals."""
    per_key = df.groupBy(t.text_key(F.col("text")).alias("_text_key"), "user_name").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.round(100 * (F.sum("n") - F.count(F.lit(1))) / F.sum("n"), 2).alias("duplicate_pct"))


def post_url(url: Column, network: str | None) -> Column:
    """Address of the post a comment belongs to. Unknown networks keep the comment's address."""
    if network == "instagram":
        return t.post_url_from_path(url)
    if network == "facebook":
        return t.post_url_from_query(url)
    return F.coalesce(url, F.lit("no_url"))


def publish_date(df: DataFrame) -> DataFrame:
    """Earliest comment date per post, on every row. A viral post is spread over several tasks."""
    posts = df.groupBy("url").agg(F.min("interaction_date").alias("publish_date"), F.count(F.lit(1)).alias("n_rows"))
    return attach(df, posts, ["url"], ["publish_date"], row_id=["comment_id"])


def comment_reject_reason(text: Column, brand: str) -> Column:
    return (F.when(t.is_foreign_mention(text, brand), "mention")
            .when(t.is_name_first(text, brand), "name"))


def filter_mentions(df: DataFrame, brand: str) -> DataFrame:
    return df.where(~t.is_foreign_mention(F.col("text"), brand))


def filter_names(df: DataFrame, brand: str) -> DataFrame:
    return df.where(~t.is_name_first(F.col("text"), brand))
