"""The test tables as comments, sentences and labelled rows. Each has its twin in `suite.sql`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TASK_ROWS = 10_000
NO_TEXT_IDS = 1_000_000_000  # comments without a text, one per row of `labels`
EVENT_TYPES = ("purchase", "error", "click", "view", "signup")
EVENT_LABELS = ("Loved it", "Loved it", "Loved it", "Late delivery", "Wrong item", "Late delivery", "Refund", "Advert",
                "Refund", "Unknown cluster", "Unknown cluster", "Unknown cluster", None, None)  # id 14 has no entry
# what a word can be, and what it then becomes, by the remainder of its length by 7 (0 and 6: not in the dictionary)
OPEN_KINDS = ("1:NOUN:a", "2:VERB:ar", "3:NOUN:a", "3:VERB:er", "4:ADJ:o", "4:NOUN:a", "4:VERB:ir", "5:ADP:x", "5:NOUN:a")
PROBLEM_OF = {"Late delivery": "Delivery", "Wrong item": "Delivery", "Refund": "Money"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The test tables are one file each, so one task: give text work all cores, and a task no more than `TASK_ROWS`. A cluster's tables have many files."""
    spark = df.sparkSession
    if not spark.sparkContext.master.startswith("local"):
        return df
    return df.repartition(max(spark.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS)))


def comments(spark: SparkSession, sf_dir: str, dealt: bool = True) -> DataFrame:
    """Every document is a comment, some by tagged users, some after a name; every label is one without text.

    ``dealt``: see `spread`; not for rows that are dealt out anyway.
    """
    i = F.col("comment_id")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("comment_id"), "text", F.col("source").alias("content_type"))
    docs = spread(docs) if dealt else docs
    empty = table(spark, sf_dir, "labels").select(
        (F.col("doc_id") + NO_TEXT_IDS).alias("comment_id"), F.lit(None).cast("string").alias("text"),
        F.lit("label").alias("content_type"))
    both = docs.unionByName(empty)
    return both.select(
        "comment_id",
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(i * 7, F.lit(60)).cast("int")), "yyyy-MM-dd")
        .alias("interaction_date"),
        F.when(i % 41 != 0, F.concat(F.lit("user_"), F.pmod(i, F.lit(37)).cast("string"))).alias("user_name"),
        F.when(i % 53 != 0, F.concat(F.lit("https://social.example/p/"), F.pmod(i, F.lit(50)).cast("string"),
                                     F.lit("/c/"), i.cast("string"))).alias("url"),
        "content_type",
        F.when(i % 23 == 0, F.concat(F.lit("@maria "), F.col("text")))
        .when(i % 29 == 0, F.concat(F.lit("@erreth "), F.col("text")))
        .when(i % 19 == 0, F.concat(F.lit("Maria Souza, "), F.col("text")))
        .otherwise(F.col("text")).alias("text"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comment texts with their id."""
    return comments(spark, sf_dir).where(F.col("text").isNotNull()).select("comment_id", "text")


def event_k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def event_cluster() -> Column:
    kind = F.coalesce(*[F.when(F.col("event_type") == e, F.lit(i)) for i, e in enumerate(EVENT_TYPES)])
    return (kind * 3 + F.pmod(event_k(), F.lit(3))).cast("int")


def event_sentences(spark: SparkSession, sf_dir: str, teams: bool = False) -> DataFrame:
    """Events as sentences with a cluster id. ``teams``: few users and texts, so that groups have several rows."""
    user = F.when(F.col("user_id") % 17 != 0, F.concat(F.lit("user_"), F.col("user_id").cast("string")))
    note = F.concat(F.lit("note "), event_k().cast("string"))
    if teams:
        user = F.when(F.col("user_id") % 15 != 0, F.concat(F.lit("team_"), (F.col("user_id") % 15).cast("string")))
        note = F.concat(F.lit("note "), F.floor(event_k() / 4).cast("string"))
    return spread(table(spark, sf_dir, "events")).select(
        F.col("event_id").alias("comment_id"), F.lit(0).alias("sentence_idx"), user.alias("user_name"),
        F.date_trunc("day", F.col("ts").cast("timestamp")).alias("interaction_date"),
        F.concat(F.lit("https://social.example/e/"), F.col("event_type")).alias("url"),
        F.col("event_type").alias("content_type"), note.alias("original_text"), event_cluster().alias("subclusters_id"))


def event_lookup(sentences: DataFrame) -> DataFrame:
    """``(subclusters_id, cluster, problema, size)`` with sizes counted from the data."""
    i = F.col("subclusters_id")
    label = F.coalesce(*[F.when(i == n, F.lit(name)) for n, name in enumerate(EVENT_LABELS) if name])
    problem = F.coalesce(*[F.when(F.col("cluster") == name, F.lit(p)) for name, p in PROBLEM_OF.items()])
    return (sentences.groupBy("subclusters_id").agg(F.count(F.lit(1)).alias("size"))
            .where(i < len(EVENT_LABELS))
            .withColumn("cluster", label).withColumn("problema", problem))


def features() -> Column:
    """Three whole numbers per sentence: words, letters, letters 'e'."""
    text = F.col("text")
    return F.array(*[x.cast("double") for x in (
        F.size(F.filter(F.split(text, " "), lambda w: w != "")), F.length(text),
        F.length(text) - F.length(F.replace(text, F.lit("e"), F.lit(""))))])


CENTROIDS = ((0, (3.0, 12.0, 1.0)), (1, (3.0, 16.0, 3.0)), (2, (4.0, 20.0, 2.0)), (3, (4.0, 24.0, 5.0)),
             (4, (5.0, 28.0, 3.0)), (5, (6.0, 33.0, 5.0)), (6, (7.0, 38.0, 4.0)), (7, (8.0, 45.0, 8.0)),
             (9, (9.0, 52.0, 6.0)), (10, (11.0, 60.0, 9.0)), (12, (12.0, 70.0, 7.0)), (14, (14.0, 85.0, 12.0)))


def centroid_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, list(c)) for i, c in CENTROIDS], "subclusters_id int, center array<double>")


def fixed_lookup(spark: SparkSession) -> DataFrame:
    rows = [(n, name, PROBLEM_OF.get(name), 1000 - 37 * n % 400) for n, name in enumerate(EVENT_LABELS)]
    return spark.createDataFrame(rows, "subclusters_id int, cluster string, problema string, size bigint")
