"""Rolling problem counts per user, and the most frequent problem, for every day on which a span of days ends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from recado.operators import modes as m
from recado.profiles import Taxonomy
from recado.sources.staging import scratch_scope, staged
from recado.streaming import logs
from recado.streaming.ingest import run_available

MODES = "user_name string, run date, problema_30d string, n long"


def daily_counts(rows: DataFrame) -> DataFrame:
    """``(user_name, day, problema, n)`` of rows with a problem."""
    return (rows.where(F.col("problema").isNotNull())
            .groupBy("user_name", F.to_date("interaction_date").alias("day"), "problema").agg(F.count(F.lit(1)).alias("n")))


def rolling_problem_counts(daily: DataFrame, days: int = 30) -> DataFrame:
    """``(user_name, run, problema, n)``: rows dated ``[run - days, run]``, from daily counts.

    Counts that several batches have for one day are added first; only then does each day enter its ``days + 1`` spans.
    """
    per_day = daily.groupBy("user_name", "day", "problema").agg(F.sum("n").alias("n"))
    spans = per_day.withColumn("run", F.explode(F.sequence("day", F.date_add("day", days))))
    return spans.groupBy("user_name", "run", "problema").agg(F.sum("n").alias("n"))


def ingest_daily_counts(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Daily counts of each batch in its own folder: late rows are counted like others, a repeated batch replaces itself."""
    def batch(df: DataFrame, batch_id: int) -> None:
        daily_counts(df).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return run_available(stream, batch, checkpoint)


def stored_rolling_counts(spark: SparkSession, path: str, days: int = 30) -> DataFrame:
    """Rolling counts over all that has been ingested, the spans that are still open included."""
    return rolling_problem_counts(spark.read.parquet(path).drop("batch"), days)


def _bucket(day: Column, days: int) -> Column:
    return F.floor(F.unix_date(day) / (days + 1))


def ingest_problem_modes(stream: DataFrame, taxonomy: Taxonomy, root: str, checkpoint: str, days: int = m.DAYS,
                         key: tuple[str, ...] = ("comment_id", "sentence_idx")) -> StreamingQuery:
    """Keep each user's most frequent problem of ``[run - days, run]`` for every day ``run``, over labelled rows that arrive once each.

    A batch adds its daily counts and worst rows, in folders of ``days + 1`` days, to a log. It touches the spans in which its days lie:
    those are worked out anew from the log's folders that they reach, for the users of the batch, and put down as their latest
    state. So a batch reads and writes what its days concern, whatever is stored besides. Several most frequent
    problems: that of the most severe row in the span, then the latest, as in a replay. Rows without a user or date are left out.
    """
    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        with scratch_scope(spark):
            daily = m.counted(df, taxonomy, F.to_date("interaction_date"), key).where(F.col("d").isNotNull())
            daily = staged(daily.withColumn("bucket", _bucket(F.col("d"), days)), "daily-problems")
            daily.write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/daily/batch={number}")
            runs = daily.select("user_name", F.explode(F.sequence("d", F.date_add("d", days))).alias("run")).distinct()
            runs = staged(runs, "touched-spans")
            reach = F.array_distinct(F.array(_bucket(F.date_sub("run", days), days), _bucket(F.col("run"), days)))
            spans = staged(runs.select("user_name", "run", F.explode(reach).alias("bucket")), "span-buckets")
            folders = [r["bucket"] for r in spans.select("bucket").distinct().collect()]  # a folder for each days + 1 days
            if not folders:
                logs.append(spark.createDataFrame([], MODES), f"{root}/modes", number)
                return
            log = _daily_of(spark, root, daily.schema, folders, number)
            pairs = spans.join(log, ["user_name", "bucket"]).where(F.col("d").between(F.date_sub("run", days), F.col("run")))
            per_problem = staged(pairs.groupBy("user_name", "run", "problema").agg(F.sum("n").alias("n"), F.max("worst").alias("worst")), "span-problems")
            known = per_problem.where(F.col("problema").isNotNull())
            best = m.modes_of(known, ["user_name", "run"])
            worst = per_problem.groupBy("user_name", "run").agg(F.max("worst").alias("worst"), F.sum("n").alias("n"))
            state = worst.join(best, ["user_name", "run"], "left").select("user_name", "run", m.chosen("worst").alias("problema_30d"), "n")
            logs.append(state, f"{root}/modes", number)

    return run_available(stream, batch, checkpoint)


def _daily_of(spark: SparkSession, root: str, schema: T.StructType, folders: list[int], upto: int) -> DataFrame:
    """Daily counts in these folders, of batches up to a number."""
    return logs.read(spark, f"{root}/daily", schema, upto=upto).where(F.col("bucket").isin(folders)).drop("batch")


def stored_problem_modes(spark: SparkSession, root: str) -> DataFrame:
    """``user_name``, ``run``, ``problema_30d`` and ``n`` (rows in the span) as they stand."""
    return logs.latest(logs.read(spark, f"{root}/modes", MODES), ["user_name", "run"]).drop("batch")
