"""Each user's most frequent problem over a span of days, now or replayed for past days.

Rows hold ``user_name``, ``interaction_date``, ``problema``, ``sentimento`` and a row key. They are
first counted per user, date and problem, and the counts are stored: what follows reads them several
times, and grows with dates and problems, not with rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recado.operators.labels import severity
from recado.operators.skew import attach
from recado.profiles import Taxonomy
from recado.sources.staging import staged

DAYS = 30  # fixed value
NO_SENTIMENT = 1_000  # rows without a sentiment count as the most severe


def counted(rows: DataFrame, taxonomy: Taxonomy, date: Column, key: Sequence[str]) -> DataFrame:
    """``(user_name, d, problema, n, worst)``; ``worst`` orders rows by severity, date and key."""
    worst = F.struct(F.coalesce(severity(taxonomy), F.lit(NO_SENTIMENT)).alias("severity"), F.col("d"), *key, F.col("problema"))
    return (rows.where(F.col("user_name").isNotNull()).withColumn("d", date)
            .groupBy("user_name", "d", "problema")
            .agg(F.count(F.lit(1)).alias("n"), F.max(worst).alias("worst")))


def modes_of(per_problem: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, n_modes, mode)`` from counts per problem: at most one row per problem in each group."""
    top = per_problem.withColumn("top_n", F.max("n").over(Window.partitionBy(*keys)))
    is_mode = F.col("n") == F.col("top_n")
    return top.groupBy(*keys).agg(
        F.count_if(is_mode).alias("n_modes"), F.min(F.when(is_mode, F.col("problema"))).alias("mode"))


def chosen(worst: str) -> Column:
    return F.when(F.col("n_modes") > 1, F.col(f"{worst}.problema")).otherwise(F.col("mode"))


def user_problem_mode(rows: DataFrame, taxonomy: Taxonomy, days: int = DAYS, as_of: str | None = None,
                      key: Sequence[str] = ("comment_id", "sentence_idx")) -> DataFrame:
    """``(user_name, problema_30d, n_rows)``.

    The span ends at the user's last date (or ``as_of``), both ends included. Several most frequent
    problems: the problem of the user's most severe row, over all their rows and not only the span.
    """
    daily = staged(counted(rows, taxonomy, F.col("interaction_date"), key), "daily-problems")
    users = daily.groupBy("user_name").agg(
        F.max("d").alias("last"), F.max("worst").alias("worst"), F.count(F.lit(1)).alias("n_rows"),
        F.sum("n").alias("n_all"))
    if as_of:
        users = users.withColumn("last", F.lit(as_of).cast("timestamp"))
    span = F.expr(f"INTERVAL {int(days)} DAYS")
    recent = (attach(daily.where(F.col("problema").isNotNull()).drop("worst"), users, ["user_name"], ["last"],
                     row_id=["d", "problema"])
              .where(F.col("d").between(F.col("last") - span, F.col("last"))))
    modes = modes_of(recent.groupBy("user_name", "problema").agg(F.sum("n").alias("n")), ["user_name"])
    return (users.join(modes, "user_name", "left")
            .select("user_name", chosen("worst").alias("problema_30d"), F.col("n_all").alias("n_rows")))


def attach_user_problem(rows: DataFrame, modes: DataFrame, key: Sequence[str] = ("comment_id", "sentence_idx")) -> DataFrame:
    """The user's problem on each of their rows; rows without a user get NULL."""
    return attach(rows, modes, ["user_name"], ["problema_30d"], row_id=key)


def date_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Days from ``start`` up to, not including, ``end``; none if ``end`` is not later."""
    first, stop = F.lit(start).cast("date"), F.lit(end).cast("date")
    days = F.when(stop > first, F.sequence(first, F.date_sub(stop, 1)))
    return spark.range(1).select(F.explode(days).alias("day"))


def replay_problem_mode(rows: DataFrame, taxonomy: Taxonomy, start: str, end: str, days: int = DAYS,
                        key: Sequence[str] = ("comment_id", "sentence_idx")) -> DataFrame:
    """``problema_30d`` as it would stand after a run on each day of ``[start, end)``, without a day loop.

    A run on day D sets it for the rows dated ``[D - days, D]``. The last run to reach a row is on the
    earlier of its date plus ``days`` and the last day; only those (user, D) pairs are worked out. Each
    pair meets its dates through buckets of ``days + 1`` days, so a busy user is many small join keys.
    """
    width = days + 1
    last_day = F.date_sub(F.lit(end).cast("date"), 1)
    final_run = F.least(F.date_add("d", days), last_day)
    reached = (F.col("d") <= last_day) & (F.col("run") >= F.lit(start).cast("date"))
    bucket = lambda d: F.floor(F.unix_date(d) / width)

    daily = staged(counted(rows, taxonomy, F.to_date("interaction_date"), key).where(F.col("d").isNotNull()), "daily-problems")
    runs = (daily.withColumn("run", final_run).where(reached)
            .groupBy("user_name", "run").agg(F.sum("n").alias("n_rows")))
    in_buckets = runs.select("user_name", "run", F.explode(F.array_distinct(F.array(
        bucket(F.date_sub("run", days)), bucket(F.col("run"))))).alias("bucket"))
    pairs = (in_buckets.join(daily.withColumn("bucket", bucket(F.col("d"))), ["user_name", "bucket"])
             .where(F.col("d").between(F.date_sub("run", days), F.col("run"))))

    keys = ["user_name", "run"]
    per_problem = pairs.groupBy(*keys, "problema").agg(F.sum("n").alias("n"), F.max("worst").alias("worst"))
    modes = modes_of(per_problem.where(F.col("problema").isNotNull()), keys)
    worst = per_problem.groupBy(*keys).agg(F.max("worst").alias("worst"))
    results = (runs.join(worst, keys).join(modes, keys, "left")
               .select(*keys, chosen("worst").alias("problema_30d"), "n_rows"))

    dated = (rows.drop("problema_30d").withColumn("d", F.to_date("interaction_date")).withColumn("run", final_run)
             .withColumn("run", F.when(reached, F.col("run"))))
    return attach(dated, results, keys, ["problema_30d"], row_id=key).drop("d", "run")
