"""Arriving comment files: cleaned and labelled as they come, over any number of batches and runs.

What can be read afterwards hangs on the comments that have arrived and not on how files were cut into batches or runs. Nothing is
dropped for being late: an earlier copy of a comment takes the place of a later one whenever it comes. All tables are logs
(`logs`); a batch reads the rows of the texts, users and posts that it touches and adds its own:

- ``comments``: the earliest comment of each text and user; the smallest row of a key stands, so nothing need be replaced
- ``posts``: how many such comments a post has on each date, more and less; the first date with any is its publish date
- ``texts``, ``sentences``, ``labels``: each text once, cleaned and labelled when it first comes
- ``rows``: the labelled row of each text; ``modes``: each user's recent problem; ``done``: up to where results have been made
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from recado.operators import comments as c
from recado.operators import labels as lb
from recado.operators import modes as m
from recado.operators.skew import attach, broadcast_if_small
from recado.operators.tags import ContextLexicon
from recado.plans.clean import COMMENT_COLUMNS, TASK_TEXT_BYTES, narrow_comments, tagged_sentences
from recado.profiles import LanguageProfile, Taxonomy
from recado.sources.files import BAD_RECORD, as_comments, stream_comments
from recado.sources.staging import scratch_scope, staged
from recado.sources.store import replace_texts
from recado.streaming import logs

KEY = ("text_key", "user_name")
TEXTS = "text_key string, original_text string"
SENTENCES = "text_key string, sentence_idx int, reject_reason string, text string"
LABELS = "text_key string, sentence_idx int, cluster string, problema string, size long"
POSTS = "post string, interaction_date timestamp, n long"
HOT_COMMENTS = 10_000
MODES = "user_name string, problema_30d string"


def arriving_comments(spark: SparkSession, path: str, dialect: str = "infer", files_per_batch: int = 100) -> DataFrame:
    """Comments of arriving files, as they come."""
    return as_comments(stream_comments(spark, path, dialect, files_per_batch))


def arriving_bad_records(spark: SparkSession, path: str, dialect: str = "infer", files_per_batch: int = 100) -> DataFrame:
    """Records that do not fit their file's header, for a stream of their own."""
    return stream_comments(spark, path, dialect, files_per_batch).where(F.col(BAD_RECORD).isNotNull())


def run_available(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Process every file that is there, then stop."""
    query = (stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def ranked_against_stored(new: DataFrame, stored: DataFrame) -> DataFrame:
    """The earliest of ``new`` and the stored rows of the same keys: ``_new`` says where a row is from, ``_rank`` 1 that it stands."""
    old = c.dedupe_comments(logs.of_keys(stored, new.select(*KEY)).drop("batch"))
    both = old.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)))
    order = W.partitionBy(*KEY).orderBy("interaction_date", "comment_id", *c.TIES, "_new")
    return both.withColumn("_rank", F.row_number().over(order))


def _changes(batch: DataFrame, root: str, number: int, network: str | None, strict_dates: bool) -> DataFrame:
    """Write the batch's comments that stand, and what they change in their posts; the former."""
    spark = batch.sparkSession
    new = c.dedupe_comments(narrow_comments(batch, strict_dates)).withColumn("post", c.post_url(F.col("url"), network))
    stored = logs.read(spark, f"{root}/comments", new.schema, upto=number - 1)
    ranked = staged(ranked_against_stored(new, stored), "ranked-comments")
    changed = ranked.where("_new AND _rank = 1").drop("_new", "_rank")
    beaten = ranked.where("NOT _new AND _rank = 2").select("post", "interaction_date", F.lit(-1).alias("n"))
    deltas = changed.select("post", "interaction_date", F.lit(1).alias("n")).unionByName(beaten)
    logs.append(changed, f"{root}/comments", number)
    logs.append(deltas.groupBy("post", "interaction_date").agg(F.sum("n").alias("n")).where("n <> 0"), f"{root}/posts", number)
    return changed


def ingest_comments(stream: DataFrame, profile: LanguageProfile, root: str, checkpoint: str, network: str | None = None,
                    label: Callable[[DataFrame], DataFrame] | None = None, lexicon: DataFrame | ContextLexicon | None = None,
                    strict_dates: bool = True, rejected: str | None = None) -> StreamingQuery:
    """Bring the logs under ``root`` up to what has arrived. ``label`` (`plans.classify.label_tagged`) also names the sentences.

    A text is cleaned when it first comes, whoever sends it. Without ``strict_dates`` comments with a bad date are left out
    and written to the table ``rejected``. One stream writes to a root.
    """
    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        with scratch_scope(spark):
            df = staged(df, "arrived")
            changed = _changes(df, root, number, network, strict_dates)
            touched = staged(changed.select("text_key").distinct(), "touched-texts")
            known = logs.of_keys(logs.read(spark, f"{root}/texts", TEXTS, upto=number - 1), touched).select("text_key")
            fresh = touched.join(known, "text_key", "left_anti")
            texts = c.with_text_key(c.drop_null_text(df).select("text")).join(fresh, "text_key", "left_semi").dropDuplicates(["text_key"])
            texts = texts.select("text_key", F.col("text").alias("original_text"))
            logs.append(texts, f"{root}/texts", number)
            texts = logs.read(spark, f"{root}/texts", texts.schema, after=number - 1, upto=number).drop("batch")
            sentences = tagged_sentences(texts, profile, lexicon=lexicon).drop("original_text")
            logs.append(sentences, f"{root}/sentences", number)
            if label:
                logs.append(label(logs.read(spark, f"{root}/sentences", SENTENCES, after=number - 1, upto=number).drop("batch")),
                            f"{root}/labels", number)
            if rejected and not strict_dates:
                c.bad_dates(df).write.mode("overwrite").parquet(f"{rejected}/batch={number}")

    return run_available(stream, batch, checkpoint)


def _comment_schema(spark: SparkSession, root: str) -> T.StructType | None:
    """Columns of the log ``comments``; None where no batch has been written."""
    try:
        return T.StructType([f for f in spark.read.parquet(f"{root}/comments").schema if f.name != "batch"])
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def standing_comments(spark: SparkSession, root: str) -> DataFrame:
    """The comments that stand, each with its post's address as ``url`` and its publish date."""
    rows = c.dedupe_comments(logs.read(spark, f"{root}/comments", _comment_schema(spark, root)).drop("batch"))
    days = logs.read(spark, f"{root}/posts", POSTS).groupBy("post", "interaction_date").agg(F.sum("n").alias("n")).where("n > 0")
    posts = days.groupBy(F.col("post").alias("url")).agg(F.min("interaction_date").alias("publish_date"), F.sum("n").alias("n_rows"))
    dated = attach(rows.drop("url").withColumnRenamed("post", "url"), posts, ["url"], ["publish_date"], row_id=["comment_id"])
    return dated.select(*COMMENT_COLUMNS, "publish_date", "text_key")


def ingested_sentences(spark: SparkSession, root: str) -> DataFrame:
    """What `plans.clean.clean_tagged` gives for all comments that have arrived.

    A text stands beside each of its sentences, and a Parquet file keeps it once as long as its dictionary holds all texts of the task. So
    there is a task for each `TASK_TEXT_BYTES` of texts, and a text's rows are together. A text of over `HOT_COMMENTS` comments is dealt out.
    """
    rows = staged(standing_comments(spark, root), "standing-comments")
    key = F.col("text_key").cast("binary")  # of one type everywhere, or the join would deal the rows out again
    rows, texts, sentences = (df.withColumn("text_key", key) for df in (rows, *(
        logs.read(spark, f"{root}/{name}", schema).drop("batch") for name, schema in (("texts", TEXTS), ("sentences", SENTENCES)))))
    n_bytes = texts.agg(F.sum(F.octet_length("original_text"))).first()[0] or 0
    hot = (rows.groupBy("text_key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_COMMENTS)
           .select("text_key", (1 + F.floor(F.col("n") / HOT_COMMENTS)).cast("int").alias("_ways")))
    hot = broadcast_if_small(staged(hot, "hot-texts"))

    def dealt(df: DataFrame, way: Callable[[Column], Column]) -> DataFrame:
        salted = df.join(hot, "text_key", "left").withColumn("_way", way(F.coalesce("_ways", F.lit(1)))).drop("_ways")
        return salted.repartition(1 + n_bytes // TASK_TEXT_BYTES, "text_key", "_way")

    of_row, all_ways = lambda n: F.pmod(F.xxhash64("comment_id"), n).cast("int"), lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    joined = dealt(rows, of_row).join(dealt(texts, all_ways), ["text_key", "_way"]).join(dealt(sentences, all_ways), ["text_key", "_way"])
    return joined.select(*COMMENT_COLUMNS, "publish_date", "original_text", "sentence_idx", "reject_reason", "text")


def _labelled_rows(spark: SparkSession, root: str, touched: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    """One labelled row for each touched text that has sentences, from all comments that hold it."""
    log = logs.read(spark, f"{root}/comments", _comment_schema(spark, root))
    holders = staged(c.dedupe_comments(logs.of_keys(log, touched).drop("batch")), "comments-of-texts")
    labels = logs.of_keys(logs.read(spark, f"{root}/labels", LABELS), touched).drop("batch")
    rows = holders.drop("url").withColumnRenamed("post", "url").join(labels, "text_key")
    return staged(lb.label_comments(staged(rows, "labelled-sentences"), taxonomy), "labelled-texts")


def update_results(spark: SparkSession, root: str, taxonomy: Taxonomy, store: str, days: int = m.DAYS) -> None:
    """Bring the stored results up to date with the batches that came since the last time.

    A batch touches texts. A text's label and row hang on all comments that hold it; a user's recent problem on the rows of
    that user. So the touched texts get their rows anew, the users who had or now have them their problem anew, and what differs is written: rows
    of touched texts, rows of users whose problem changed. The dates of these rows, old and new, are rewritten in the store; no other
    is read. A text's row may pass from one user to another: the log then says that the former has lost it.
    """
    done = logs.read(spark, f"{root}/done", "upto long").agg(F.max("upto")).first()[0]
    done = -1 if done is None else done
    schema = _comment_schema(spark, root)
    if schema is None:
        return
    changed = logs.read(spark, f"{root}/comments", schema, after=done)
    upto = changed.agg(F.max("batch")).first()[0]
    if upto is None:
        return
    with scratch_scope(spark):
        touched = staged(changed.select("text_key").distinct(), "touched-texts")
        new = _labelled_rows(spark, root, touched, taxonomy)
        log = new.withColumn("gone", F.lit(False)).schema
        stored = logs.read(spark, f"{root}/rows", log, upto=done)
        old = staged(logs.latest(logs.of_keys(stored, touched), KEY).where("NOT gone").drop("batch"), "rows-before")
        stays = new.select(F.col("text_key").alias("_text"), F.col("user_name").alias("_user"))
        lost = old.join(stays, (F.col("text_key") == F.col("_text")) & F.col("user_name").eqNullSafe(F.col("_user")), "left_anti")
        logs.append(new.withColumn("gone", F.lit(False)).unionByName(lost.withColumn("gone", F.lit(True))), f"{root}/rows", upto)

        named = lambda rows: rows.where("user_name IS NOT NULL").select("user_name")
        users = staged(named(new).unionByName(named(old)).distinct(), "touched-users")
        rows = logs.read(spark, f"{root}/rows", log, upto=upto)
        theirs = staged(logs.latest(logs.of_keys(rows, users), KEY).where("NOT gone").drop("batch", "gone"), "rows-of-users")
        modes = staged(m.user_problem_mode(theirs, taxonomy, days), "modes")
        before = logs.latest(logs.of_keys(logs.read(spark, f"{root}/modes", MODES, upto=done), users), ["user_name"])
        same = before.select("user_name", F.col("problema_30d").alias("_was"))
        differs = staged(modes.join(same, "user_name", "left").where(~F.col("problema_30d").eqNullSafe(F.col("_was")) | F.col("_was").isNull())
                         .select("user_name", "problema_30d"), "modes-that-differ")
        logs.append(differs, f"{root}/modes", upto)

        again = theirs.join(differs.select("user_name"), "user_name", "left_semi").join(touched, "text_key", "left_anti")
        write = staged(new.unionByName(again.select(*new.columns)), "rows-to-write")
        texts = logs.of_keys(logs.read(spark, f"{root}/texts", TEXTS), write.select("text_key")).drop("batch")
        results = lb.finish_results(m.attach_user_problem(write, modes).join(texts, "text_key"))
        replace_texts(results, old.select(F.to_date("interaction_date").alias("interaction_date")), store)
        logs.append(spark.createDataFrame([(upto,)], "upto long"), f"{root}/done", upto)


def ingest_results(stream: DataFrame, profile: LanguageProfile, label: Callable[[DataFrame], DataFrame], taxonomy: Taxonomy, root: str,
                   store: str, checkpoint: str, network: str | None = None, days: int = m.DAYS, **options) -> StreamingQuery:
    """Label what has arrived, then bring the results up to date."""
    query = ingest_comments(stream, profile, root, checkpoint, network, label, **options)
    update_results(stream.sparkSession, root, taxonomy, store, days)
    return query
