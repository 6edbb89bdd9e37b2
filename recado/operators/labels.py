"""One label per comment from its sentences' clusters.

Rows are sentences with ``comment_id``, ``sentence_idx``, ``user_name``, ``interaction_date``,
``original_text``, and from the look-up ``cluster``, ``problema`` and ``size``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recado.functions import text as t
from recado.operators.skew import SMALL_BYTES, attach, broadcast_if_small
from recado.profiles import Taxonomy
from recado.sources.files import RESULT_COLUMNS

GROUP = ("user_name", "text_key", "sentimento")
ROW = ("comment_id", "sentence_idx")


def constant_map(pairs: Sequence[tuple[object, object]]) -> Column:
    """A configuration table of a few dozen entries, as a constant."""
    return F.create_map(*[F.lit(x) for pair in pairs for x in pair])


def with_text_key(rows: DataFrame) -> DataFrame:
    if "text_key" in rows.columns:
        return rows
    return rows.withColumn("text_key", t.text_key(F.col("original_text")))


def join_lookup(sentences: DataFrame, lookup: DataFrame) -> DataFrame:
    return sentences.join(broadcast_if_small(lookup, max_bytes=SMALL_BYTES), "subclusters_id")


def append_rejected(labelled: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rejected rows under the labelled ones, with NULL where they lack a column."""
    return labelled.unionByName(rejected, allowMissingColumns=True).select(*labelled.columns)


def add_sentiment(rows: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    """Sentiment of the label; no label is "unknown", a label in no list stays NULL."""
    table = constant_map(taxonomy.label_sentiments())
    return rows.withColumn("sentimento", F.when(F.col("cluster").isNull(), taxonomy.unknown_sentiment)
                           .otherwise(F.try_element_at(table, F.col("cluster"))))


def severity(taxonomy: Taxonomy) -> Column:
    """0 for the least important sentiment; NULL for none."""
    return F.try_element_at(constant_map([(s, i) for i, s in enumerate(taxonomy.severity)]), F.col("sentimento"))


def comment_label_mode(rows: DataFrame) -> DataFrame:
    """Most frequent label per user, text and sentiment.

    Several most frequent ones: the label of the largest cluster in the whole group, even one that is
    not among them. Labels that are NULL are not counted; NULL keys form no group.
    """
    keyed = with_text_key(rows).dropna(subset=list(GROUP))
    per_label = keyed.groupBy(*GROUP, "cluster").agg(
        F.count(F.lit(1)).alias("n"), F.max("size").alias("size"))
    counted = F.when(F.col("cluster").isNotNull(), F.col("n"))
    ranked = per_label.withColumn("top_n", F.max(counted).over(Window.partitionBy(*GROUP)))
    is_mode = counted == F.col("top_n")
    modes = ranked.groupBy(*GROUP).agg(
        F.count_if(is_mode).alias("n_modes"),
        F.min(F.when(is_mode, F.col("cluster"))).alias("mode"),
        F.max(F.struct("size", "cluster")).alias("largest"),
        F.sum("n").alias("n_rows"))
    return modes.select(
        *GROUP, F.when(F.col("n_modes") > 1, F.col("largest.cluster")).otherwise(F.col("mode")).alias("cluster_mode"),
        "n_rows")


def apply_label_mode(rows: DataFrame, modes: DataFrame) -> DataFrame:
    """Each row's label replaced by its group's; the problem stays as it was."""
    keyed = with_text_key(rows)
    joined = attach(keyed, modes, GROUP, ["cluster_mode"], row_id=ROW)
    return joined.drop("cluster").withColumnRenamed("cluster_mode", "cluster").select(*keyed.columns)


def one_row_per_comment(rows: DataFrame, taxonomy: Taxonomy, per_user: bool = False) -> DataFrame:
    """The most severe row per text, then the largest cluster; rows without a size come first.

    ``per_user`` keeps one per text and user. Each map task keeps one row per key before the shuffle.
    """
    keyed = with_text_key(rows).withColumn("_severity", severity(taxonomy))
    key = ["text_key", "user_name"] if per_user else ["text_key"]
    order = Window.partitionBy(*key).orderBy(
        F.col("_severity").desc_nulls_first(), F.col("size").desc_nulls_first(), *[F.col(c).asc_nulls_first() for c in ROW])
    return (keyed.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") == 1)
            .drop("_rank", "_severity"))


def null_sentinels(rows: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    return (rows.withColumn("sentimento", F.nullif(F.col("sentimento"), F.lit(taxonomy.unknown_sentiment)))
            .withColumn("cluster", F.nullif(F.col("cluster"), F.lit(taxonomy.unknown_label))))


def realign_problem(rows: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    """The problem of the final label, for those who do not want the sentence's own."""
    first = {label: p for p, _, label in reversed(taxonomy.problem_labels())}
    return rows.withColumn("problema", F.try_element_at(constant_map(list(first.items())), F.col("cluster")))


def label_comments(rows: DataFrame, taxonomy: Taxonomy, per_user: bool = False) -> DataFrame:
    """Sentiment, label mode, one row per text, sentinels blanked.

    The row that stays depends on sentiment and size only, so rows are cut to one per text first and the
    mode is joined to those: the join key is then unique and no group can be hot.
    """
    keyed = with_text_key(add_sentiment(rows, taxonomy))
    modes = comment_label_mode(keyed).drop("n_rows")
    chosen = one_row_per_comment(keyed, taxonomy, per_user).drop("cluster")
    labelled = (chosen.join(modes, list(GROUP), "left")
                .withColumnRenamed("cluster_mode", "cluster").select(*keyed.columns))
    return null_sentinels(labelled, taxonomy)


def finish_results(rows: DataFrame) -> DataFrame:
    """Order number, date without time, and the ten result columns in order."""
    text = F.coalesce("original_text", F.lit(""))
    if "content_type" not in rows.columns:
        rows = rows.withColumn("content_type", F.lit(None).cast("string"))
    return (rows.withColumn("original_text", text)
            .withColumn("order_number", t.order_number(F.col("original_text")))
            .withColumn("interaction_date", F.to_date("interaction_date"))
            .select(*RESULT_COLUMNS))
