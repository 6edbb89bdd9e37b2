"""Mixing sources to target weights: hash-random keys, a range sort within each source, prefix sums, a cut at the budget.

Key space is cut into ranges, more for larger sources, so a source with a third of all rows is sorted and summed by many
tasks: a running sum inside each range, plus the sum of the ranges before it. Only one row per source is ever brought
together, and one row per range to sum ranges up.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recado.sources.staging import staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)  # of sources in code point order, repeating
MOST_EPOCHS = 3
RANGE_ROWS = 20_000
SMALL_SOURCES = 100_000  # a plan of this many sources is some megabytes
SOURCE = ["_name", "_none"]
_KEY_DIGITS = 13  # hexadecimal digits of the key that choose its range


def n_words(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """``sources`` (source, n_rows, source_size) with ``target``: 100 % of all sizes shared by weight, at most ``most`` times
    a source's size; what is above that is shared again by weight, until nothing is.

    In the end every source has the lesser of its limit and (its weight x one common level). Sources fill up in the order
    of limit / weight, so the level follows from sums in that order, without repetition. One row per source is sorted here.
    """
    order = W.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    filling = W.orderBy(F.col("_limit") / F.col("_weight"), F.col("source").isNull(), "source")
    before = filling.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy()
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("_limit").over(before), F.lit(0.0))) / (
        F.sum("_weight").over(filling.rowsBetween(W.currentRow, W.unboundedFollowing)))
    return (sources.withColumn("_weight", weight).withColumn("_limit", F.col("source_size") * float(most))
            .withColumn("_level", level)
            # the level rises with each source that fills up and falls behind the first that does not
            .withColumn("_common", F.max("_level").over(whole))
            .withColumn("target", F.round(F.least(F.col("_limit"), F.col("_common") * F.col("_weight")), 6))
            .drop("_weight", "_limit", "_level", "_common"))


@dataclass(frozen=True)
class Plan:
    """Sized rows in the shared folder, and a row per source: how many whole passes, how many words of the next."""

    rows: DataFrame
    sources: DataFrame


def _key(row_id: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(row_id).cast("string"), F.lit(""))).cast("binary"))


def _named(df: DataFrame, source: str) -> DataFrame:
    return df.withColumns({"_name": F.coalesce(F.col(source), F.lit("")), "_none": F.col(source).isNull()})


def _with_sources(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with what their source has. Beyond ``SMALL_SOURCES`` counted rows the optimizer picks the join: it splits the
    partition of a large source, as neither side comes out of an aggregation."""
    small = sources.limit(SMALL_SOURCES + 1).count() <= SMALL_SOURCES
    return rows.join(F.broadcast(sources) if small else sources, SOURCE)


def plan(docs: DataFrame, seed: int = 0, row_id: str = "doc_id", source: str = "source", text: str = "text") -> Plan:
    """Sizes, keys, targets and budgets. Every text is read once."""
    rows = staged(_named(docs.select(
        F.col(row_id).alias("_id"), F.col(source).alias("_source"), _key(row_id, seed).alias("_key"),
        n_words(F.col(text)).alias("size"), F.xxhash64(F.col(text)).alias("_tie")), "_source").drop("_source"), "mix-rows")
    counted = rows.groupBy(*SOURCE).agg(F.count(F.lit(1)).alias("_rows"), F.sum("size").alias("source_size")).withColumn(
        "source", F.when(~F.col("_none"), F.col("_name")))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    sources = targets(counted).select(
        *SOURCE, "source_size", "target", passes.alias("_passes"),
        F.ceil(F.col("_rows") / RANGE_ROWS).cast("long").alias("_ranges"),
        (F.floor(F.col("target")).cast("long") - passes * F.col("source_size")).alias("_rest"))
    return Plan(rows, staged(sources, "mix-sources"))


def _summed(made: Plan) -> DataFrame:
    """Rows with ``_before``: the words that precede them in their source, in the order of the keys."""
    place = F.conv(F.substring("_key", 1, _KEY_DIGITS), 16, 10).cast("double") / float(16 ** _KEY_DIGITS)
    ranged = _with_sources(made.rows, made.sources).withColumn("_range", F.floor(place * F.col("_ranges")).cast("long"))
    offsets = ranged.groupBy(*SOURCE, "_range").agg(F.sum("size").alias("_sum")).select(
        *SOURCE, "_range", F.coalesce(F.sum("_sum").over(
            W.partitionBy(*SOURCE).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))
    inside = (W.partitionBy(*SOURCE, "_range").orderBy("_key", "_id", "size", "_tie")
              .rowsBetween(W.unboundedPreceding, W.currentRow))
    return (ranged.withColumn("_upto", F.sum("size").over(inside)).join(offsets, [*SOURCE, "_range"])
            .withColumn("_before", F.col("_offset") + F.col("_upto") - F.col("size")))


def mix(docs: DataFrame, seed: int = 0, row_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``row_id``, ``size`` (words), ``source_size``, ``target`` and ``taken`` words, a row for each row of ``docs``.

    A source's target is met by whole passes over it and, in the last pass, by its documents in the order of their random
    keys until the budget is used up: the document at the cut gives only as many words as are left, so each source's
    taken words equal its target rounded down. Keys come from the id and the seed alone, so reruns agree; rows with one id
    are ordered by size and text. A NULL source is a source, the last one; a NULL id or text is a value like others, and
    a NULL text has size 0. An empty table gives an empty result.
    """
    last = F.least(F.col("size"), F.greatest(F.lit(0), F.col("_rest") - F.col("_before")))
    return _summed(plan(docs, seed, row_id, source, text)).select(
        F.col("_id").alias(row_id), "size", "source_size", "target",
        (F.col("_passes") * F.col("size") + last).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, seed: int = 0, row_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The mix itself: a row of ``docs``, its columns as they are, for each pass that takes the document.

    The document at a source's cut ends, in the last pass, after the last word taken (``n_chars``, where there is such a
    column, counts what is left). Documents without words take no part. No text is shuffled: a source's cut is one
    place in the order of the keys, and every row is compared with it.
    """
    made = plan(docs, seed, row_id, source, text)
    at = F.struct("_key", "_id", "size", "_tie")
    cuts = staged(_summed(made).where((F.col("size") > 0) & (F.col("_before") < F.col("_rest"))).groupBy(*SOURCE).agg(
        F.max(at).alias("_cut"), F.max_by(F.col("_rest") - F.col("_before"), at).alias("_left")), "mix-cuts")
    sources = staged(made.sources.select(*SOURCE, "_passes").join(cuts, SOURCE, "left"), "mix-plan")
    rows = _with_sources(_named(docs.select(
        F.struct(*docs.columns).alias("_row"), F.col(source).alias("_source"), F.col(text).alias("_text"), _key(row_id, seed).alias("_key"),
        F.col(row_id).alias("_id"), n_words(F.col(text)).alias("size"), F.xxhash64(F.col(text)).alias("_tie")), "_source"), sources)
    last = F.when(at < F.col("_cut"), F.col("size")).when(at == F.col("_cut"), F.col("_left")).otherwise(0)
    copies = rows.where("size > 0").withColumn("_words", F.explode(F.filter(F.concat(
        F.array_repeat(F.col("size"), F.col("_passes").cast("int")), F.array(F.coalesce(last, F.lit(0)).cast("long"))), lambda n: n > 0)))
    cut = F.when(F.col("_words") < F.col("size"), F.array_join(F.slice(
        F.regexp_extract_all("_text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0)), F.lit(1), F.col("_words").cast("int")), "")
    ).otherwise(F.col("_text"))
    out = copies.withColumn("_text", cut)
    return out.select(*[F.col("_text").alias(c) if c == text else F.when(F.col("_words") < F.col("size"), F.length("_text").cast(
        docs.schema[c].dataType)).otherwise(F.col(f"_row.{c}")).alias(c) if c == "n_chars" else F.col(f"_row.{c}") for c in docs.columns])
