"""Counts of a cleaning run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from recado.functions import text as t
from recado.operators import sentences as s
from recado.plans.clean import CommentCounts, clean_tagged, clean_trace
from recado.profiles import LanguageProfile

# A comment's text stands beside each of its sentences: a dictionary per file keeps it once, and what does not fit is packed over whole pages.
TEXT_TABLE = {"compression": "zstd", "parquet.dictionary.page.size": str(32 * 1024 * 1024)}
REASONS = ("mention", "name", "mandatory", "blacklist", "blank")
OBSERVED = ("n_sentences", "n_small", "n_large", *(f"n_{r}" for r in REASONS), "n_kept")

# The stages whose vocabulary is reported: around the lemmas, and around the stems.
VOCABULARY_STAGES = {"length": "before_lemmas", "lemmas": "after_lemmas", "useless": "before_stems", "stems": "after_stems"}


def vocabulary_by_stage(df: DataFrame, profile: LanguageProfile) -> DataFrame:
    """Distinct words before and after lemmas and stems: ``(stage, n_words)``."""
    trace = clean_trace(df, profile, stages=VOCABULARY_STAGES)
    names = F.create_map(*[F.lit(x) for pair in VOCABULARY_STAGES.items() for x in pair])
    return s.vocabulary_report(trace.select(F.try_element_at(names, F.col("stage")).alias("stage"), "text"))


def clean_report(tagged: DataFrame) -> DataFrame:
    """Sentences per outcome, from a tagged table: ``(outcome, n)``."""
    return (tagged.groupBy(F.coalesce("reject_reason", F.lit("kept")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("n")))


def clean_and_count(df: DataFrame, profile: LanguageProfile, path: str, **options) -> dict[str, int | float | None]:
    """Clean into ``path``, as `plans.clean.clean_tagged` tags the sentences, and give the run's counts.

    The counts are taken by observers while the rows pass: comments and those that repeat another's text and user, rejected comments,
    sentences by length, those without a mandatory term or with a blacklisted one (and their share of the sentences of right length), blank
    ones, and those kept. Nothing is cleaned or read again for them. Percentages of nothing are None.
    """
    counts, rows = CommentCounts(), Observation()
    tagged = clean_tagged(df, profile, keep_length_rejects=True, counts=counts, with_texts=False, **options)
    reason, words = F.col("reject_reason"), t.word_count(F.col("text"))
    wrong = reason.eqNullSafe("length")
    observed = (F.col("sentence_idx").isNotNull(), wrong & (words < profile.lower_limit), wrong & (words > profile.upper_limit),
                *[reason.eqNullSafe(name) for name in REASONS], reason.isNull())
    tagged = tagged.observe(rows, *[F.count_if(x).alias(name) for x, name in zip(observed, OBSERVED, strict=True)])
    tagged.where(~reason.eqNullSafe("length")).write.options(**TEXT_TABLE).parquet(path)
    if df.where(F.col("text").isNotNull()).isEmpty():  # Spark leaves observers of a table that it knows to be empty out of the plan
        given, once, found = 0, 0, dict.fromkeys(OBSERVED, 0)
    else:
        given, once, found = counts.given.get["n"], counts.once.get["n"], dict(rows.get)
    medium = found["n_sentences"] - found["n_small"] - found["n_large"]
    return {"n_comments": given, "duplicate_pct": round(100 * (given - once) / given, 2) if given else None, **found, "n_medium": medium,
            "removed_pct": round(100 * (found["n_mandatory"] + found["n_blacklist"]) / medium, 1) if medium else None}
