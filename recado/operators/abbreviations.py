"""Sentence ends that are learnt: which words carry a stop that ends no sentence, from counts over the corpus.

After Kiss and Strunk (2006): a word is an abbreviation if it stands with a stop far more often than chance would have it, is short, has
stops inside, and hardly ever stands without its stop. All of it is one count of words and a few expressions on the counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recado.sources.staging import staged

WORD = r"(\p{L}(?:[\p{L}.]*\p{L})?)(\.?)"  # a word with stops inside, and the stop after it
#: Fixed values of the published method.
SURE = 0.99  # how often an abbreviation carries its stop
LEAST_SCORE = 0.3


def stop_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """``word`` (lower case), ``n_stop`` and ``n_plain``: how often it stands with a stop and without."""
    tokens = texts.where(F.col(text).isNotNull()).select(F.explode(F.split(F.lower(text), r"(?U)\s+")).alias("token"))
    words = tokens.select(F.regexp_extract("token", WORD, 1).alias("word"), (F.regexp_extract("token", WORD, 2) == ".").alias("stop"))
    return words.where("word <> ''").groupBy("word").agg(F.count_if("stop").alias("n_stop"), F.count_if(~F.col("stop")).alias("n_plain"))


def abbreviation_scores(counts: DataFrame) -> DataFrame:
    """``word``, ``n_stop``, ``n_plain`` and ``score`` of the words that ever carry a stop.

    The log-likelihood ratio of "stops fall on this word as on any" to "it nearly always has one", times e ** -letters, times stops
    inside + 1, times letters ** -n_plain.
    """
    counts = staged(counts, "stop-counts")
    totals = counts.agg(F.sum("n_stop").alias("stops"), F.sum(F.col("n_stop") + F.col("n_plain")).alias("words")).first()
    rows = counts.where("n_stop > 0")
    p = F.lit((totals["stops"] or 0) / max(1, totals["words"] or 0))
    stop, plain = F.col("n_stop").cast("double"), F.col("n_plain").cast("double")
    # a stop on every word of the corpus leaves no chance to compare with
    chance = stop * F.log(p) + F.when(plain > 0, plain * F.log(F.greatest(1 - p, F.lit(1e-300)))).otherwise(0.0)
    sure = stop * F.log(F.lit(SURE)) + plain * F.log(F.lit(1 - SURE))
    letters = F.length(F.replace("word", F.lit("."), F.lit(""))).cast("double")
    inside = F.length("word").cast("double") - letters
    score = 2 * (sure - chance) * F.exp(-letters) * (inside + 1) * F.pow(letters, -plain)
    return rows.select("word", "n_stop", "n_plain", score.alias("score"))


def learn_abbreviations(texts: DataFrame, text: str = "text", least: float = LEAST_SCORE) -> list[str]:
    """The corpus's abbreviations, without their last stop, for `LanguageProfile.abbreviations`: a word list, a configuration value."""
    found = abbreviation_scores(stop_counts(texts, text)).where(F.col("score") >= least)
    return [r["word"] for r in found.orderBy("word").select("word").collect()]
