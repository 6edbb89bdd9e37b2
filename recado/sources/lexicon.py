"""Dictionaries ``(surface, pos, lemma)`` from files: plain tables, and tagged corpora in the CoNLL-U format."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = ("surface", "pos", "lemma")


def read_lexicon(spark: SparkSession, path: str, separator: str = "\t") -> DataFrame:
    """Files with a header that names surface, pos and lemma, in any order; more columns are left out. Entries with a NULL go, repeats are one."""
    found = spark.read.option("header", True).option("sep", separator).csv(path)
    missing = [x for x in COLUMNS if x not in found.columns]
    if missing:
        raise ValueError(f"a dictionary needs the columns {', '.join(COLUMNS)}; {path} lacks {', '.join(missing)}")
    return found.select(*COLUMNS).dropna().distinct()


def read_conllu(spark: SparkSession, path: str, least: int = 1) -> DataFrame:
    """The words of tagged sentences, in lower case as the cleaner looks them up, that occur ``least`` times or more with this tag and lemma.

    A word's line has ten columns: a whole number, form, lemma and tag first. Comments, empty lines, ranges of contracted words and empty
    nodes have no such number and are left out, as are lines without a lemma or tag (``_``), unless the word is the sign itself.
    """
    columns = F.split("value", "\t")
    lines = spark.read.text(path).select(columns.alias("c")).where((F.size("c") == 10) & F.col("c")[0].rlike("^[0-9]+$"))
    surface, lemma, pos = F.lower(F.col("c")[1]), F.lower(F.col("c")[2]), F.col("c")[3]
    words = lines.select(surface.alias("surface"), pos.alias("pos"), lemma.alias("lemma"))
    whole = words.where((F.col("surface") != "") & (F.col("pos") != "") & (F.col("pos") != "_") & ((F.col("lemma") != "_") | (F.col("surface") == "_")))
    return whole.groupBy(*COLUMNS).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select(*COLUMNS)
