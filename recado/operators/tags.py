"""Parts of speech from neighbours: a dictionary says what a word may be, a model of tag pairs says what it is here.

The model is learnt from the corpus itself, from neighbours that can be one thing only (Markov chain of tags, counts plus one). A sentence's
tags are its cheapest path, worked out by a fold over its words. Costs are whole thousandths, so equal paths are equal on every machine.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recado.profiles import LEMMATISED

EDGE, UNKNOWN = "", "?"  # before and after a sentence; a word that the dictionary does not have
MOST_TAGS = 64  # a tag set is a scheme that a dictionary's makers chose; more is a wrong column
OPTION = "struct<tag:int,lemma:string>"


@dataclass(frozen=True)
class TagModel:
    """The tags, `EDGE` first, and the cost of each following each: minus the logarithm of its share, in thousandths."""

    tags: tuple[str, ...]
    costs: tuple[int, ...]  # of tag j after tag i at i * len(tags) + j

    def to_json(self) -> str:
        return json.dumps({"tags": self.tags, "costs": self.costs}, ensure_ascii=False)

    @staticmethod
    def from_json(text: str) -> TagModel:
        read = json.loads(text)
        return TagModel(tuple(read["tags"]), tuple(read["costs"]))


@dataclass(frozen=True)
class ContextLexicon:
    """A dictionary table ``(surface, pos, lemma)`` with the model that chooses among a surface's entries."""

    entries: DataFrame
    model: TagModel


def tags_of(lexicon: DataFrame) -> tuple[str, ...]:
    """`EDGE`, `UNKNOWN` and the dictionary's tags, in code point order."""
    found = [r["pos"] for r in lexicon.where(F.col("pos").isNotNull()).select("pos").distinct().limit(MOST_TAGS + 1).collect()]
    if len(found) > MOST_TAGS:
        raise ValueError(f"the dictionary has more than {MOST_TAGS} parts of speech")
    return (EDGE, UNKNOWN, *sorted(set(found) - {EDGE, UNKNOWN}))


def surface_options(lexicon: DataFrame, tags: tuple[str, ...], exempt: tuple[str, ...] = ()) -> DataFrame:
    """``surface`` and ``options``: each tag it may have, once, with the word that it then becomes.

    That is the smallest lemma for verbs, adjectives and nouns that are not exempt, else the surface. Entries without a surface or
    tag are left out; without a lemma the word stays.
    """
    number = F.array_position(F.array(*[F.lit(x) for x in tags]), F.col("pos")) - 1
    known = lexicon.where(F.col("surface").isNotNull() & F.col("pos").isin(*tags) & ~F.col("pos").isin(EDGE, UNKNOWN))
    changes = F.col("pos").isin(*LEMMATISED) & ~F.col("surface").isin(*exempt)
    entries = known.select("surface", number.cast("int").alias("tag"), F.when(changes, F.col("lemma")).alias("lemma"))
    one = entries.groupBy("surface", "tag").agg(F.min("lemma").alias("lemma"))
    option = F.struct("tag", F.coalesce("lemma", "surface").alias("lemma"))
    return one.groupBy("surface").agg(F.sort_array(F.collect_list(option)).alias("options"))


def word_options(words: Column, looked_up: Column) -> Column:
    """The options of each word, from a map of the known ones. Others, and the gaps that removed words left, can be `UNKNOWN` only."""
    return F.transform(words, lambda w: F.coalesce(
        F.try_element_at(looked_up, w), F.array(F.struct(F.lit(1).alias("tag"), w.alias("lemma")))))


def tag_pairs(sentences: DataFrame, options: str) -> DataFrame:
    """``before``, ``after``, ``n``: how often tags follow each other, among neighbours with one option each, edges included.

    Pairs are taken inside the row and counted before the shuffle, which has at most 66 * 66 keys.
    """
    one = F.transform(options, lambda o: F.when(F.size(o) == 1, o[0]["tag"]))
    edge = F.array(F.lit(0))
    framed = sentences.select(F.concat(edge, one, edge).alias("_tags"))
    pairs = framed.select(F.explode(F.arrays_zip(
        F.expr("slice(_tags, 1, size(_tags) - 1)").alias("before"), F.expr("slice(_tags, 2, size(_tags) - 1)").alias("after"))).alias("p"))
    return pairs.select("p.*").where("before IS NOT NULL AND after IS NOT NULL").groupBy("before", "after").agg(F.count(F.lit(1)).alias("n"))


def tag_model(pairs: Iterable[tuple[int, int, int]], tags: tuple[str, ...]) -> TagModel:
    """Costs from counted pairs ``(before, after, n)``: at most a square of `MOST_TAGS` and the two others."""
    size = len(tags)
    counts = [0] * (size * size)
    for before, after, n in pairs:
        counts[before * size + after] += n
    costs = []
    for i in range(size):
        row = counts[i * size:(i + 1) * size]
        costs += [round(1000 * math.log((sum(row) + size) / (n + 1))) for n in row]
    return TagModel(tags, tuple(costs))


def best_words(options: Column, model: TagModel) -> Column:
    """What each word becomes on the cheapest path of tags; of equal paths, the one whose tags come first.

    A fold that keeps the best path to each option of the last word, so its work grows with words times the square of the options
    of one, and what it copies with the square of the words: for sentences, which the length rule bounds, not whole texts. A sentence
    without a word that could become one of two has no path to choose.
    """
    size = len(model.tags)
    costs = F.lit(list(model.costs)).cast("array<bigint>")

    def cost(state: Column, tag: Column) -> Column:
        return state["cost"] + F.get(costs, F.element_at(state["path"], -1)["tag"] * size + tag)

    edge = F.array(F.struct(F.lit(0).alias("tag"), F.lit("").alias("lemma"))).cast(f"array<{OPTION}>")
    start = F.array(F.struct(F.lit(0).cast("bigint").alias("cost"), edge.alias("path")))

    def step(states: Column, word: Column) -> Column:
        return F.transform(word, lambda o: F.array_min(F.transform(states, lambda s: F.struct(
            cost(s, o["tag"]).alias("cost"), F.concat(s["path"], F.array(o)).alias("path")))))

    folded = F.aggregate(options, start, step, lambda states: F.array_min(F.transform(
        states, lambda s: F.struct(cost(s, F.lit(0)).alias("cost"), s["path"].alias("path")))))
    chosen = F.transform(folded["path"], lambda o: o["lemma"])
    several = F.exists(options, lambda o: F.exists(o, lambda x: x["lemma"] != o[0]["lemma"]))
    return F.when(several, F.slice(chosen, F.lit(2), F.size(options))).otherwise(F.transform(options, lambda o: o[0]["lemma"]))
