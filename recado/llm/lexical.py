"""Ranked lexical search without an index: an automaton of all the items' terms is run over every text.

The terms of a block of items form one Aho-Corasick automaton. A text's separators become blanks and each term stands in the automaton
between two blanks, so it is found as a whole term only, in one pass over the text, however many terms there are. What the automaton
puts out is the number of a term; a table maps it to the items that hold it, and how often. The texts are run through
twice: once for how many documents hold each term, once for the scores; nothing is stored about a document in between.

Items come in blocks of about ``BLOCK_CHARS`` characters, so automaton and tables have a bounded size for any number of items; every
block is run over all texts. A task keeps the best ``k`` documents of each item and never a whole column of scores.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recado.llm.ranks import Best, first_rows
from recado.llm.words import buffer_of, by_batch, small_batches
from recado.operators.skew import broadcast_if_small
from recado.sources.staging import staged

BEST = 20
BLOCK_CHARS = 2_000_000  # of the items whose terms make one automaton, about
CELLS = 1 << 21  # scores (documents by items) worked out at once

#: Bytes as they are searched: separators as blanks, A-Z as a-z. All bytes beyond ASCII belong to terms.
PLAIN = np.full(256, 0x20, dtype=np.uint8)
for _part in (range(0x30, 0x3A), range(0x61, 0x7B), range(0x80, 0x100)):
    PLAIN[list(_part)] = list(_part)
PLAIN[0x41:0x5B] = np.arange(0x61, 0x7B)


def terms_of(text: str) -> list[str]:
    """Maximal runs of ASCII letters, digits and characters beyond ASCII, with A-Z in lower case."""
    return PLAIN[np.frombuffer(text.encode(), np.uint8)].tobytes().decode().split(" ") if text else []


class Automaton:
    """The terms of some items; ``items`` of a term and ``times`` it occurs in each, as parallel arrays cut at ``cuts``."""

    def __init__(self, texts: list[str]) -> None:
        numbers: dict[str, int] = {}
        pairs: list[tuple[int, int, int]] = []
        for item, text in enumerate(texts):
            for term, times in Counter(t for t in terms_of(text) if t).items():
                pairs.append((numbers.setdefault(term, len(numbers)), item, times))
        pairs.sort()
        self.terms, self.n_items = list(numbers), len(texts)
        term = np.array([p[0] for p in pairs], np.int64)
        self.items, self.times = np.array([p[1] for p in pairs], np.int64), np.array([p[2] for p in pairs], np.int64)
        self.cuts = np.searchsorted(term, np.arange(len(numbers) + 1))

    def searcher(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for number, term in enumerate(self.terms):
            found.add_word(f" {term} ", number)
        found.make_automaton()
        return found

    def counts(self, searcher: ahocorasick.Automaton, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Of each text: how many terms it has, the numbers of those that the automaton holds, and how often they occur."""
        data, ends = buffer_of(texts)
        plain = PLAIN[data]
        start = 0
        for end in ends.tolist():
            text = plain[start:end]
            start = end
            inside = text != 0x20
            n = int(inside[:1].sum()) + int((inside[1:] & ~inside[:-1]).sum())
            if not n or not self.terms:
                yield n, np.zeros(0, np.int64), np.zeros(0, np.int64)
                continue
            guarded = f" {text.tobytes().decode()} "
            hits = np.fromiter((number for _, number in searcher.iter(guarded)), np.int32)
            tf = np.bincount(hits, minlength=1)
            there = np.flatnonzero(tf)
            yield n, there, tf[there]


def statistics(docs: DataFrame, automaton) -> tuple[int, int, np.ndarray]:
    """How many documents have a term, how many terms all have, and how many documents hold each of the automaton's terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = automaton.value
        searcher, df, n_docs, n_terms = terms.searcher(), np.zeros(len(terms.terms), np.int64), 0, 0
        for batch in batches:
            for part in small_batches(batch, "text"):
                for n, there, _ in terms.counts(searcher, part.column("text")):
                    n_docs, n_terms = n_docs + (n > 0), n_terms + n
                    df[there] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, [-1, -2])), pa.array(np.append(df[at], [n_docs, n_terms]))], names=["term", "n"])

    found = by_batch(docs.select("text"), run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    sums = {r["term"]: r["n"] for r in found.collect()}  # a row for each term of the block
    terms = len(automaton.value.terms)
    return sums.get(-1, 0), sums.get(-2, 0), np.array([sums.get(t, 0) for t in range(terms)], np.int64)


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def scores(docs: DataFrame, automaton, k: int, n_docs: int, n_terms: int, weight) -> DataFrame:
    """``item`` (its number in the block), ``doc_id``, ``score``: the best documents that each task has for each item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, w = automaton.value, weight.value
        searcher, best = terms.searcher(), Best(terms.n_items, k)
        step = max(1, CELLS // max(1, terms.n_items))
        sizes = np.diff(terms.cuts)
        for batch in batches:
            for part in small_batches(batch, "text"):
                ids = part.column("doc_id")
                doc, unnamed = ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False)
                found = list(terms.counts(searcher, part.column("text")))
                for start in range(0, len(found), step):
                    some = found[start:start + step]
                    table = np.zeros((len(some), terms.n_items), np.int64)
                    for row, (n, there, tf) in enumerate(some):
                        if not len(there):
                            continue
                        m = 100 - 25 + (25 * n * n_docs) // n_terms
                        gain = w[there] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
                        times = sizes[there]
                        at = np.repeat(terms.cuts[there] - np.cumsum(times) + times, times) + np.arange(times.sum())
                        np.add.at(table[row], terms.items[at], np.repeat(gain, times) * terms.times[at])
                    row, item = np.nonzero((table > 0) & (table >= best.least))
                    best.add(item, doc[start + row], unnamed[start + row], table[row, item])
        item, doc, unnamed, score = best.cut()
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(doc, mask=unnamed), pa.array(score)], names=["item", "doc_id", "score"])

    return by_batch(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "item long, doc_id long, score long")


def ranked(documents: DataFrame, items: DataFrame, k: int = BEST, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: each item's ``k`` best documents with a score above 0.

    ``items`` has ``item_id`` and ``text``, ``documents`` has ``doc_id`` and ``text``; other columns are ignored. Of items that share an id
    (or have none) the smallest text counts. A document without text or terms is found by nothing and counts in no statistic; a
    repeated row is a document of its own; one without an id counts and comes last among equals. Empty
    tables give no rows. A text is held whole by one task, in some five bytes a byte.
    """
    spark = documents.sparkSession
    asked = items.where(F.col("text").isNotNull()).groupBy("item_id").agg(F.min("text").alias("text"))
    size = asked.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_chars))
    asked = staged(asked.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks))), "items")
    named = T.StructType([T.StructField("item", T.LongType()), asked.schema["item_id"]])
    docs = documents.select("doc_id", "text")
    found = []
    for block in range(blocks):
        rows = asked.where(F.col("block") == block).select("item_id", "text").collect()  # about block_chars characters
        automaton = spark.sparkContext.broadcast(Automaton([r["text"] for r in rows]))
        n_docs, n_terms, df = statistics(docs, automaton)
        weight = spark.sparkContext.broadcast(weights(n_docs, df))
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], named)
        best = scores(docs, automaton, k, n_docs, max(1, n_terms), weight)
        found.append(best.join(broadcast_if_small(names), "item").select("item_id", "doc_id", "score"))
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    return first_rows(best, ["item_id"], order, k, ["doc_id"]).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")

