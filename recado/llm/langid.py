"""Language identification, words first: a known word scores by its frequency in each language, an unseen one by its parts.

The model holds, for each language, logarithms of the relative frequencies of words and of character n-grams inside words (a word's
ends are marked). A word that the model knows in any language scores by its word frequencies. Else its n-grams of ``LONGEST``
characters are looked up, then shorter ones, down to single characters: the longest size at which any is known decides, and
the word scores their mean. A language that lacks a known word or n-gram gets ``MISSING``. A text's score is the mean over its words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recado.llm.ranks import first_rows
from recado.llm.words import by_batch
from recado.sources.staging import staged

LONGEST = 6  # characters of an n-gram, the marked ends included
SAMPLE = 8_000  # texts of a language that the model learns from, about
ENTRIES = 20_000  # words of a language in the model, and n-grams of each size, where CELLS allows
LANGUAGES = 200  # languages in the model at most, those with most texts
CELLS = 1 << 24  # numbers in the model (keys by languages) at most: 64 MB are broadcast
MISSING = -16.0  # natural logarithm
LONG_WORD = 60  # characters; longer words are not learnt as words (they are scored by n-grams, whole)
PIECE = 1 << 20  # characters of a text worked on at once
CACHE = 1 << 22  # numbers that a task keeps for unseen words, about
EVIDENCE = 12.0  # words that the score counts a text's mean for, at most
NONE = "und"

WORD = regex.compile(r"\p{L}+")
NO_LETTER = regex.compile(r"\P{L}")


def held_out(doc_id: Column | str) -> Column:
    """Rows never learnt from: crc32 of the id as text, modulo 4, is 2. A NULL id counts as empty text."""
    text = F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 4 == 2


def words_in(text: str | None) -> Iterator[list[str]]:
    """Runs of letters in lower case, a piece of the text at a time; pieces end between words."""
    start, text = 0, text or ""
    while start < len(text):
        stop = start + PIECE
        if stop < len(text):
            found = NO_LETTER.search(text, stop)
            stop = found.start() if found else len(text)
        yield WORD.findall(text[start:stop].lower())
        start = stop


def grams(word: str, size: int) -> Iterator[str]:
    """N-grams of a word between its marks; for size 1 the characters alone."""
    marked = word if size == 1 else f"<{word}>"
    return (marked[i:i + size] for i in range(len(marked) - size + 1))


def learnable(documents: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``lang`` and ``text`` of about ``sample`` texts of each language, chosen by a hash of id and text; copies count once."""
    rows = documents.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out("doc_id")).select("doc_id", "lang", "text")
    n = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("_n")).orderBy(F.col("_n").desc(), "lang").limit(LANGUAGES)
    share = F.pmod(F.xxhash64("doc_id", "text", F.lit(13)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.join(F.broadcast(n), "lang").where(share * F.col("_n") < sample).select("lang", "text")


def counted(texts: DataFrame, entries: int = ENTRIES) -> DataFrame:
    """``size`` (0: a word), ``key``, ``lang``, ``n``, ``total`` of all such in the language: the model's rows.

    The ``entries`` most frequent of each language and size, or fewer where all of them by all languages would pass ``CELLS``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, Counter] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                count = seen.setdefault(lang, Counter())
                for words in words_in(text):
                    count.update(words)
            for lang, count in seen.items():
                kept = {w: n for w, n in count.items() if len(w) <= LONG_WORD}
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(kept), pa.string()), pa.array(kept.keys(), pa.string()),
                                                  pa.array(kept.values(), pa.int64())], names=["lang", "key", "n"])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count: Counter = Counter()
            for lang, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for size in range(1, LONGEST + 1):
                    for gram in grams(word, size):
                        count[lang, size, gram] += n
            yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in count], t) for i, t in enumerate((pa.string(), pa.int32(), pa.string()))]
                                             + [pa.array(count.values(), pa.int64())], names=["lang", "size", "key", "n"])

    words = staged(by_batch(texts, run, "lang string, key string, n long").groupBy("lang", "key").agg(F.sum("n").alias("n")), "language-words")
    parts = by_batch(words, split, "lang string, size int, key string, n long").groupBy("lang", "size", "key").agg(F.sum("n").alias("n"))
    rows = staged(parts.unionByName(words.withColumn("size", F.lit(0))), "language-parts")
    totals = staged(rows.groupBy("lang", "size").agg(F.sum("n").alias("total")), "language-totals")
    languages = max(1, totals.select("lang").distinct().count())
    entries = max(1, min(entries, CELLS // ((LONGEST + 1) * languages ** 2)))
    first = first_rows(rows, ["lang", "size"], [F.col("n").desc(), F.col("key")], entries, ["key"]).drop("rank")
    return first.join(F.broadcast(totals), ["lang", "size"])  # a row a language and size: 1,400 at most


class Model:
    """Languages, and for words (0) and n-grams by size a row of logarithms for each key."""

    def __init__(self, table: pa.Table) -> None:
        self.languages = sorted(set(table["lang"].to_pylist()))
        at = {lang: i for i, lang in enumerate(self.languages)}
        self.rows: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
        rows = []
        for size, key in zip(table["size"].to_pylist(), table["key"].to_pylist(), strict=True):
            rows.append(self.rows[size].setdefault(key, sum(map(len, self.rows))))
        self.logs = np.full((sum(map(len, self.rows)), len(self.languages)), MISSING, np.float32)
        self.logs[rows, [at[lang] for lang in table["lang"].to_pylist()]] = np.log(table["n"].to_numpy() / table["total"].to_numpy())

    def unseen(self, word: str) -> np.ndarray:
        """Scores of a word that no language has: by the longest n-grams of which any is known."""
        for size in range(min(LONGEST, len(word) + 2), 0, -1):
            known, total, n = self.rows[size], np.zeros(len(self.languages)), 0
            for gram in grams(word, size):
                row = known.get(gram)
                if row is not None:
                    total, n = total + self.logs[row], n + 1
            if n:
                return total / n
        return np.full(len(self.languages), MISSING)


class _Words(dict):
    """Row of each word in a table of scores; unseen words are worked out when they are first met."""

    def __init__(self, model: Model) -> None:
        super().__init__(model.rows[0])
        self.model, self.known, self.made = model, len(model.logs), 0
        self.table = np.vstack([model.logs, np.zeros((1024, len(model.languages)), np.float32)])

    def __missing__(self, word: str) -> int:
        row = self.known + self.made
        if row == len(self.table):
            self.table = np.vstack([self.table, np.zeros_like(self.table[:max(1024, self.made)])])
        self.table[row] = self.model.unseen(word)
        self.made += 1
        if len(word) <= LONG_WORD:
            self[word] = row
        return row

    def sum(self, words: list[str]) -> np.ndarray:
        """Sum of the words' scores; forgets the unseen ones first where they have become many."""
        if self.made * len(self.model.languages) > CACHE:
            self.__init__(self.model)
        rows = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return self.table[rows].sum(axis=0, dtype=np.float64)


def train(documents: DataFrame, sample: int = SAMPLE, entries: int = ENTRIES) -> Model:
    """The model of the rows that are not held out; its size is bounded by ``LANGUAGES``, ``entries`` and ``LONGEST``."""
    return Model(counted(learnable(documents, sample), entries).toArrow())


def predict(documents: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``documents`` (columns ``keep``, all by default) with ``lang_pred`` and ``score``, the share of the language among all
    by the text's mean word score, counted for as many words as it has, ``EVIDENCE`` at most.

    A text that is NULL or has no letter, or a model without languages, gives ``und`` and 0. Equal scores: the smallest name. Repeated rows
    are judged each; very long texts are worked through in pieces; an empty table gives no rows.
    """
    keep = documents.columns if keep is None else keep
    used = documents.select(*[F.col(c) for c in keep], F.col(text).alias("_text"))
    schema = T.StructType([*used.select(*keep).schema, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words(shared.value)
        languages = shared.value.languages
        for batch in batches:
            names, shares = [], []
            for value in batch.column("_text").to_pylist():
                total, n = np.zeros(len(languages)), 0
                for found in words_in(value):
                    total, n = total + words.sum(found), n + len(found)
                if not n or not languages:
                    names.append(NONE)
                    shares.append(0.0)
                    continue
                best = int(np.argmax(total))
                names.append(languages[best])
                shares.append(float(1 / np.exp((total - total[best]) / n * min(n, EVIDENCE)).sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(names, pa.string()), pa.array(shares, pa.float64())], names=schema.names)

    return by_batch(used, run, schema)
