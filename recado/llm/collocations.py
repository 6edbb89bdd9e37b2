"""Phrase collocations by set-oriented mining: sorted occurrence relations, merged, counted and cut to frequent groups, length by length.

``R1`` holds where each word occurs: (piece, place, word), sorted. ``R(k+1)`` is the merge-join of ``R(k)`` with itself by piece and
adjacent place: as both sides are one sorted list, the partner of an occurrence can only be the one after it. Its groups are
counted over all documents, groups below the least count go, and ``R(k+1)`` keeps the occurrences of frequent groups only
before it is extended. Each relation is written as Parquet, and the one before it is then deleted. Groups are counted twice: first by short
keys of ``KEY_BITS`` bits, as most pairs are rare and need not be shuffled whole, then exactly, on the occurrences that are left.

A row of a relation holds the sorted occurrences of a block of texts of one language, as parallel arrays. Pieces lie inside a text, so
no join crosses rows; only counts, summed in each task first, are shuffled, and no key can be hot. The semi-join with the frequent groups goes
by a bit table of a fixed size, whatever their number: occurrences that pass by chance cost time, and
their groups fall again at the next count, which is exact. A word is a 64-bit hash; a second one must agree for all
words that share the first, or the run ends.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recado.llm.ranks import first_rows
from recado.llm.words import buffer_of, by_batch, lower_ascii, mix, small_batches, words_of
from recado.operators.skew import broadcast_if_small
from recado.sources.staging import remove, staged, staged_at

LONGEST = 5
LEAST = 100
TOP = 2000
BITS = 26  # the bit table has 2 ** BITS bits: 8 MB
KEY_BITS = 40  # of a phrase's hash in the first count
# A relation's rows are blocks of texts, and a reader holds the blocks of a whole group of rows at once: groups are a few blocks, not 128 MB.
FEW_BLOCKS = {"parquet.block.row.count.limit": "16"}
PLACES = 2_000_000  # numbers of texts that are broadcast at most, where words are spelt
_U = np.uint64

#: Bytes that end a piece, and bytes that are part of no word.
IS_BREAK = np.zeros(256, dtype=bool)
IS_BREAK[[*range(0x0A, 0x0E), *b".,;:!?"]] = True
IS_WORD = ~IS_BREAK
IS_WORD[[0x09, 0x20]] = False


def _second() -> np.ndarray:
    """Another numbering of the lower-cased bytes, for the second hash."""
    return (lower_ascii() * 167 + 13) % 256


def _names(words: int) -> list[str]:
    return [f"w{i}" for i in range(1, words + 1)]


class _Block:
    """Words of some texts: hashes, places, and the language each belongs to."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        texts = batch.column("text")
        self.data, _ = buffer_of(texts)
        found = words_of(texts, lower_ascii(), _second(), is_word=IS_WORD)
        self.word, self.check = (h.view(np.int64) for h in found.hashes)
        self.starts, self.sizes = found.starts, found.sizes
        in_text = np.repeat(np.arange(len(found.ends)), np.diff(found.ends, prepend=0))
        self.piece = np.searchsorted(np.flatnonzero(IS_BREAK[self.data]), self.starts) + in_text
        number = np.arange(len(self.piece))
        first = np.ones(len(number), dtype=bool)
        first[1:] = self.piece[1:] != self.piece[:-1]
        self.pos = number - np.maximum.accumulate(np.where(first, number, 0))
        langs = batch.column("lang").dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        self.lang = langs.indices.to_numpy()[in_text]
        self.at = batch.column("at").to_numpy()[in_text]

    def text(self, at: int) -> str:
        start = self.starts[at]
        return self.data[start:start + self.sizes[at]].tobytes().lower().decode()


def _hash(lang: str, words: list[np.ndarray]) -> np.ndarray:
    """A number of 64 bits for each phrase; its first bits are its place in the bit table."""
    out = np.full(len(words[0]), zlib.crc32(lang.encode()), _U)
    for w in words:
        out = mix(out * _U(0x9E3779B97F4A7C15) + w.view(_U))
    return out


def _groups(words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For the distinct phrases, a row of each and how many there are; a phrase may come in parts, which are summed later."""
    order = np.argsort(_hash("", words) if len(words) > 1 else words[0], kind="stable")
    new = np.ones(len(order), dtype=bool)
    new[1:] = False
    for w in words:
        new[1:] |= w[order[1:]] != w[order[:-1]]
    firsts = np.flatnonzero(new)
    return order[firsts], np.diff(np.append(firsts, len(order)))


def _keys(lang: str, words: list[np.ndarray]) -> np.ndarray:
    """The first ``KEY_BITS`` bits of each phrase's hash: the groups of a first, short count."""
    return (_hash(lang, words) >> _U(64 - KEY_BITS)).astype(np.int64)


def word_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``lang``, ``w1``, ``n`` and ``at`` (of a text that holds it) of words found ``least`` times or more, and a row with ``w1`` NULL
    for all words of the language."""
    schema = T.StructType().add("lang", "string").add("w1", "long").add("check", "long").add("n", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch, "text"):
                block = _Block(part)
                for code, lang in enumerate(block.langs):
                    mine = np.flatnonzero(block.lang == code)
                    if not len(mine):
                        continue
                    # two hashes make the group, so that words that share the first only stay apart until they are checked
                    some, n = _groups([block.word[mine], block.check[mine]])
                    found = mine[some]
                    check = (block.check[found] >> 32 << 32) | block.at[found]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * (len(n) + 1), pa.string()), pa.array([None, *block.word[found].tolist()], pa.int64()),
                        pa.array([None, *check.tolist()], pa.int64()), pa.array([len(mine), *n.tolist()], pa.int64())],
                        names=schema.names)

    return _frequent_words(by_batch(docs, run, schema), least)


def _frequent_words(counts: DataFrame, least: int) -> DataFrame:
    """Sums of the counts. The upper half of ``check`` is a second hash: the run ends if words of a frequent hash differ in it;
    the lower half is ``at``."""
    counted = counts.groupBy("lang", "w1").agg(F.sum("n").alias("n"), F.min("check").alias("_least"), F.max("check").alias("_most"))
    frequent = counted.where((F.col("n") >= least) | F.col("w1").isNull())
    same = F.col("w1").isNull() | (F.shiftright("_least", 32) == F.shiftright("_most", 32))
    clash = F.raise_error(F.lit("two words share a hash: change the hash's base")).cast("long")
    return frequent.select("lang", "w1", F.when(same, F.col("n")).otherwise(clash).alias("n"), F.expr("_least & 4294967295").alias("at"))


def word_keys(groups: DataFrame) -> DataFrame:
    """``key`` of each word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            codes, words = langs.indices.to_numpy(), batch.column("w1").to_numpy()
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(_keys(lang, [words[codes == code]]))], names=["key"])

    return groups.select("lang", "w1").mapInArrow(run, "key long")


def bit_table(keys: DataFrame, bits: int = BITS) -> np.ndarray:
    """A table of 2 ** bits bits (15 at least) with those of the keys set; Spark joins the bits of all tasks in 4 KB buckets."""
    places = keys.select((F.shiftright("key", KEY_BITS - bits) + 1).alias("bit"))
    rows = places.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect()  # 2 ** bits / 32768 rows at most
    table = np.zeros((1 << bits) // 8, np.uint8)
    for r in rows:
        start = (r["bucket"] - 1) * 4096
        table[start:start + 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return table


def _has(table: np.ndarray, phrases: np.ndarray) -> np.ndarray:
    bits = (phrases >> _U(64 - (8 * len(table) - 1).bit_length())).astype(np.int64)
    return (table[bits >> 3] >> (bits & 7).astype(np.uint8)) & 1 == 1


def _relation(words: int) -> T.StructType:
    schema = T.StructType().add("lang", "string").add("piece", T.ArrayType(T.IntegerType())).add("pos", T.ArrayType(T.IntegerType()))
    for name in _names(words):
        schema = schema.add(name, T.ArrayType(T.LongType()))
    return schema


def _row(lang: str, piece: np.ndarray, pos: np.ndarray, words: list[np.ndarray]) -> list[pa.Array]:
    whole = lambda x, kind: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, kind))
    return [pa.array([lang], pa.string()), whole(piece, pa.int32()), whole(pos, pa.int32()), *(whole(w, pa.int64()) for w in words)]


def first_relation(docs: DataFrame, table) -> DataFrame:
    """``R1``: occurrences of frequent words."""
    schema = _relation(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch, "text"):
                block = _Block(part)
                for code, lang in enumerate(block.langs):
                    mine = np.flatnonzero(block.lang == code)
                    mine = mine[_has(table.value, _hash(lang, [block.word[mine]]))]
                    if len(mine):
                        yield pa.RecordBatch.from_arrays(_row(lang, block.piece[mine], block.pos[mine], [block.word[mine]]), names=schema.names)

    return by_batch(docs, run, schema)


def spelt(docs: DataFrame, words: DataFrame) -> DataFrame:
    """``lang``, ``word``, ``name`` of the words asked for (``lang``, ``word``, ``at``), read from one text of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch, "text"):
                block = _Block(part)
                _, index = np.unique(np.stack([block.lang, block.word]), axis=1, return_index=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array([block.langs[c] for c in block.lang[index].tolist()], pa.string()), pa.array(block.word[index]),
                    pa.array([block.text(i) for i in index.tolist()], pa.string())], names=["lang", "word", "name"])

    places = broadcast_if_small(words.select("at").distinct(), PLACES)
    names = by_batch(docs.join(places, "at", "left_semi").select("lang", "text", "at"), run, "lang string, word long, name string")
    return names.join(broadcast_if_small(words.select("lang", "word").distinct(), PLACES), ["lang", "word"]).groupBy("lang", "word").agg(
        F.min("name").alias("name"))


def _extended(batch: pa.RecordBatch, words: int) -> Iterator[tuple[str, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Merge-join of each row's occurrences with themselves, one place on: phrases that are longer by a word."""
    for i in range(batch.num_rows):
        values = [batch.column(c)[i].values.to_numpy() for c in ("piece", "pos", *_names(words))]
        piece, pos, *found = values
        at = np.flatnonzero((piece[1:] == piece[:-1]) & (pos[1:] == pos[:-1] + 1))
        yield batch.column("lang")[i].as_py(), piece[at], pos[at], [*(w[at] for w in found), found[-1][at + 1]]


def frequent_keys(relation: DataFrame, words: int, least: int = LEAST) -> DataFrame:
    """``key`` of the phrases, one word longer than the relation's, that may be frequent: counts of keys, which phrases may share."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, _, _, found in _extended(batch, words):
                key, n = np.unique(_keys(lang, found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["key", "n"])

    counts = by_batch(relation.select("lang", "piece", "pos", *_names(words)), run, "key long, n long")
    return counts.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("key")


def next_relation(relation: DataFrame, words: int, table) -> DataFrame:
    """The relation of phrases one word longer, cut to the keys in the bit table."""
    schema = _relation(words + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, piece, pos, found in _extended(batch, words):
                kept = np.flatnonzero(_has(table.value, _hash(lang, found)))
                if len(kept):
                    yield pa.RecordBatch.from_arrays(_row(lang, piece[kept], pos[kept], [w[kept] for w in found]), names=schema.names)

    return by_batch(relation.select("lang", "piece", "pos", *_names(words)), run, schema)


def group_counts(relation: DataFrame, words: int, least: int = LEAST) -> DataFrame:
    """``lang``, ``w1`` .. and ``n`` of the relation's phrases, exactly, if found ``least`` times or more."""
    names = _names(words)
    occurrences = relation.select("lang", F.inline(F.arrays_zip(*names)))
    return occurrences.groupBy("lang", *names).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """Frequent phrases of 1 to ``longest`` words (``lang``, ``words``: their hashes, ``f``), and words (``lang``, ``w1``, ``n``, ``at``;
    ``w1`` NULL for all of a language). ``docs`` has ``lang``, ``text`` and ``at``, a number of 32 bits for the text."""
    spark = docs.sparkSession
    counts = staged(word_counts(docs, least), "words")
    groups = counts.where("w1 IS NOT NULL")
    found = [groups.select("lang", F.array("w1").alias("words"), F.col("n").alias("f"))]
    table = spark.sparkContext.broadcast(bit_table(word_keys(groups), bits))
    relation, path = staged_at(first_relation(docs, table), "occurrences", **FEW_BLOCKS)
    for words in range(1, longest):
        before = path
        table.destroy()
        table = spark.sparkContext.broadcast(bit_table(frequent_keys(relation, words, least), bits))
        relation, path = staged_at(next_relation(relation, words, table), "occurrences", **FEW_BLOCKS)
        remove(spark, before)
        groups = staged(group_counts(relation, words + 1, least), "groups")
        found.append(groups.select("lang", F.array(*_names(words + 1)).alias("words"), F.col("n").alias("f")))
    table.destroy()
    remove(spark, path)
    phrases = found[0]
    for more in found[1:]:
        phrases = phrases.unionByName(more)
    return phrases, counts


def collocations(documents: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, bits: int = BITS) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: each language's ``top`` phrases; numbers are longs.

    Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and into words ``[^\\x20\\x09]+``. A phrase of 2 to
    ``longest`` words found ``a >= least`` times scores its lowest floor(1000 * a * n / (l * r)) over its cuts, in decimals; one that
    lies in a longer phrase found as often is left out. A NULL text is empty; a NULL language is ``und``; a repeated row counts each
    time it occurs; ids are not read, and other columns are ignored. No text, or nothing frequent: no rows. Memory
    grows with the longest text, about 60 bytes a word.
    """
    docs = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "at", F.xxhash64("text").bitwiseAND(F.lit(0xFFFFFFFF)))
    phrases, words = frequent_phrases(docs, least, longest, bits)
    totals = words.where("w1 IS NULL").select("lang", "n")
    of = phrases.withColumn("size", F.size("words"))
    longer = of.where("size > 2").select("lang", "f", F.explode(F.array(
        F.expr("slice(words, 1, size - 1)"), F.expr("slice(words, 2, size - 1)"))).alias("words")).distinct()
    # a phrase inside a longer one of the same count lies in one that is longer by one word and has this count too
    kept = of.where("size > 1").join(broadcast_if_small(longer), ["lang", "words", "f"], "left_anti")
    cuts = kept.withColumn("cut", F.explode(F.expr("sequence(1, size - 1)"))).withColumns({
        "left": F.expr("slice(words, 1, cut)"), "right": F.expr("slice(words, cut + 1, size - cut)")})
    for side, count in (("left", "l"), ("right", "r")):
        parts = phrases.select("lang", F.col("words").alias(side), F.col("f").alias(count))
        cuts = cuts.join(broadcast_if_small(parts), ["lang", side])
    whole = lambda c: F.col(c).cast("decimal(38,0)")
    ratio = (F.lit(1000).cast("decimal(38,0)") * whole("f") * whole("n")).alias("x")
    scored = cuts.join(broadcast_if_small(totals), "lang").withColumn("_up", ratio).withColumn("_down", whole("l") * whole("r"))
    lowest = scored.withColumn("score", F.expr("_up div _down")).groupBy("lang", "words", "f").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("best"), F.max("n").alias("n"))
    order = [F.col("score").desc(), F.col("a").desc()]
    first = staged(first_rows(lowest.select("lang", "words", F.col("f").alias("a"), "best.l", "best.r", "n", "best.score"), ["lang"], order, top,
                              ["words"], with_ties=True).drop("rank"), "first")
    used = words.select("lang", F.col("w1").alias("word"), "at").join(
        broadcast_if_small(first.select("lang", F.explode("words").alias("word")).distinct()), ["lang", "word"], "left_semi")
    names = staged(spelt(docs, staged(used, "used-words")), "spellings")
    placed = first.select("*", F.posexplode("words").alias("_at", "word")).join(broadcast_if_small(names), ["lang", "word"])
    told = placed.groupBy("lang", "words", "a", "l", "r", "n", "score").agg(
        F.array_sort(F.collect_list(F.struct("_at", "name"))).alias("_names")).withColumn(
        "phrase", F.array_join(F.transform("_names", lambda x: x["name"]), " "))
    return first_rows(told, ["lang"], [*order, F.col("phrase")], top, ["words"]).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
