"""Near-duplicates by MinHash with tensored banding.

A text's set is its distinct shingles of words. Equal sets form a class first, so copies cost one row each and no pairs. Two
small collections of bands are worked out for each class; every pair of a band of the first and a band of the second is a
table key. ``BANDS`` ** 2 tables thus cost 2 * ``BANDS`` * ``ROWS`` minhashes, not ``BANDS`` ** 2 * 2 * ``ROWS``. A pair of
similarity s meets with probability (1 - (1 - s ** ROWS) ** BANDS) ** 2: 0.9998 at 0.85, 0.99999 at 0.9.

A class also has an outline of ``BITS`` bits: each shingle of its set flips one. Where two outlines differ in more bits than a
linked pair may differ in shingles, the pair is no candidate. That leaves out no link, as a bit can only differ where a shingle
does, and it needs no set. Candidates are then confirmed on full sets.

A bucket gives no pairs of all its members: each member is compared with the bucket's most central one, and links are joined up
to components. In buckets that still hold several components, the members outside the centre's are compared with all others:
some in a first round, sixteen times as many in each further one, until nothing is left to compare.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recado.llm.words import by_batch, lower_ascii, mix, small_batches, words_of
from recado.operators.skew import attach, broadcast_if_small
from recado.sources.staging import staged

SHINGLE = 3
PERCENT = 85  # linked: 100 * intersection >= PERCENT * union
BANDS = 10  # in each of the two collections
ROWS = 3  # minhashes of a band
SPLIT = 5_000  # members of a bucket that are ranked in one task
SALTS = 16
FEW_IDS = 500_000  # ids, counted, that are broadcast: some megabytes
FIRST_PIVOTS = 256  # members of a bucket's share, outside the centre's component, that meet all others in the first round
BITS = 1024  # of an outline
HOT_CLASSES = 1_000  # a component of more classes is named by a broadcast, not in one task
_U = np.uint64
_SEEDS = mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=_U))


def shingles_of(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text: of ``width`` words, or of the whole text if it has fewer."""
    words = words_of(texts, lower_ascii())
    one = words.hashes[0]
    hashes = np.zeros(len(one), _U)
    for k in range(width):
        hashes[:len(one) - k] += one[k:] * mix(np.array([k + 1], _U))
    hashes = mix(hashes)
    for start, end in words.bounds():
        n = end - start
        if n >= width:
            yield np.unique(hashes[start:end - width + 1])
        elif n:
            yield mix(np.array([n], _U) + sum(one[start + k:start + k + 1] * mix(np.array([k + 101], _U)) for k in range(n)))
        else:
            yield hashes[:0]


def _class_ids(sets: list[np.ndarray]) -> pa.Array:
    """128 bits of each set, from two sums over its members; null for an empty set."""
    return pa.array([None if not len(s) else np.array([s.sum(dtype=_U), mix(s ^ _U(0xABCDEF)).sum(dtype=_U)], _U).tobytes() for s in sets],
                    pa.binary())


def _bands(sets: list[np.ndarray]) -> np.ndarray:
    """Bands of each set that is not empty, a row for each."""
    full = [s for s in sets if len(s)]
    if not full:
        return np.zeros((0, 2 * BANDS), np.int64)
    joined = np.concatenate(full)
    starts = np.cumsum([0, *[len(s) for s in full[:-1]]])
    lowest = np.empty((len(_SEEDS), len(full)), _U)
    for k, seed in enumerate(_SEEDS):
        x = (joined ^ seed) * (seed | _U(1))
        lowest[k] = np.minimum.reduceat(x ^ (x >> _U(32)), starts)
    out = np.zeros((2 * BANDS, len(full)), _U)
    for r in range(ROWS):
        out = mix(out + lowest[r::ROWS])
    return out.T.astype(np.int64)


def _outlines(sets: list[np.ndarray]) -> np.ndarray:
    """Outline of each set that is not empty, as longs: the parity of its members in each of ``BITS`` cells."""
    out = np.zeros((sum(len(s) > 0 for s in sets), BITS // 64), np.int64)
    shift = _U(64 - BITS.bit_length() + 1)
    for row, s in enumerate(x for x in sets if len(x)):
        cells = np.bincount((mix(s ^ _U(0x5555)) >> shift).astype(np.int64), minlength=BITS)
        out[row] = np.packbits((cells & 1).astype(np.uint8)).view(np.int64)
    return out


def _place(row_id: str, text: str) -> Column:
    """A number by which a row is found again, with its id; rows of one id and text share it."""
    return F.xxhash64(F.col(row_id).cast("string"), text)


def sketch(docs: DataFrame, row_id: str = "doc_id", text: str = "text", width: int = SHINGLE) -> DataFrame:
    """``_id``, ``_place`` (of id and text), ``n`` (set size), ``cid`` (class, NULL for an empty set), ``bands`` and ``bits`` (outline)
    of each row."""
    used = docs.select(F.col(row_id).alias("_id"), _place(row_id, text).alias("_place"), F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch, "_text"):
                sets = list(shingles_of(part.column("_text"), width))
                n = np.array([len(s) for s in sets], np.int64)
                lists = []
                for found in (_bands(sets), _outlines(sets)):
                    ends = np.concatenate([[0], np.cumsum(np.where(n > 0, found.shape[1], 0))])
                    lists.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found.ravel())))
                yield pa.RecordBatch.from_arrays([part.column("_id"), part.column("_place"), pa.array(n), _class_ids(sets), *lists], names=schema.names)

    schema = used.select("_id", "_place").schema.add("n", "long").add("cid", "binary")
    for name in ("bands", "bits"):
        schema = schema.add(name, T.ArrayType(T.LongType()))
    return by_batch(used, run, schema)


def _sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, row_id: str, text: str, width: int) -> DataFrame:
    """``cid`` and ``members`` (shingle hashes) of the classes in ``wanted``, each from the text with its lowest id."""
    ids = staged(classes.join(wanted, "cid", "left_semi").select(F.col("id").alias("_want")).distinct(), "wanted")
    used = docs.select(F.col(row_id).alias("_id"), F.col(text).alias("_text")).join(
        broadcast_if_small(ids, FEW_IDS), F.col("_id").eqNullSafe(F.col("_want")), "left_semi")  # no text is shuffled for few

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch, "_text"):
                sets = list(shingles_of(part.column("_text"), width))
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
                members = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets).astype(np.int64)))
                yield pa.RecordBatch.from_arrays([_class_ids(sets), members], names=["cid", "members"])

    made = by_batch(used.select("_text"), run, "cid binary, members array<long>")
    return made.join(wanted, "cid", "left_semi").dropDuplicates(["cid"])


def _possible(a: str, b: str, percent: int) -> Column:
    """Sizes and outlines (columns ``n`` and ``bits`` with these endings) that allow a link."""
    n_a, n_b = F.col(f"n{a}"), F.col(f"n{b}")
    differ = reduce(Column.__add__, [F.bit_count(F.get(f"bits{a}", F.lit(i)).bitwiseXOR(F.get(f"bits{b}", F.lit(i)))) for i in range(BITS // 64)])
    return (F.lit(100) * F.least(n_a, n_b) >= F.lit(percent) * F.greatest(n_a, n_b)) & (
        F.lit(100 + percent) * differ <= F.lit(100 - percent) * (n_a + n_b))


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the stored ``pairs`` (a, b: distinct class ids) that are linked on their full sets (stored; cid, members).

    A central class is in many pairs: its set is given once to each of its ``SALTS`` shares that has a pair, so no task
    holds all of them.
    """
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(SALTS)).cast("int"))
    hubs = salted.select("b", "salt").distinct().join(
        sets.select(F.col("cid").alias("b"), F.col("members").alias("of_b")), "b")
    both = salted.join(sets.select(F.col("cid").alias("a"), F.col("members").alias("of_a")), "a").join(hubs, ["b", "salt"])
    common = F.size(F.array_intersect("of_a", "of_b"))
    return both.select("a", "b", common.alias("c"), (F.size("of_a") + F.size("of_b")).alias("s")).where(
        F.lit(100) * F.col("c") >= F.lit(percent) * (F.col("s") - F.col("c"))).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """``cid`` and ``comp`` (smallest cid reachable) of all that are in ``links`` (a, b).

    Each round takes the smallest label of the neighbours, then the label of that one; it ends when none changes.
    """
    both = staged(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = staged(both.groupBy(F.col("a").alias("cid")).agg(F.min("b").alias("comp")).select(
        "cid", F.least("cid", "comp").alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("cid").alias("b"), "comp"), "b").groupBy(F.col("a").alias("cid")).agg(F.min("comp").alias("near"))
        step = near.join(labels, "cid").select("cid", F.col("comp").alias("was"), F.least("comp", "near").alias("step"))
        jump = labels.select(F.col("cid").alias("step"), F.col("comp").alias("next"))
        new = staged(step.join(jump, "step").select("cid", "was", F.least("step", "next").alias("comp")), "labels")
        labels = new.select("cid", "comp")
        if new.where(F.col("was") != F.col("comp")).isEmpty():
            return labels


def _tables(classes: DataFrame) -> DataFrame:
    """``cid``, ``weight`` and ``key`` for every table in which the class can meet another.

    A band that no other class has can make no bucket, so it is left out before bands are combined. ``weight`` adds up how
    many classes share each of the class's bands: in a group of near copies it is largest for the text they come from.
    """
    bands = classes.select("cid", F.posexplode("bands").alias("slot", "value")).select(
        "cid", "slot", F.xxhash64("slot", "value").alias("band"))
    shared = staged(bands.groupBy("band").agg(F.count(F.lit(1)).alias("uses")).where("uses > 1"), "bands")
    active = staged(bands.join(shared, "band").groupBy("cid").agg(
        F.collect_list(F.when(F.col("slot") < BANDS, F.col("band"))).alias("first"),
        F.collect_list(F.when(F.col("slot") >= BANDS, F.col("band"))).alias("second"), F.sum("uses").alias("weight")).where(
        (F.size("first") > 0) & (F.size("second") > 0)), "active")
    return active.withColumn("x", F.explode("first")).withColumn("y", F.explode("second")).select(
        "cid", "weight", F.xxhash64("x", "y").alias("key"))


def class_components(docs: DataFrame, classes: DataFrame, row_id: str = "doc_id", text: str = "text", width: int = SHINGLE,
                     percent: int = PERCENT) -> DataFrame:
    """``cid`` and ``comp`` of the classes that are linked with another."""
    tables = _tables(classes)
    centre = F.max(F.struct("weight", "cid")).alias("centre")
    buckets = staged(tables.groupBy("key").agg(F.count(F.lit(1)).alias("members"), centre).where("members > 1"), "buckets")
    tables = staged(tables.join(buckets, "key").select("key", "cid", "weight", "members", F.col("centre.cid").alias("centre")), "tables")
    outlines = classes.select("cid", "n", "bits")

    def linked(pairs: DataFrame) -> DataFrame:
        pairs = staged(pairs, "pairs")
        wanted = pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct()
        return staged(confirm(pairs, staged(_sets(docs, classes, wanted, row_id, text, width), "sets"), percent), "found")

    pairs = tables.where("cid <> centre").select(F.col("cid").alias("a"), F.col("centre").alias("b")).distinct()
    for side in ("a", "b"):
        pairs = pairs.join(outlines.select(*[F.col(c).alias(f"{c}_{side}") for c in outlines.columns]).withColumnRenamed(f"cid_{side}", side), side)
    links = linked(pairs.where(_possible("_a", "_b", percent)).select("a", "b"))
    labels = components(links)

    # Buckets of two have no other pair. Of two members in different components one at least is not in the centre's.
    open_ = staged(_open(tables.where("members > 2").select("key", "cid", "weight"), labels).join(outlines, "cid"), "open")
    share = F.pmod(F.xxhash64("cid"), F.ceil(F.col("of") / SPLIT)).cast("int")
    outside = staged(open_.where("comp <> main").withColumn("share", share).withColumn("rank", F.row_number().over(
        W.partitionBy("key", "share").orderBy(F.col("weight").desc(), "cid"))).select(
        "key", "rank", *[F.col(c).alias(f"{c}_b") for c in ("cid", "n", "bits", "comp")]), "outside")
    last = outside.agg(F.max("rank")).first()[0] or 0
    more, low, high = [], 1, 1 + FIRST_PIVOTS  # ranks inside each share of a bucket, from the most central one
    while low <= last:
        pivots = outside.where((F.col("rank") >= low) & (F.col("rank") < high))
        more.append(linked(open_.join(pivots, "key").where((F.col("comp") != F.col("comp_b")) & _possible("", "_b", percent)).select(
            F.least("cid", "cid_b").alias("a"), F.greatest("cid", "cid_b").alias("b")).distinct()))
        low, high = high, high * 16
    # Components were not worked out anew after each round, as older ones only rule out less.
    return components(reduce(DataFrame.unionByName, [links, *more])) if more else labels


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``members`` with ``comp``, of those buckets in which it differs; ``main`` (the centre's) and ``of`` (members) of the bucket."""
    named = members.join(labels, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    several = named.groupBy("key").agg(
        F.min("comp").alias("x"), F.max("comp").alias("y"), F.max(F.struct("weight", "cid", "comp")).alias("centre"),
        F.count(F.lit(1)).alias("of")).where(F.col("x") != F.col("y")).select("key", F.col("centre.comp").alias("main"), "of")
    return named.join(several, "key")


def _grouped(docs: DataFrame, row_id: str, text: str, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The sketch of every row, and ``cid``, ``comp`` and ``component_id`` of every class."""
    rows = staged(sketch(docs, row_id, text, width), "sketches")
    classes = staged(rows.where("n > 0").groupBy("cid").agg(
        F.min("_id").alias("id"), F.min("n").alias("n"), F.any_value("bands").alias("bands"),
        F.any_value("bits").alias("bits")), "classes")
    labels = class_components(docs, classes, row_id, text, width, percent)
    comps = staged(classes.select("cid", "id").join(labels, "cid", "left").withColumn("comp", F.coalesce("comp", "cid")), "components")
    lowest = comps.groupBy("comp").agg(F.min("id").alias("component_id"), F.count(F.lit(1)).alias("n_rows"))
    named = attach(comps, lowest, ["comp"], ["component_id"], ["cid"], hot_rows=HOT_CLASSES)
    return rows, staged(named.select("cid", "comp", "component_id"), "named")


def near_duplicates(docs: DataFrame, row_id: str = "doc_id", text: str = "text", width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``row_id``, ``n_shingles``, ``component_id`` and ``kept``, a row for each row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z as a-z; a text with fewer than ``width`` words is one shingle, a text without
    words (or NULL) has none and is linked with nothing. Texts are linked if 100 * intersection >= ``percent`` * union of
    their shingle sets. ``component_id`` is the smallest id reachable over links. NULL ids take no part in that minimum: a
    component of such rows alone has a NULL id. Rows that repeat an id are told apart by their texts. ``kept`` says that the
    row has its component's id, NULL counting as equal to NULL. An empty table gives an empty result.
    """
    rows, named = _grouped(docs, row_id, text, width, percent)
    linked = rows.where("n > 0").select("_id", "n", "cid").join(named, "cid")
    alone = rows.where("n = 0").select("_id", "n", F.col("_id").alias("component_id"))
    return linked.select("_id", "n", "component_id").unionByName(alone).select(
        F.col("_id").alias(row_id), F.col("n").alias("n_shingles"), "component_id",
        F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, row_id: str = "doc_id", text: str = "text", width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each component, as it is: that of the smallest id (NULL last). Rows without words are in no component and stay, but
    of rows that repeat an id and a text one stays.

    A kept row is found again by its id and a hash of id and text, so rows of other components stay out, whatever their ids.
    """
    rows, named = _grouped(docs, row_id, text, width, percent)
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_place")).alias("first")
    classes = rows.where("n > 0").groupBy("cid").agg(first)  # copies go before components are formed
    kept = classes.join(named, "cid").groupBy("comp").agg(F.min("first").alias("first")).select("first._id", "first._place")
    alone = rows.where("n = 0").select("_id", "_place").distinct()
    keys = lambda name: (F.coalesce(F.col(name).cast("string"), F.lit("")).alias("_key"), F.col(name).isNull().alias("_none"))
    places = kept.unionByName(alone).select("_place", *keys("_id"))
    same = ["_place", "_key", "_none"]
    again = docs.select(F.struct(*docs.columns).alias("_row"), _place(row_id, text).alias("_place"), *keys(row_id)).join(places, same, "left_semi")
    one = F.row_number().over(W.partitionBy(*same).orderBy(F.lit(0)))
    return again.withColumn("_n", one).where("_n = 1").select("_row.*")
