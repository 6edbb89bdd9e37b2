"""Best-fit packing by patterns: non-negative least squares over a histogram of lengths, best fit for what is left.

Texts become token ids, cut into pieces of at most ``LENGTH`` tokens. Only the histogram of piece lengths (``LENGTH`` counts)
reaches the driver. There, patterns of two and three lengths that fill a sequence exactly get repeat counts by non-negative
least squares; the counts are rounded down to what the histogram holds, and the remaining lengths are packed by best fit,
longest first, again as counts. The result is a table of slots: for a length, which ranks of its pieces go to which sequences
at which place. Its size depends on the lengths that occur, not on the number of pieces; every piece finds its slot by its rank.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recado.llm.tokens import VOCABULARY, encoder
from recado.llm.words import by_batch, small_batches
from recado.operators.skew import broadcast_if_small
from recado.sources.staging import staged

LENGTH = 2048
END = 0  # the id that ends a document
MAX_PATTERNS = 20_000  # patterns that the fit weighs; those of two lengths first, then an even choice of those of three
SWEEPS = 12
SHARE_ROWS = 20_000  # pieces of one length that are ranked in one task, about

def pieces(docs: DataFrame, row_id: str = "doc_id", text: str = "text", length: int = LENGTH, vocabulary: str = VOCABULARY,
           with_ids: bool = False) -> DataFrame:
    """``row_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` (and ``ids``) of each document's pieces.

    A NULL text counts as empty: its one piece is the end id. Only documents of more than ``length`` tokens are cut; the
    first piece takes what is over, the others are full.
    """
    used = docs.select(F.col(row_id).alias("_id"), F.col(text).alias("_text"))
    schema = (T.StructType().add(row_id, docs.schema[row_id].dataType).add("piece", "integer").add("start", "long").add("length", "long")
              .add("ids_crc32", "long"))
    schema = schema.add("ids", T.ArrayType(T.IntegerType())) if with_ids else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).ids
        for batch in batches:
            for part in small_batches(batch, "_text"):
                rows, out = [], []
                for row, body in enumerate(part.column("_text").to_pylist()):
                    ids = np.array([*encode(body or ""), END], "<u4")
                    first = (len(ids) - 1) % length + 1
                    for k, (a, b) in enumerate(zip([0, *range(first, len(ids), length)], range(first, len(ids) + 1, length), strict=True)):
                        rows.append(row)
                        out.append((k, a, b - a, zlib.crc32(ids[a:b].tobytes()), ids[a:b] if with_ids else None))
                columns = list(zip(*out, strict=True)) or [()] * 5
                arrays = [part.column("_id").take(pa.array(rows, pa.int64())), pa.array(columns[0], pa.int32()),
                          *[pa.array(columns[i], pa.int64()) for i in (1, 2, 3)]]
                if with_ids:
                    arrays.append(pa.array(columns[4], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return by_batch(used, run, schema)


def patterns(lengths: list[int], full: int, most: int = MAX_PATTERNS) -> list[tuple[int, ...]]:
    """Two or three of ``lengths`` that add up to ``full``: all pairs, and evenly chosen triples up to ``most`` in all."""
    there = np.zeros(full + 1, bool)
    there[np.array(lengths, np.int64)] = True
    found = [(full - b, b) for b in lengths if b < full and 2 * b >= full and there[full - b]]
    of = np.array(lengths, np.int64)
    a, b = np.meshgrid(of, of, indexing="ij")
    c = full - a - b
    ok = (a <= b) & (c >= b)
    ok[ok] = there[c[ok]]
    triples = np.stack([a[ok], b[ok], c[ok]], axis=1)
    step = max(1, -(-len(triples) // max(1, most - len(found))))
    return found + [tuple(int(x) for x in t) for t in triples[::step]]


def fit(histogram: dict[int, int], columns: list[tuple[int, ...]], sweeps: int = SWEEPS) -> list[float]:
    """Repeat counts x >= 0 with the least squares of (histogram - patterns x), by coordinate descent."""
    left = [0.0] * (max(histogram, default=0) + 1)
    for length, n in histogram.items():
        left[length] = float(n)
    x = [0.0] * len(columns)
    norms = [sum(c.count(v) ** 2 for v in set(c)) for c in columns]
    for _ in range(sweeps):
        for j, c in enumerate(columns):
            step = sum(left[v] for v in c) / norms[j]
            step = max(step, -x[j])
            if step:
                x[j] += step
                for v in c:
                    left[v] -= step
    return x


def best_fit(histogram: dict[int, int], full: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Groups of equal sequences, as (length, times) in order and how many sequences: best fit, longest first, by counts."""
    open_: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = defaultdict(list)  # by room left
    rooms: list[int] = []

    def put(room: int, group: tuple[tuple[int, int], ...], count: int) -> None:
        if not open_[room]:
            insort(rooms, room)
        open_[room].append((group, count))

    for length in sorted(histogram, reverse=True):
        n = histogram[length]
        while n:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                times = min(full // length, n)
                count = n // times
                put(full - times * length, ((length, times),), count)
            else:
                room = rooms[at]
                group, have = open_[room].pop()
                if not open_[room]:
                    rooms.pop(at)
                times = min(room // length, n)
                count = min(have, n // times)
                if have > count:
                    put(room, group, have - count)
                put(room - times * length, (*group, (length, times)), count)
            n -= times * count
    return [g for room in sorted(open_) for g in open_[room]]


def plan(histogram: dict[int, int], full: int = LENGTH) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Groups of equal sequences for all pieces of the histogram."""
    left = dict(histogram)
    groups = []
    if left.get(full):
        groups.append((((full, 1),), left.pop(full)))
    columns = patterns(sorted(left), full)
    for c, x in sorted(zip(columns, fit(left, columns), strict=True), key=lambda y: -y[1]):
        times = [(v, c.count(v)) for v in dict.fromkeys(c)]
        count = min([int(x), *[left[v] // t for v, t in times]])
        if count > 0:
            groups.append((tuple(times), count))
            for v, t in times:
                left[v] -= t * count
    return groups + best_fit({v: n for v, n in left.items() if n}, full)


def slots(groups: list[tuple[tuple[tuple[int, int], ...], int]]) -> dict[str, np.ndarray]:
    """The plan as a table sorted by length and first rank: first sequence, place in it, and pieces of this length in each."""
    ranks: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for group, count in groups:
        place = 0
        for length, times in group:
            rows.append((length, ranks[length], sequence, place, times))
            ranks[length] += count * times
            place += length * times
        sequence += count
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "sequence", "place", "times"), table.T, strict=True))


def pack(made: DataFrame, full: int = LENGTH) -> DataFrame:
    """``made`` (stored pieces: a column ``length``) with ``sequence_id`` and ``offset``.

    A full piece is a sequence of its own and needs no rank. Other pieces of one length are told apart by their rank: a count in each
    share of the length, in the order of the other columns, plus the counts of the shares before. A length has a share for
    each ``SHARE_ROWS`` pieces, by the histogram, so no length is ranked in one task, however common.
    """
    histogram = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `full` rows
    whole = made.where(F.col("length") == full).withColumn(
        "sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    histogram.pop(full, None)
    table = slots(plan(histogram, full))
    plain = [c for c in made.columns if c != "ids"]
    shares = made.sparkSession.createDataFrame([(v, -(-n // SHARE_ROWS)) for v, n in histogram.items()], "length long, _shares long")
    salted = made.join(F.broadcast(shares), "length").withColumn(  # at most `full` rows
        "_salt", F.pmod(F.xxhash64(*plain), F.col("_shares"))).select(*made.columns, "_salt")
    before = W.partitionBy("length").orderBy("_salt").rowsBetween(W.unboundedPreceding, -1)
    offsets = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n")).select(
        "length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    ranked = salted.withColumn("_rank", F.row_number().over(W.partitionBy("length", "_salt").orderBy(*plain))).join(
        broadcast_if_small(offsets), ["length", "_salt"]).select(  # a row for each share
        *made.columns, (F.col("_first") + F.col("_rank") - 1).alias("_rank"))
    schema = made.schema.add("sequence_id", "long").add("offset", "long")
    keys = (table["length"] << 44) + table["rank"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.searchsorted(keys, (length << 44) + rank, side="right") - 1
            nth, times = rank - table["rank"][at], table["times"][at]
            found = [pa.array(table["sequence"][at] + nth // times), pa.array(table["place"][at] + nth % times * length)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *found], names=schema.names)

    return by_batch(ranked, run, schema).unionByName(whole.select(*schema.names))


def packed(docs: DataFrame, row_id: str = "doc_id", text: str = "text", full: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """Every piece of ``docs`` with its sequence and offset; texts are encoded once. An empty table has no piece.

    Columns besides the id and the text play no part. Repeated rows are packed each; rows without an id too.
    """
    made = staged(pieces(docs, row_id, text, full, with_ids=with_ids), "pieces")
    return pack(made, full)


def sequences(rows: DataFrame) -> DataFrame:
    """``sequence_id`` and ``ids`` (at most ``LENGTH``) of what ``packed(..., with_ids=True)`` returns: rows to train on."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return rows.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
