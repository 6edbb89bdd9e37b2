"""Exact top-k search by inner product, with bounds from segment statistics, coarse to fine.

Vectors are turned by one orthogonal matrix, learnt from a bounded sample, that puts most of their length into the first
components; inner products stay as they are. A turned vector is cut into segments. With a segment's mean and deviation of both
vectors, its inner product is at most width * (mean * mean + deviation * deviation), so the sum over segments is an upper bound (for
vectors of one length the same as a lower bound of their distance). It is an inner product of short vectors itself, so a block
of queries is bounded against many candidates by one small matrix product. Each level cuts more of the leading components into
segments of their own, where the bound is exact. A pair whose bound is below the query's k-th best score so far goes; survivors of
a level meet the next, finer one; those of the last are scored exactly, on the integers, pair by pair.

A query's first limit is its k-th best score among the sample. Queries come in blocks of a bounded size, which are broadcast; candidates
are read where they lie and never shuffled. Each task gives ``k`` candidates a query at most, and only those that beat the limit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recado.llm.ranks import Best, first_rows
from recado.llm.words import by_batch
from recado.operators.skew import broadcast_if_small
from recado.sources.staging import staged

SAMPLE = 4_096  # vectors that the matrix and the first limits are learnt from, about
BLOCK_VALUES = 1 << 22  # components of a block of queries: 32 MB
LEADING = (0, 1 / 4, 1 / 2, 5 / 8, 3 / 4, 7 / 8)  # share of the components that stand alone, level by level
REST = 8  # segments of the others, where they are as many
QUERIES = 256  # queries bounded at once
CANDIDATES = 8_192  # candidates bounded at once
PAIRS = 1 << 16  # pairs scored at once
EXACT = 2.0 ** 53  # sums below are exact in floating point
HUGE = 2.0 ** 900  # components beyond count as this
LOW, HIGH = np.iinfo(np.int64).min + 1, np.iinfo(np.int64).max


def finite(vector: Column) -> Column:
    """The vector as doubles; NULL unless every component is finite."""
    fits = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(x.cast("double")))
    return F.when(fits, F.transform(vector, lambda x: x.cast("double")))


def scaled(values: np.ndarray, scale: int) -> np.ndarray:
    return np.clip(np.floor(np.clip(values, -HUGE, HUGE) * scale), -HUGE, HUGE)


def levels(width: int) -> list[np.ndarray]:
    """First components of the segments of each level."""
    out = []
    for share in LEADING:
        alone = int(width * share)
        rest = np.linspace(alone, width, min(REST if alone else 1, width - alone) + 1).astype(int)[:-1]
        starts = np.concatenate([np.arange(alone), rest]).astype(int)
        if len(starts) and (not out or len(starts) > len(out[-1])):
            out.append(starts)
    return out


def statistics(vectors: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Means and deviations of a vector's segments, weighted so that an inner product of two rows is the bound."""
    widths = np.diff(np.append(starts, vectors.shape[1]))
    sums = np.add.reduceat(vectors, starts, axis=1)
    wide = widths > 1
    squares = np.add.reduceat(vectors * vectors, starts, axis=1)[:, wide]
    deviations = np.sqrt(np.maximum(0, squares - sums[:, wide] ** 2 / widths[wide]))
    return np.hstack([sums / np.sqrt(widths), deviations])


def turn(sample: np.ndarray) -> np.ndarray:
    """An orthogonal matrix after which the sample's components fall in size."""
    length = np.linalg.norm(sample, axis=1, keepdims=True)
    unit = sample / np.where(length > 0, length, 1)
    _, vectors = np.linalg.eigh(unit.T @ unit)
    return vectors[:, ::-1]


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` with those of ``b``, one by one, as longs; beyond a long, its end."""
    if not a.size:
        return np.zeros(len(a), np.int64)
    small = np.abs(a).max(axis=1) * np.abs(b).max(axis=1) * a.shape[1] < EXACT
    out = np.zeros(len(a), np.int64)
    out[small] = np.einsum("ij,ij->i", a[small], b[small]).astype(np.int64)
    for i in np.flatnonzero(~small).tolist():
        out[i] = min(max(sum(int(x) * int(y) for x, y in zip(a[i].tolist(), b[i].tolist(), strict=True)), LOW), HIGH)
    return out


class Block:
    """Queries of one width, their statistics at each level, and the least score of use to each."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, matrix: np.ndarray, least: np.ndarray) -> None:
        self.ids, self.vectors, self.matrix, self.least = ids, vectors, matrix, least
        self.starts = levels(vectors.shape[1])
        turned = vectors @ matrix
        self.statistics = [statistics(turned, s) for s in self.starts]
        self.length = np.linalg.norm(vectors, axis=1)

    def search(self, ids: np.ndarray, vectors: np.ndarray, best: Best) -> int:
        """Add the candidates that may be among the best; how many pairs were scored exactly."""
        turned = vectors @ self.matrix
        given = [statistics(turned, s) for s in self.starts]
        length, scored = np.linalg.norm(vectors, axis=1), 0
        for start in range(0, len(self.ids), QUERIES):
            of = slice(start, min(start + QUERIES, len(self.ids)))
            least, at = best.least[of][:, None], np.arange(len(ids))
            open_ = ids[at] != self.ids[of][:, None]
            for mine, theirs in zip(self.statistics, given, strict=True):
                bound = mine[of] @ theirs[at].T
                # the sums' rounding errors; what is no number stays
                open_ &= ~(np.maximum(bound + 1e-3 + 1e-9 * self.length[of][:, None] * length[at], LOW) < least)
                alive = open_.any(axis=0)
                at, open_ = at[alive], open_[:, alive]
            query, candidate = np.nonzero(open_)
            query, candidate = query + start, at[candidate]
            scored += len(query)
            for first in range(0, len(query), PAIRS):
                q, c = query[first:first + PAIRS], candidate[first:first + PAIRS]
                found = scores(self.vectors[q], vectors[c])
                keep = found >= best.least[q]
                best.add(q[keep], ids[c[keep]], np.zeros(int(keep.sum()), bool), found[keep])
        best.cut()
        return scored


def _by_width(ids: np.ndarray, vectors: pa.Array, scale: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Ids and scaled vectors of each width."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    ends = np.concatenate([[0], np.cumsum(vectors.value_lengths().to_numpy(zero_copy_only=False))]).astype(int)
    flat = scaled(vectors.flatten().to_numpy(zero_copy_only=False), scale)
    widths = np.diff(ends)
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        yield width, ids[rows], flat[ends[rows][:, None] + np.arange(width)]


def _once(rows: DataFrame) -> DataFrame:
    """Of rows that share an id, the smallest vector; ids alone are shuffled where none repeats."""
    repeated = staged(rows.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("vec_id"), "repeated-ids")
    if repeated.isEmpty():
        return rows
    several = rows.join(broadcast_if_small(repeated), "vec_id", "left_semi").groupBy("vec_id").agg(F.min("v").alias("v"), F.max("q").alias("q"))
    return rows.join(broadcast_if_small(repeated), "vec_id", "left_anti").unionByName(several)


def _limits(queries: DataFrame, sample, k: int, scale: int) -> DataFrame:
    """The queries with ``least``: their k-th best score among the sample, as a low bound of what they will find."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id").to_numpy()
            least, row = np.full(len(ids), LOW), {i: n for n, i in enumerate(ids.tolist())}
            for width, mine, vectors in _by_width(ids, batch.column("v"), scale):
                given_ids, given, _ = sample.value.get(width, (np.zeros(0, np.int64), np.zeros((0, width)), None))
                for i, v in zip(mine.tolist(), vectors, strict=True):
                    others = given[given_ids != i]
                    found = scores(np.broadcast_to(v, others.shape), others)
                    if len(found) >= k:
                        least[row[i]] = np.partition(found, len(found) - k)[len(found) - k]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least)], names=["vec_id", "v", "least"])

    return by_batch(queries, run, "vec_id long, v array<double>, least long")


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, row_id: str = "vec_id", vector: str = "embedding",
          block_values: int = BLOCK_VALUES) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` best of every other row for each row that ``is_query`` names.

    Scores are inner products of floor(``scale`` * x), exact for components of any size; one beyond a long counts as the end of the
    longs on its side. Ties go to the smaller id. Vectors that are NULL or hold a NULL or non-finite component take no part, nor do
    rows without an id. Vectors of different lengths are not compared; empty ones score 0 with each other. Of rows that share an id,
    the smallest vector counts. Other columns are ignored; an empty table, or no query, gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.where(F.col(row_id).isNotNull()).select(
        F.col(row_id).cast("long").alias("vec_id"), finite(F.col(vector)).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")).where("v IS NOT NULL")
    rows = _once(rows)
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("q"), F.size("v"))).alias("values")).first()
    share = F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = {}
    some = rows.where(share * F.lit(sizes["n"]) < SAMPLE).select("vec_id", "v").toArrow()  # about SAMPLE rows
    for width, ids, found in _by_width(some["vec_id"].to_numpy(), some["v"], scale):
        sample[width] = ids, found, turn(found) if width else np.zeros((0, 0))
    shared = spark.sparkContext.broadcast(sample)
    blocks = max(1, -(-(sizes["values"] or 0) // block_values))
    queries = staged(_limits(rows.where("q").select("vec_id", "v"), shared, k, scale).withColumn(
        "block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks))), "queries")
    found = []
    for block in range(blocks):
        asked = queries.where(F.col("block") == block).select("vec_id", "v", "least").toArrow()  # about block_values components
        made, least = {}, dict(zip(asked["vec_id"].to_pylist(), asked["least"].to_pylist(), strict=True))
        for width, ids, mine in _by_width(asked["vec_id"].to_numpy(), asked["v"], scale):
            matrix = sample[width][2] if width in sample else np.eye(width)
            made[width] = ids, mine, matrix, np.array([least[i] for i in ids.tolist()], np.int64)
        found.append(_found(rows.select("vec_id", "v"), spark.sparkContext.broadcast(made), k, scale))
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    return first_rows(best, ["query_id"], [F.col("score").desc(), F.col("vec_id")], k, ["vec_id"]).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _found(rows: DataFrame, queries, k: int, scale: int) -> DataFrame:
    """``query_id``, ``vec_id``, ``score``: the best candidates of each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = {width: Block(*made) for width, made in queries.value.items()}
        best = {width: Best(len(b.ids), k, b.least) for width, b in blocks.items()}
        for batch in batches:
            for start in range(0, batch.num_rows, CANDIDATES):
                part = batch.slice(start, CANDIDATES)
                for width, ids, vectors in _by_width(part.column("vec_id").to_numpy(), part.column("v"), scale):
                    if width in blocks:
                        blocks[width].search(ids, vectors, best[width])
        for width, b in blocks.items():
            q, ids, _, score = best[width].cut()
            yield pa.RecordBatch.from_arrays([pa.array(b.ids[q]), pa.array(ids), pa.array(score)], names=["query_id", "vec_id", "score"])

    return by_batch(rows, run, "query_id long, vec_id long, score long")
