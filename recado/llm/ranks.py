"""The first rows of each key: inside a task, and over all tasks in two rounds, so that no task sorts all of a hot key."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

WAYS = 64
PENDING = 1 << 20  # rows that a task gathers before it cuts them to the best of each item


def first_rows(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, spread: Sequence[str], ways: int = WAYS,
               with_ties: bool = False) -> DataFrame:
    """The first ``n`` rows of each key by ``order``, ranked in ``rank``; ``with_ties``: also all that are equal to the last of them.

    Spark cuts each map task's rows to ``n`` a key and part; each of the ``ways`` parts (dealt by a hash of ``spread``) is cut to
    ``n`` again, so the task that ends with a key reads at most ``ways * n`` rows of it, ties aside.
    """
    place = F.rank() if with_ties else F.row_number()
    part = F.pmod(F.xxhash64(*spread), F.lit(ways))
    parts = rows.withColumn("_part", part).withColumn("rank", place.over(W.partitionBy(*keys, "_part").orderBy(*order)))
    cut = parts.where(F.col("rank") <= n).drop("rank", "_part")
    return cut.withColumn("rank", place.over(W.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= n)


class Best:
    """The best ``k`` documents of each item that a task has met: score, then smaller id, NULL ids last."""

    def __init__(self, items: int, k: int, least: np.ndarray | int = 1) -> None:
        self.k, self.least = k, np.zeros(items, np.int64) + least  # a lower score is of no use
        self.rows: list[tuple[np.ndarray, ...]] = []
        self.pending = 0

    def add(self, item: np.ndarray, doc: np.ndarray, unnamed: np.ndarray, score: np.ndarray) -> None:
        self.rows.append((item, doc, unnamed, score))
        self.pending += len(item)
        if self.pending > PENDING:
            self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        if not self.rows:
            none = np.zeros(0, np.int64)
            return none, none, none.astype(bool), none
        item, doc, unnamed, score = (np.concatenate(c) for c in zip(*self.rows, strict=True))
        order = np.lexsort((doc, unnamed, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        order, item, place = order[place < self.k], item[place < self.k], place[place < self.k]
        kept = item, doc[order], unnamed[order], score[order]
        self.rows, self.pending = [kept], 0
        last = place == self.k - 1
        self.least[item[last]] = np.maximum(self.least[item[last]], kept[3][last])
        return kept
