"""Joins that hold up when one key has a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recado.sources.staging import staged

HOT_ROWS = 2_000_000  # a key with more rows than this is spread over several tasks
WAYS = 64
SMALL_ROWS = 100_000
SMALL_BYTES = 64_000_000


def broadcast_if_small(df: DataFrame, max_rows: int = SMALL_ROWS, max_bytes: int | None = None) -> DataFrame:
    """Ask for a broadcast only after counting: beyond ``max_rows``, or ``max_bytes`` as JSON text, the optimizer picks the join.

    For stored look-ups, where the count is a short scan that stops at the limit. Give ``max_bytes`` where nothing else bounds a row.
    """
    some = df.limit(max_rows + 1)
    if max_bytes is None:
        return F.broadcast(df) if some.count() <= max_rows else df
    width = F.octet_length(F.to_json(F.struct(*[F.col(f"`{x}`") for x in df.columns]), {"ignoreNullFields": "false"}))
    found = some.select(width.alias("width")).agg(F.count(F.lit(1)).alias("n"), F.sum("width").alias("bytes")).first()
    return F.broadcast(df) if found["n"] <= max_rows and (found["bytes"] or 0) <= max_bytes else df


def attach(rows: DataFrame, groups: DataFrame, keys: Sequence[str], values: Sequence[str], row_id: Sequence[str],
           n_rows: str = "n_rows", hot_rows: int = HOT_ROWS, ways: int = WAYS) -> DataFrame:
    """Left-join each group's ``values`` on to its rows.

    ``groups`` is aggregated from the rows: one row per key, with its row count in ``n_rows``. Groups
    over ``hot_rows`` are at most (all rows / hot_rows) in number, so they are broadcast once counted; their
    rows, and rows with a NULL key, are spread by ``row_id`` in the join of the others. AQE's own skew split
    does not reach this join, because the aggregation stands between it and the shuffle.
    """
    groups = staged(groups, "groups")  # counted, and read twice
    renamed = {v: f"_hot_{v}" for v in values}
    hot = (groups.where(F.col(n_rows) > hot_rows)
           .select(*keys, F.lit(True).alias("_hot"), *[F.col(v).alias(h) for v, h in renamed.items()]))
    others = groups.where(F.col(n_rows) <= hot_rows).select(*keys, F.lit(0).alias("_way"), *values)

    any_null = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    way = (F.when(F.col("_hot").isNotNull() | any_null, 1 + F.pmod(F.xxhash64(*row_id), F.lit(ways)).cast("int"))
           .otherwise(F.lit(0)))
    joined = (rows.join(broadcast_if_small(hot), list(keys), "left")
              .withColumn("_way", way)
              .join(others, [*keys, "_way"], "left"))
    return joined.select(*rows.columns, *[F.coalesce(h, v).alias(v) for v, h in renamed.items()])


def salted_anti_join(left: DataFrame, right_keys: DataFrame, keys: Sequence[str], row_id: Sequence[str],
                     ways: int = 16) -> DataFrame:
    """Rows of ``left`` whose key (NULLs compare equal) is not in ``right_keys``.

    The left side is salted and the keys are repeated per salt, so a hot key is shared by ``ways`` tasks.
    """
    names = {k: f"_r_{k}" for k in keys}
    right = (right_keys.select(*[F.col(k).alias(n) for k, n in names.items()]).distinct()
             .withColumn("_r_way", F.explode(F.sequence(F.lit(0), F.lit(ways - 1)))))
    salted = left.withColumn("_way", F.pmod(F.xxhash64(*row_id), F.lit(ways)).cast("int"))
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()]
    on = reduce(Column.__and__, [*same, F.col("_way") == F.col("_r_way")])
    return salted.join(right, on, "left_anti").drop("_way")
