import random

import numpy as np
from pyspark.sql import functions as F

from recado.llm import ranks, topk


def brute(rows, k=10):
    vectors = {}
    for i, v, *_ in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        s = [int(np.floor(1024 * float(np.float32(x)))) for x in v]
        vectors[i] = min(vectors.get(i, s), s)
    out = []
    for q, a in vectors.items():
        if q % 100:
            continue
        scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in vectors.items() if i != q and len(a) == len(b))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(out)


SCHEMA = "vec_id long, embedding array<float>, label int, score long, rank string"


def test_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(33)], 0, 1, "x") for i in range(700)]
    rows += [(1000 + i, rows[7][1], 0, 1, "x") for i in range(300)]  # many equal vectors: ties
    rows += [(2000, None, 0, 1, "x"), (2100, [float("nan")] * 33, 0, 1, "x"), (2200, [None] * 33, 0, 1, "x"), (None, [0.1] * 33, 0, 1, "x"),
             (2300, [float("inf")] * 33, 0, 1, "x"), (3000, [0.5, 0.25], 0, 1, "x"), (3001, [0.5, -0.25], 0, 1, "x"), (3100, [], 0, 1, "x"),
             (100, rows[100][1], 0, 1, "x")]  # a repeated row
    got = topk.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_blocks_of_queries_and_large_components(spark):
    rows = [(0, [1.0, 2.0]), (1, [20000.0, 1.0]), (2, [0.5, 0.5]), (100, [-17000.0, 0.0]), (200, [3e5, -3e5]), (3, [2.5e5, 3.0]), (4, [-1e7, 5.0])]
    rows += [(300 + i, [float(i), -0.125 * i]) for i in range(150)]
    made = spark.createDataFrame([(*r, 0, 1, "x") for r in rows], SCHEMA).repartition(3)
    for block_values in (topk.BLOCK_VALUES, 2):
        got = topk.top_k(made, F.col("vec_id") % 100 == 0, block_values=block_values)
        assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_scores_beyond_a_long_are_its_ends(spark):
    rows = [(0, [1e30, 0.0]), (1, [1e20, 1.0]), (2, [-1e20, 1.0]), (3, [1e30, 7.0])]
    got = topk.top_k(spark.createDataFrame([(*r, 0, 1, "x") for r in rows], SCHEMA), F.col("vec_id") == 0).collect()
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(1, topk.HIGH), (3, topk.HIGH), (2, topk.LOW)]


def found_by(queries, x, k, matrix):
    ids = np.arange(len(x))
    block = topk.Block(ids[:len(queries)], queries, matrix, np.full(len(queries), topk.LOW))
    whole = (queries @ x.T).astype(np.int64)
    whole[ids[:len(queries)], ids[:len(queries)]] = topk.LOW
    for i in range(len(queries)):  # limits as a sample gives them
        block.least[i] = np.sort(whole[i, -1000:])[-k]
    best, scored = ranks.Best(len(queries), k, block.least), 0
    for start in range(0, len(x), 1500):
        scored += block.search(ids[start:start + 1500], x[start:start + 1500], best)
    q, name, _, score = best.cut()
    order = np.argsort(-whole, axis=1, kind="stable")[:, :k]
    assert np.array_equal(name.reshape(-1, k), order) and np.array_equal(score.reshape(-1, k), np.take_along_axis(whole, order, 1))
    return scored / (len(queries) * len(x))


def test_bounds_prune_and_stay_exact():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 64)) * 300
    x = np.floor(centres[rng.integers(0, 12, 6000)] + rng.normal(size=(6000, 64)) * 20)
    assert found_by(x[:40], x, 10, topk.turn(x[:3000])) < 0.1
    assert found_by(x[:40], x, 10, np.eye(64)) < 0.5
    y = np.floor(rng.normal(size=(6000, 64)) * 128)  # no structure at all
    assert found_by(y[:40], y, 10, topk.turn(y[:3000])) < 0.3


def test_each_level_is_a_bound_and_finer_than_the_one_before():
    rng = np.random.default_rng(6)
    for width in (1, 2, 7, 33, 64):
        x = rng.normal(size=(300, width)) * rng.random(width) * 100
        y, last = x @ topk.turn(x), np.inf
        for starts in topk.levels(width):
            s = topk.statistics(y, starts)
            bound = s[:20] @ s.T
            assert (bound + 1e-3 >= x[:20] @ x.T).all() and bound.mean() <= last + 1e-6
            last = bound.mean()


def test_sums_beyond_floating_point_are_exact():
    x = np.array([[2.0 ** 27, 2.0 ** 27 - 1] * 64, [2.0 ** 27, 1.0] * 64])
    assert topk.scores(x, x)[0] == 64 * (2 ** 54 + (2 ** 27 - 1) ** 2)


def test_empty_and_no_query(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert topk.top_k(empty, F.col("vec_id") % 100 == 0).collect() == []
    one = spark.createDataFrame([(1, [0.1], 0, 1, "x"), (100, [0.3], 0, 1, "x")], SCHEMA)
    assert topk.top_k(one, F.col("vec_id") % 7 == 6).collect() == []
    assert [tuple(r) for r in topk.top_k(one, F.col("vec_id") % 100 == 0).collect()] == [(100, 1, 1, 102 * 307)]
