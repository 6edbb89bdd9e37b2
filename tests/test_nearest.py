import numpy as np
import pytest

from recado.operators import vectors as v


def one_by_one(vectors, centres, decimals):
    distances = np.array([[np.round(np.square(x - c).sum(), decimals) for c in centres] for x in vectors])
    return distances.argmin(axis=1)


@pytest.mark.parametrize("decimals", [6, 1, 0])
@pytest.mark.parametrize("far", [0.0, 1e5])
def test_places_are_those_of_a_plain_loop(decimals, far):
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(60, 7)) + far
    centres[20:30] = centres[3]  # equal centres
    vectors = np.vstack([draw.normal(size=(300, 7)) + far, centres, (centres[:30] + centres[30:]) / 2])
    assert (v.nearest_centres(vectors, centres, decimals) == one_by_one(vectors, centres, decimals)).all()


def test_blocks_do_not_change_places(monkeypatch):
    draw = np.random.default_rng(6)
    vectors, centres = draw.normal(size=(500, 4)), draw.normal(size=(40, 4))
    want = v.nearest_centres(vectors, centres, 6)
    monkeypatch.setattr(v, "BLOCK_VALUES", 100)
    assert (v.nearest_centres(vectors, centres, 6) == want).all()
    assert (want == one_by_one(vectors, centres, 6)).all()


def test_ten_thousand_centres():
    draw = np.random.default_rng(7)
    centres = draw.normal(size=(10_000, 50))
    vectors = centres[draw.integers(0, 10_000, size=1_000)] + draw.normal(size=(1_000, 50)) * 0.3
    want = np.array([np.round(np.square(x - centres).sum(axis=1), 6).argmin() for x in vectors])
    assert (v.nearest_centres(vectors, centres, 6) == want).all()


def test_nulls_infinite_components_and_empty_tables(spark):
    rows = [(1, [0.0, 1.0]), (2, None), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [9.0, 9.0])]
    df = spark.createDataFrame(rows, "id long, features array<double>")
    centres = spark.createDataFrame([(7, [0.0, 0.0]), (8, [9.0, 9.0])], "subclusters_id int, center array<double>")
    assert dict(v.assign_clusters(df, centres).select("id", "subclusters_id").collect()) == {1: 7, 2: None, 3: 7, 4: 7, 5: 8}
    assert v.assign_clusters(df.limit(0), centres).count() == 0
    assert {r.subclusters_id for r in v.assign_clusters(df, centres.limit(0)).collect()} == {None}


def test_the_best_of_several_starts_is_kept(spark):
    draw = np.random.default_rng(8)
    points = spark.createDataFrame([(x.tolist(),) for x in draw.normal(size=(200, 3))], "x array<double>").select(v.array_to_vector("x").alias("features"))
    costs = [v.fit_kmeans(points, 12, (seed,), max_iter=3).summary.trainingCost for seed in (1, 2, 3)]
    assert len(set(costs)) > 1
    assert v.fit_kmeans(points, 12, (1, 2, 3), max_iter=3).summary.trainingCost == pytest.approx(min(costs))
    assert len(v.SEEDS) == 10
