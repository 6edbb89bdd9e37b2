import pytest
from pyspark.sql import functions as F

from recado.operators.skew import broadcast_if_small
from recado.sources import interactions as it

SCHEMA = "id long, created_at string, social_media string, url string, text string"
GOOD = '{"user_name": "%s", "key": "ig_user"}'
RAW = [
    (1, "2022-01-01 10:00:00", GOOD % "Ana", "u1", "a"), (2, "2021-12-31 23:59:59", GOOD % "Ana", "u2", "b"),
    (3, "2022-02-01", GOOD % "BRAND", "u3", "c"), (4, "2022-02-02", '{"key": "ig_user"}', "u4", "d"),
    (5, "2022-02-03", '{"user_name": "Bia", "key": "fb_user"}', "u5", "e"), (6, "2022-02-04", '{"user_name": 7, "key": "ig_user"}', "u6", None),
    (7, "no date", GOOD % "Caio", "u7", "g"), (8, "2022-02-05", "{not json", "u8", "h"), (9, None, None, None, None),
    (10, "2022-02-06", GOOD % "Duda", None, "")]


@pytest.fixture
def landed(spark, tmp_path):
    path = str(tmp_path / "landing")
    it.land_interactions(spark.createDataFrame(RAW[:5], SCHEMA), path, "one")
    it.land_interactions(spark.createDataFrame(RAW[5:], SCHEMA), path, "two")
    return path


def test_landed_records_give_the_same_comments(spark, rows, landed):
    raw = spark.createDataFrame(RAW, SCHEMA).where("id <> 7")  # as a text, "no date" is after any day
    want = it.extract_comments(raw, "ig_user", "brand", "2022-01-01", "id")
    assert rows(it.extract_landed(spark, landed, "ig_user", "brand", "2022-01-01", "id")) == rows(want)
    assert {r.comment_id for r in want.collect()} == {1, 6, 10}


def test_nothing_is_lost_on_landing(spark, landed):
    found = spark.read.parquet(landed)
    assert found.count() == len(RAW)
    assert {r.id for r in found.where("created_day IS NULL").collect()} == {7, 9}
    assert {r.id for r in found.where("social_media IS NULL").collect()} == {8, 9}


def test_only_wanted_days_are_read(spark, landed):
    plan = it.extract_landed(spark, landed, "ig_user", "brand", "2022-02-04", "id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(created_day" in plan and "created_day" in plan.split("PartitionFilters")[1].split("]")[0]
    assert {r.comment_id for r in it.extract_landed(spark, landed, "ig_user", "brand", "2022-02-04", "id").collect()} == {6, 10}


def test_a_delivery_that_comes_again_replaces_itself_and_equal_records_are_one(spark, landed):
    again = spark.createDataFrame(RAW[:1], SCHEMA)
    it.land_interactions(again, landed, "one")
    assert spark.read.parquet(landed).count() == 6
    it.land_interactions(again, landed, "three")
    found = it.extract_landed(spark, landed, "ig_user", "brand", "2022-01-01")
    assert sorted(r.url or "" for r in found.collect()) == ["", "u1", "u6"]


def test_clashing_and_more_columns(spark, tmp_path):
    path = str(tmp_path / "landing")
    raw = spark.createDataFrame(RAW[:1], SCHEMA).withColumn("row_id", F.lit("x")).withColumn("created_day", F.lit("y")).withColumn("more", F.lit(1))
    it.land_interactions(raw, path, "one")
    assert it.extract_landed(spark, path, "ig_user", "brand", "2022-01-01", "id").count() == 1


def test_wide_rows_are_not_broadcast(spark):
    wide = spark.range(50).select("id", F.repeat(F.lit("x"), 1_000).alias("text"))
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(broadcast_if_small(wide)) and hinted(broadcast_if_small(wide, max_bytes=1_000_000))
    assert not hinted(broadcast_if_small(wide, max_bytes=10_000))
    assert not hinted(broadcast_if_small(wide, max_rows=49))
    assert hinted(broadcast_if_small(wide.limit(0), max_bytes=1))
