"""Registered queries against their SQL, and the pipeline against a step-by-step account of its stages."""

import os
import re
from collections import Counter

import pytest

import corpus_pipeline
from recado.llm import mix, neardup, quality, rules
from recado.llm.oracles import ORACLES
from recado.llm.queries import QUERIES
from suite.check import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_all_are_registered():
    import __spark_entry__ as entry

    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal(spark, con, name):
    assert compare(spark, con, SF_DIR, QUERIES[name], ORACLES[name])[0] == ""


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scores = quality.score(docs.select("doc_id", "text"), quality.train(docs, labels), keep=["doc_id"]).collect()
    left = docs.where(docs.doc_id.isin([r.doc_id for r in scores if r.score >= 0.3]))
    left = left.where(left.doc_id.isin([r.doc_id for r in rules.judge(left).collect() if r.kept]))
    left = left.where(left.doc_id.isin([r.doc_id for r in neardup.near_duplicates(left).collect() if r.kept]))
    taken = {r.doc_id: r.taken for r in mix.mix(left).collect() if r.taken}

    made, n = docs, []
    for name, stage in corpus_pipeline.STAGES[:4]:
        made = stage(spark, made, SF_DIR)
        assert made.dtypes == docs.dtypes, name
        n.append(made.count())
    words = Counter()
    for r in made.collect():
        words[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    assert words == Counter(taken) and n[0] < docs.count()

    packed = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id for r in packed} == set(taken)
    used = Counter()
    for r in packed:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 2048
    assert len(used) <= -(-sum(used.values()) // 2048) + 2


def test_stages_on_an_empty_table(spark):
    empty = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).collect() == []


def test_stages_on_odd_rows_and_clashing_columns(spark):
    """NULLs in any column, repeated rows and columns with the operators' own names go through the stages; the columns come out as they went in."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    first = docs.orderBy("doc_id").first()
    odd = spark.createDataFrame([(None, None, None, None, None), (None, first.text, None, None, None), (first.doc_id, first.text, "en", None, None),
                                 (first.doc_id, None, None, "s", 1), (10 ** 9, "", None, None, 0), (10 ** 9, "", None, None, 0)], docs.schema)
    made = docs.unionByName(odd).selectExpr("*", "1 AS score", "'x' AS kept", "2 AS cid", "'y' AS component_id", "3 AS length", "4 AS _row", "5 AS n")
    texts = Counter(r.text for r in made.collect())
    for name, stage in corpus_pipeline.STAGES[:4]:
        made = stage(spark, made, SF_DIR)
        assert made.columns == [*docs.columns, "score", "kept", "cid", "component_id", "length", "_row", "n"], name
        got = made.collect()
        assert got and {r.text for r in got} <= set(texts) | {None} or name == "mix_sources"
        assert {(r.score, r.kept, r.cid) for r in got} == {(1, "x", 2)}, name
    kept = Counter(r.doc_id for r in corpus_pipeline.STAGES[2][1](spark, docs.unionByName(odd), SF_DIR).collect() if r.text and r.doc_id is not None)
    assert max(kept.values()) == 1
    packed = corpus_pipeline.STAGES[4][1](spark, made, SF_DIR)
    assert packed.count() >= made.select("doc_id").distinct().count() > 0
