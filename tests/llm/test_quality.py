import os
import random
import zlib

import pytest
from pyspark.sql import functions as F

from recado.llm import quality

SCHEMA = "doc_id long, text string, score string, quality string, lang int"


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(8)
    words = [f"{a}{b}" for a in "the of and re st".split() for b in "an in er on ou".split()]
    rows, labels = [], []
    for i in range(600):
        good = i % 4 != 0
        text = " ".join(rng.choices(words, k=rng.randrange(5, 200)))
        kind = i % 3
        bad = text.upper().replace(" ", "!! ") if kind == 0 else " ".join(w + "###" for w in text.split()) if kind == 1 else (text.split()[0] + " ") * 40
        rows.append((i, text if good else bad, "s", "q", 1))
        if i % 5 < 3:
            labels.append((i, int(good), 0))
    rows += [(1, rows[1][1], "s", "q", 1), (5000, None, "s", "q", 1), (5001, "", "s", "q", 1), (None, "the an of in", "s", "q", 1), (5002, "word " * 60_000, "s", "q", 1)]
    labels += [(1, 1, 0), (5000, 1, 0), (None, 1, 0), (7, None, 0)]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark, corpus):
    docs, labels = corpus
    got = quality.score(docs, quality.train(docs, labels), keep=["doc_id"])
    assert got.dtypes == [("doc_id", "bigint"), ("score", "double")] and got.count() == docs.count()
    assert all(0 <= r.score <= 1 for r in got.collect())
    held = got.join(labels.where("quality is not null"), "doc_id").where(quality.held_out("doc_id")).collect()
    assert len(held) > 30 and sum((r.score >= 0.3) == bool(r.quality) for r in held) >= 0.95 * len(held)


def test_fold(spark, corpus):
    for r in corpus[0].select("doc_id", quality.held_out("doc_id").alias("h")).collect():
        assert r.h == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0)


def test_held_out_labels_teach_nothing(corpus):
    docs, labels = corpus
    turned = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert (quality.train(docs, labels) == quality.train(docs, turned)).all()


def test_no_labels_and_no_documents(corpus):
    docs, labels = corpus
    weights = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, weights, keep=["doc_id"]).collect()} == {0.5}
    assert quality.score(docs.limit(0), quality.train(docs.limit(0), labels)).collect() == []


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_on_the_test_tables(spark):
    from recado.llm.queries import QUERIES

    got = QUERIES["op9_quality_classifier"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = got.where("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)


def test_learner_against_its_rule_one_weight_at_a_time():
    """Follow the regularised leader with a rate for each weight, in plain Python."""
    import math

    import numpy as np

    rng = random.Random(4)
    rate, smooth, l1, l2 = 2.0, 1.0, 0.002, 0.0001
    z, n, leader = [0.0] * 12, [0.0] * 12, quality.Leader(12, rate, smooth, l1, l2)
    weight = lambda i: 0.0 if abs(z[i]) <= l1 else (math.copysign(l1, z[i]) - z[i]) / ((smooth + math.sqrt(n[i])) / rate + l2)
    for _ in range(200):
        at = sorted(rng.sample(range(11), rng.randint(1, 6))) + [11]
        value = [rng.random() * 3 for _ in at[:-1]] + [1.0]
        label = float(rng.random() < (0.9 if 3 in at else 0.2))
        leader.learn(np.array(at), np.array(value), label)
        w = [weight(i) for i in at]
        error = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, value, strict=True)))) - label
        for i, x, old in zip(at, value, w, strict=True):
            g = error * x
            step = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / rate
            z[i] += g - step * old
            n[i] += g * g
    assert leader.weights().tolist() == pytest.approx([weight(i) for i in range(12)], rel=1e-9, abs=1e-12)
    assert leader.weights()[3] > 0


def test_score_is_a_sparse_dot_product(spark):
    """Each n-gram's share of the text, times its weight, added up one by one."""
    import math

    import numpy as np
    import pyarrow as pa

    from recado.llm.words import shape_classes, words_of

    weights = np.random.default_rng(3).normal(size=(1 << quality.BITS) + 1)
    texts = ["the cat the the cat sat", "One!! TWO 22 two", "", None, "x"]
    got = quality.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), weights, keep=["doc_id"])
    for r in got.collect():
        words = words_of(pa.array([texts[r.doc_id]], pa.string()), None, shape_classes())
        found, k = quality.features(words)[0], len(words.hashes[0])
        total = weights[-1] + sum(quality.SCALE * weights[f] / k for f in found.ravel().tolist())
        assert r.score == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9)
