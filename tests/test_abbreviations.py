"""Sentence ends that are learnt, and the model registry."""

import datetime as dt
import math
import random
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from recado.functions import text as t
from recado.operators import abbreviations as ab
from recado.operators import sentences as s
from recado.plans import clean as pc
from recado.profiles import PT, PT_TAXONOMY
from recado.sources import models
from suite.profile import TAXONOMY, TEST


def corpus(n=400):
    rng = random.Random(5)
    nouns = ["pedido", "loja", "entrega", "produto", "dinheiro", "cliente", "atraso"]
    said = lambda: " ".join(rng.choices(nouns, k=rng.randint(3, 6)))
    return [f"{said()} {rng.choice(['Sr.', 'Dra.', 'p.ex.'])} {rng.choice(['João', 'Ana'])} {said()}. {said()}." for _ in range(n)] + [None, "", " . ?"]


def test_scores_against_the_formula(spark):
    texts = corpus(120)
    made = spark.createDataFrame([(x,) for x in texts], "text string")
    n = {}
    for x in texts:
        for token in (x or "").lower().split():
            m = re.search(r"([^\W\d_](?:(?:[^\W\d_]|\.)*[^\W\d_])?)(\.?)", token)
            if m:
                n.setdefault(m[1], [0, 0])[m[2] != "."] += 1
    stops, words = sum(a for a, _ in n.values()), sum(a + b for a, b in n.values())
    p = stops / words
    want = {}
    for w, (a, b) in n.items():
        if a:
            letters = len(w.replace(".", ""))
            ratio = -2 * (a * math.log(p) + b * math.log(1 - p) - a * math.log(0.99) - b * math.log(0.01))
            want[w] = (a, b, ratio * math.exp(-letters) * (len(w) - letters + 1) * letters ** -b)
    got = {r.word: (r.n_stop, r.n_plain, r.score) for r in ab.abbreviation_scores(ab.stop_counts(made)).collect()}
    assert got.keys() == want.keys()
    assert all(got[w][:2] == want[w][:2] and got[w][2] == pytest.approx(want[w][2], rel=1e-6, abs=1e-12) for w in want)


def test_abbreviations_are_learnt_and_end_no_sentence(spark):
    learnt = ab.learn_abbreviations(spark.createDataFrame([(x,) for x in corpus()], "text string"))
    assert learnt == ["dra", "p.ex", "sr"]
    asked = "Sr. João comprou. a dra. Ana, não veio! p.ex. isto"
    made = spark.createDataFrame([(asked,)], "text string")
    split = lambda words: made.select(t.sentences(s.comment_text(F.col("text"), "brand", words), bool(words))).first()[0]
    assert split(learnt) == ["sr. joão comprou.", "a dra. ana.", "não veio!", "p.ex. isto"]
    assert split(()) == ["sr.", "joão comprou.", "a dra.", "ana.", "não veio!", "p.ex.", "isto"]
    assert ab.learn_abbreviations(made.limit(0)) == []


def test_profile_with_abbreviations_cleans_and_traces_alike(spark):
    profile = replace(PT, abbreviations=("sr",))
    rows = [(1, "2024-01-01", "u", "x", None, "o sr. joao nunca recebeu o pedido da loja. o pedido nunca chegou")]
    made = spark.createDataFrame(rows, "comment_id long, interaction_date string, user_name string, url string, content_type string, text string")
    kept = [r.text for r in pc.kept(pc.clean_tagged(made, profile)).orderBy("sentence_idx").collect()]
    traced = [r.text for r in pc.clean_trace(made, profile).where("stage = 'final'").orderBy("sentence_idx").collect()]
    assert kept == traced
    sentences = [r.text for r in pc.clean_trace(made, profile).where("stage = 'sentences'").orderBy("sentence_idx").collect()]
    assert sentences == ["o sr. joao nunca recebeu o pedido da loja.", "o pedido nunca chegou"]


def test_registry_takes_the_newest_and_refuses_another_profile(spark, tmp_path, monkeypatch):
    saved = {}
    monkeypatch.setattr(models, "save_model", lambda model, path: saved.update({path: model}))
    monkeypatch.setattr(models, "load_model", lambda spark, path: saved[path])
    lookup = spark.createDataFrame([(0, "a", None)], "subclusters_id int, cluster string, problema string")
    root = str(tmp_path / "root")
    models.register("late", lookup, root, "insta-b", TEST, TAXONOMY, dt.datetime(2024, 5, 2), k=140)
    models.register("early", lookup, root, "insta-a", TEST, TAXONOMY, dt.datetime(2024, 5, 1), k=140)
    models.register("other", lookup, root, "face-a", PT, PT_TAXONOMY, dt.datetime(2024, 5, 3))
    model, found = models.load_newest(spark, root, "insta", TEST, TAXONOMY, k=140)
    assert model == "late" and found.collect() == lookup.collect()
    assert models.registered(spark, root).count() == 3
    for profile, options in ((replace(TEST, mandatory=("x",)), {"k": 140}), (TEST, {"k": 139}), (PT, {"k": 140})):
        with pytest.raises(ValueError, match="another profile"):
            models.load_newest(spark, root, "insta", profile, TAXONOMY, **options)
    with pytest.raises(LookupError):
        models.load_newest(spark, root, "nothing", TEST, TAXONOMY)


def test_counts_of_a_run_are_those_of_its_parts(spark, tmp_path):
    from recado.plans import report

    schema = "comment_id long, interaction_date string, user_name string, url string, content_type string, text string"
    rows = [(1, "2024-01-01", "u", "x", None, "the order never arrived. refund"), (2, "2024-01-01", "u", "x", None, "the order never arrived. refund"),
            (3, "2024-01-01", "u", "x", None, "@someone hello"), (4, "2024-01-01", "u", "x", None, "Maria Souza, hello"), (5, "2024-01-01", "u", "x", None, None)]
    made = spark.createDataFrame(rows, schema)
    found = report.clean_and_count(made, TEST, str(tmp_path / "out"))
    assert (found["n_comments"], found["duplicate_pct"], found["n_mention"], found["n_name"]) == (4, 25.0, 1, 1)
    assert found["n_sentences"] == found["n_small"] + found["n_large"] + found["n_medium"] == 2
    assert spark.read.parquet(str(tmp_path / "out")).count() == pc.clean_tagged(made, TEST).count()
    none = report.clean_and_count(made.limit(0), TEST, str(tmp_path / "none"))
    assert none["n_comments"] == 0 and none["duplicate_pct"] is None and none["removed_pct"] is None
