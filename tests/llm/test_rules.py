import random
import re
from collections import Counter

import pytest

from recado.llm import rules

SCHEMA = "doc_id long, text string, n_words string, kept string, _words string, p_good int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside))


def texts():
    rng = random.Random(5)
    prose = "the river runs past an old mill and nobody asks why it turns".split()
    words = prose + [f"{a}{b}" for a in prose for b in ("en", "ly", "os", "tion")]
    out = []
    for i in range(260):
        t = [rng.choice(words) for _ in range(rng.randrange(25, 120))]
        out.append((" ".join(t) + ".").capitalize() + ("\nEnd of it." if i % 2 else ""))
    junk = [" ".join(w + rng.choice(("###", "&&&", "%%%")) for w in t.split()) for t in out[:12]]
    junk += [t.upper().replace(" ", "!! ") for t in out[12:24]] + [" | ".join(t.split()) for t in out[24:36]]
    edge = [None, "", " \n\t", "short text", "é" * 300, "a b c d e f g h i " * 30, "same line here\n" * 30, "one two three four five six seven eight\n" * 2,
            "漢字 " * 25, " ".join(words[:30]) + " X " + " ".join(words[:30]), "x " * 7, "x " * 8, "x " * 9, ("w" * 50 + " ") * 3000 + " ".join(words)]
    return out, junk, edge


@pytest.fixture(scope="module")
def judged(spark):
    good, junk, edge = texts()
    rows = [(i, t, "a", "b", "c", 1) for i, t in enumerate([*good, *junk, *edge])]
    rows += [rows[0], (None, good[1], "a", "b", "c", 1)]
    return rows, good, junk, rules.judge(spark.createDataFrame(rows, SCHEMA)).cache()


def test_base_figures(judged):
    rows, _, _, got = judged
    assert got.columns == ["doc_id", *rules.BASE, "base_failed", "p_good", "kept"]
    want = sorted(((i, *base(t)) for i, t, *_ in rows), key=repr)
    assert sorted(((r.doc_id, *[r[c] for c in rules.BASE]) for r in got.collect()), key=repr) == want
    for r in got.collect():
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_junk_goes_and_prose_stays(judged):
    _, good, junk, got = judged
    kept = {r.doc_id: r.kept for r in got.collect()}
    assert all(kept[i] for i in range(len(good))) and not any(kept[len(good) + i] for i in range(len(junk)))


def test_nothing_bad_means_nothing_goes(spark):
    good, _, _ = texts()
    got = rules.judge(spark.createDataFrame([(i, t, "", "", "", 0) for i, t in enumerate(good)], SCHEMA))
    assert all(r.kept for r in got.collect())


def test_kept_rows_are_as_they_were(spark, judged):
    rows, _, _, got = judged
    docs = spark.createDataFrame(rows, SCHEMA)
    out = rules.keep_good(docs)
    assert out.dtypes == docs.dtypes
    kept = Counter(r.doc_id for r in got.collect() if r.kept)
    assert Counter(r.doc_id for r in out.collect()) == kept


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert rules.judge(empty).collect() == [] and rules.keep_good(empty).collect() == []


def test_no_python_in_the_plan(spark, judged):
    plan = judged[3]._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_expectation_maximisation_against_plain_sums(spark):
    """The same estimate over the votes of every document, one by one."""
    import random

    rng, names = random.Random(6), ["a", "b", "c"]
    votes = []
    for _ in range(300):
        good = rng.random() < 0.7
        votes.append(tuple(rng.choices([1, 0, -1], [6, 3, 1] if good else [2, 3, 5])[0] for _ in names))
    counted = spark.createDataFrame([(*v, n) for v, n in Counter(votes).items()], "a int, b int, c int, n long")
    model = rules.estimate(counted, names, rounds=7, settled=0.0)

    prior, on_good, on_bad = 0.8, dict.fromkeys(names, rules.START[0]), dict.fromkeys(names, rules.START[1])
    imagined = [[10 * x for x in (*s, 1 - sum(s))] for s in rules.START]
    for _ in range(7):
        p = []
        for v in votes:
            odds = prior / (1 - prior)
            for n, x in zip(names, v):  # no vote tells nothing, and none counts against its meaning
                ratio = on_good[n][x < 0] / on_bad[n][x < 0]
                odds *= 1 if not x else max(1, ratio) if x > 0 else min(1, ratio)
            p.append(odds / (1 + odds))
        n_good, n_bad = sum(p), len(p) - sum(p)
        prior = min(0.999, max(0.001, (n_good + 4) / (len(p) + 5)))
        for k, n in enumerate(names):
            up, down = (sum(q for q, v in zip(p, votes) if v[k] == x) for x in (1, -1))
            on_good[n] = ((up + imagined[0][0]) / (n_good + sum(imagined[0])), (down + imagined[0][1]) / (n_good + sum(imagined[0])))
            up, down = (sum(1 - q for q, v in zip(p, votes) if v[k] == x) for x in (1, -1))
            on_bad[n] = ((up + imagined[1][0]) / (n_bad + sum(imagined[1])), (down + imagined[1][1]) / (n_bad + sum(imagined[1])))
    for n in names:
        assert model.on_good[n] == pytest.approx(on_good[n], rel=1e-6) and model.on_bad[n] == pytest.approx(on_bad[n], rel=1e-6)
