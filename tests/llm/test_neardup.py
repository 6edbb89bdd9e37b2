import random
import re

import pytest

from recado.llm import neardup

SCHEMA = "doc_id long, text string, kept string, component_id string, n int, cid string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width=3):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def brute(rows, percent=85):
    """(id, set size, smallest id reachable, kept) of each row, all pairs compared."""
    sets = [shingles(t) for _, t, *_ in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            c = len(sets[i] & sets[j])
            if c and 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c):
                up[root(i)] = root(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[root(i)] = min(low.get(root(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), low.get(root(i)), r[0] == low.get(root(i))) for i, r in enumerate(rows)), key=repr)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10 ** 9)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(1, 120))) for _ in range(150)]
    base = rng.choices(vocabulary, k=200)
    texts += [" ".join(base)] * 40 + [edited(rng, base, 4) for _ in range(120)]  # copies; a group linked through its source
    other = rng.choices(vocabulary, k=100)
    texts += [edited(rng, other, k % 3) for k in range(30)] + ["passage " * 3 + " ".join(rng.choices(vocabulary, k=30)) for _ in range(30)]
    texts += [None, "", " \t\n", "one", "ONE", "one two", "One  two", "É x y z", "é x y z", "very long " * 4000, "Very long " * 4000]
    rng.shuffle(texts)
    out = [(i, t, "x", "x", 1, "x") for i, t in enumerate(texts)]
    return [*out, out[0], out[1], (None, texts[2], "x", "x", 1, "x"), (None, "alone without an id, this text", "x", "x", 1, "x")]


def test_against_brute_force(spark, rows):
    got = neardup.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    plain = [(r.doc_id, r.n_shingles, r.component_id, r.kept and r.doc_id is not None) for r in got.collect()]
    assert sorted(plain, key=repr) == [(i, n, c, k and i is not None) for i, n, c, k in brute(rows)]


def test_every_open_bucket_is_gone_through(spark, monkeypatch):
    """Hubs alone leave pairs untested: three kinds of texts meet in one bucket, each to be linked with its own kind."""
    monkeypatch.setattr(neardup, "SPLIT", 7)
    rng = random.Random(2)
    core = [f"c{i}" for i in range(60)]
    rows = []
    for kind in range(3):
        own = [f"k{kind}_{i}" for i in range(12)]
        rows += [(100 * kind + i, " ".join([*core, *own, f"u{rng.randrange(10 ** 6)}"]), "", "", 0, "") for i in range(15)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def one_of_each(rows):
    """Rows to be kept, by a comparison of all pairs: the smallest id of each component; rows without words, each once."""
    sets = [shingles(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    best = {}
    for row, own, g in zip(rows, sets, group, strict=True):
        key = (g,) if own else ("alone", row[0], row[1])
        best[key] = min(best.get(key, row), row, key=lambda r: (r[0] is None, r[0] or 0))
    return best


def test_one_row_of_each_group_stays(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    got, want = kept.collect(), one_of_each(rows)
    assert len(got) == len(want)
    assert sorted((r.doc_id for r in got), key=repr) == sorted((r[0] for r in want.values()), key=repr)


def test_rows_without_an_id_or_with_a_repeated_one(spark):
    base = "this is a text of some length that others repeat with small changes near its end so that they are linked with it and go away".split()
    near = lambda k: " ".join([*base, f"tail{k}"])
    other, third = "nothing in common with any of the rest of these rows at all", "a third text that stands alone among all of them here"
    given = [(1, near(1)), (None, near(2)), (None, near(3)), (None, other), (5, third), (5, near(4)), (None, None), (None, None), (None, ""), (7, "")]
    made = spark.createDataFrame([(i, t, "", "", 0, "") for i, t in given], SCHEMA)
    got = sorted(((r.doc_id, r.text) for r in neardup.keep_one(made).collect()), key=repr)
    assert got == sorted([(1, near(1)), (None, other), (5, third), (None, None), (None, ""), (7, "")], key=repr)
    all_ = neardup.near_duplicates(made).collect()
    want = {(1, 1, True), (None, 1, False), (None, None, True), (5, 5, True), (5, 1, False), (7, 7, True)}
    assert {(r.doc_id, r.component_id, r.kept) for r in all_} == want and len(all_) == len(given)


def test_other_width_and_percent(spark):
    given = [(1, "a b c d e f g h i j"), (2, "a b c d e f g h i z"), (3, "q r s t u v w x y z")]
    made = spark.createDataFrame([(i, t, "", "", 0, "") for i, t in given], SCHEMA)
    assert neardup.keep_one(made).count() == 3
    assert sorted(r.doc_id for r in neardup.keep_one(made, width=1, percent=80).collect()) == [1, 3]


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert neardup.near_duplicates(empty).collect() == [] and neardup.keep_one(empty).collect() == []
    blank = spark.createDataFrame([(1, None, "", "", 0, ""), (2, "  ", "", "", 0, "")], SCHEMA)
    assert sorted(tuple(r) for r in neardup.near_duplicates(blank).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]
