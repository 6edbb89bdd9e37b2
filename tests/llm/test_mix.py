import math
import re

import pytest

from recado.llm import mix

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, taken string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """Shares by repeated sharing: sources over three times their size are set to it, the excess goes round again."""
    names = sorted((n for n in sizes if n is not None), key=lambda n: [ord(c) for c in n]) + ([None] if None in sizes else [])
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = [n for n in names if n not in full]
        if not rest:
            return {n: 3.0 * sizes[n] for n in names}
        level = (total - sum(3 * sizes[n] for n in full)) / sum(weight[n] for n in rest)
        over = {n for n in rest if level * weight[n] > 3 * sizes[n]}
        if not over:
            return {n: 3.0 * sizes[n] if n in full else level * weight[n] for n in names}
        full |= over


@pytest.fixture(scope="module")
def docs(spark):
    rows = []
    for i in range(900):
        source = [None, "a", "b", "é", "Z", ""][0 if i % 3 == 0 else i % 6]
        rows.append((i, " ".join(["w"] * (i * 7 % 23)) + "\n", "en", source, 5, "clash", "clash"))
    rows += [(3, "same row twice", "en", "a", 5, None, None)] * 2 + [(None, "no id here", "en", "b", 5, None, None), (5000, None, "en", "b", 5, None, None),
             (5001, "", "en", "only-empty", 0, None, None), (5002, "long " * 5000, "en", "Z", 0, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def test_budgets_are_met_exactly(spark, docs, monkeypatch):
    monkeypatch.setattr(mix, "RANGE_ROWS", 40)  # many ranges in a source
    rows = [tuple(r) for r in mix.mix(docs).collect()]
    assert len(rows) == docs.count()
    sizes = {}
    for r in docs.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(WORD.findall(r.text or ""))
    expected = targets(sizes)
    by_target = {round(t, 6): 0 for t in expected.values()}
    for _, size, source_size, target, n in rows:
        assert source_size in sizes.values() and 0 <= n <= 3 * size
        by_target[round(target, 6)] += n
    wanted = {}
    for t in expected.values():
        wanted[round(t, 6)] = wanted.get(round(t, 6), 0) + math.floor(round(t, 6))
    assert by_target == wanted


def test_reruns_agree_and_seeds_differ(docs):
    one = sorted(map(tuple, mix.mix(docs).collect()), key=repr)
    assert one == sorted(map(tuple, mix.mix(docs.repartition(7)).collect()), key=repr)
    assert one != sorted(map(tuple, mix.mix(docs, seed=1).collect()), key=repr)


def test_documents_of_the_mix_have_the_words_taken(docs):
    clean = docs.dropDuplicates(["doc_id", "text"])
    taken = {r.doc_id: r.taken for r in mix.mix(clean).collect()}
    out = mix.mixed_documents(clean)
    assert out.columns == clean.columns and out.dtypes == clean.dtypes
    found = {}
    for r in out.collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + len(WORD.findall(r.text))
    assert found == {i: n for i, n in taken.items() if n}


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mix.mix(empty).collect() == [] and mix.mixed_documents(empty).collect() == []
    wordless = spark.createDataFrame([(1, " \n", "en", "a", 0, None, None), (2, None, "en", None, 0, None, None)], SCHEMA)
    assert sorted(tuple(r) for r in mix.mix(wordless).collect()) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert mix.mixed_documents(wordless).collect() == []
