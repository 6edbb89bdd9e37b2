"""Ranked search against a plain score of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from recado.llm import lexical, ranks

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")


def brute(docs, items, k=20):
    terms = [(d, TERM.findall(lower(t))) for d, t in docs]
    terms = [(d, t) for d, t in terms if t]
    n_docs, n_terms = len(terms), sum(len(t) for _, t in terms)
    df = Counter(w for _, t in terms for w in set(t))
    out = []
    for item, text in items:
        asked, found = TERM.findall(lower(text)), []
        for doc, t in terms:
            tf, m, score = Counter(t), 75 + (25 * len(t) * n_docs) // n_terms, 0
            for w in asked:
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10 ** 9 * tf[w]) // (1000 * tf[w] + 12 * m))
            if score > 0:
                found.append((-score, doc is None, doc))
        out += [(item, r, doc, -score) for r, (score, _, doc) in enumerate(sorted(found, key=lambda x: (*x[:2], x[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


def corpus(seed=5):
    rng = random.Random(seed)
    words = "the of Tea cup ÉTÉ été x1 日本 naïve_it don't a-b  z \x7fq".split(" ")
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 30)))) for i in range(150)]
    docs += [(7, docs[7][1]), (None, "tea tea cup"), (None, None), (900, ""), (901, "?!,. \n"), (902, "tea " * 40_000)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 12)))) for i in range(12)] + [(50, "tea TEA tea unknown"), (51, "...")]
    return docs, items


@pytest.mark.parametrize("block_chars", [lexical.BLOCK_CHARS, 100])
def test_against_plain_scores(spark, rows, block_chars):
    docs, items = corpus()
    got = lexical.ranked(spark.createDataFrame(docs, "doc_id long, text string").repartition(6),
                         spark.createDataFrame(items, "item_id long, text string"), block_chars=block_chars)
    assert rows(got) == brute(docs, items)


def test_best_are_cut_on_the_way(monkeypatch):
    monkeypatch.setattr(ranks, "PENDING", 8)
    rng = random.Random(2)
    given = [(rng.randrange(4), rng.randrange(30), rng.random() < 0.2, rng.randrange(1, 6)) for _ in range(300)]
    best = ranks.Best(4, 3)
    for start in range(0, 300, 7):
        item, doc, unnamed, score = (np.array(x) for x in zip(*given[start:start + 7], strict=True))
        open_ = score >= best.least[item]
        best.add(item[open_], doc[open_], unnamed[open_], score[open_])
    want = [r for i in range(4) for r in sorted((r for r in given if r[0] == i), key=lambda r: (-r[3], r[2], r[1]))[:3]]
    assert list(zip(*(x.tolist() for x in best.cut()), strict=True)) == want


def test_terms_are_whole_and_share_their_blanks():
    terms = lexical.Automaton(["a b", "ab a"])
    import pyarrow as pa

    (n, there, tf), (none, _, _) = terms.counts(terms.searcher(), pa.array(["A a-ab.Bé b", None]))
    assert n == 5 and none == 0
    assert {terms.terms[t]: int(x) for t, x in zip(there, tf, strict=True)} == {"a": 2, "ab": 1, "b": 1}


def test_empty_tables_repeated_items_and_other_columns(spark, rows):
    docs = spark.createDataFrame([(1, "tea", 3, 9)], "doc_id long, text string, item_id long, score long")
    items = spark.createDataFrame([("x", "tea cup", 1), ("x", "tea", 1), (None, "tea", 1), ("y", None, 1)], "item_id string, text string, doc_id long")
    one = brute([(1, "tea")], [("x", "tea"), (None, "tea")])
    assert rows(lexical.ranked(docs, items)) == one
    assert lexical.ranked(docs.limit(0), items).collect() == []
    assert lexical.ranked(docs, items.limit(0)).collect() == []
