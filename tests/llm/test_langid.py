"""Language ID: backoff by hand, held-out accuracy, and odd rows."""

import math
import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recado.llm import langid

SF_DIR = "/root/testdata/sf0.001"


def plain_counts(rows, longest):
    """Words and n-grams of each language, counted one by one."""
    out = {}
    for lang, text in rows:
        for word in langid.WORD.findall(text.lower()):
            for size in range(longest + 1):
                marked = word if size < 2 else f"<{word}>"
                for gram in [word] if size == 0 else [marked[i:i + size] for i in range(len(marked) - size + 1)]:
                    out[lang, size, gram] = out.get((lang, size, gram), 0) + 1
    return out


def test_model_counts_words_and_parts(spark):
    given = [("en", "The cat, the hat. X"), ("fr", "le chat ÉTÉ été"), ("fr", "le")]
    got = {(r["lang"], r["size"], r["key"]): (r["n"], r["total"]) for r in
           langid.counted(spark.createDataFrame(given, "lang string, text string")).collect()}
    want = plain_counts(given, langid.LONGEST)
    assert {k: n for k, (n, _) in got.items()} == want
    assert all(total == sum(n for (a, b, _), n in want.items() if (a, b) == (lang, size)) for (lang, size, _), (_, total) in got.items())


def plain_prediction(counts, text):
    """The method, word by word."""
    languages = sorted({k[0] for k in counts})
    total = {(lang, size): sum(n for (a, b, _), n in counts.items() if (a, b) == (lang, size)) for lang in languages for size in range(langid.LONGEST + 1)}
    log = lambda lang, size, key: math.log(counts[lang, size, key] / total[lang, size]) if (lang, size, key) in counts else langid.MISSING
    known = lambda size, key: any((lang, size, key) in counts for lang in languages)
    sums = dict.fromkeys(languages, 0.0)
    words = langid.WORD.findall(text.lower())
    for word in words:
        used = [(0, word)] if known(0, word) else []
        for size in range(langid.LONGEST, 0, -1):
            if not used:
                marked = word if size == 1 else f"<{word}>"
                used = [(size, marked[i:i + size]) for i in range(len(marked) - size + 1) if known(size, marked[i:i + size])]
        for lang in languages:
            sums[lang] += sum(log(lang, *u) for u in used) / len(used) if used else langid.MISSING
    if not words:
        return "und", 0.0
    best = max(languages, key=lambda x: (sums[x], [-ord(c) for c in x]))
    evidence = min(len(words), langid.EVIDENCE) / len(words)
    return best, 1 / sum(math.exp((sums[x] - sums[best]) * evidence) for x in languages)


def test_predictions_against_the_method_word_by_word(spark):
    given = [("en", "the cat sat on the mat with thin things"), ("fr", "le chat est sur le tapis avec des choses fines"), ("de", "die Katze sitzt auf der Matte")]
    counts = plain_counts(given, langid.LONGEST)
    model = langid.Model(langid.counted(spark.createDataFrame(given, "lang string, text string")).toArrow())
    asked = ["the chat", "sitzend", "thinking fine", "qqq", "日本", "12 !", "", "Éa", "a" * 500, "le the die", "chats the the the the the the the the the the the the the"]
    made = spark.createDataFrame([(i, t) for i, t in enumerate(asked)], "doc_id long, text string")
    for r in langid.predict(made, model).collect():
        name, score = plain_prediction(counts, r["text"])
        assert (r["lang_pred"], round(r["score"], 4)) == (name, round(score, 4)), r["text"]


def test_pieces_end_between_words(monkeypatch):
    monkeypatch.setattr(langid, "PIECE", 5)
    text = "ab cdefghijkl, mÉ. x " * 7 + "longlast"
    assert [w for words in langid.words_in(text) for w in words] == langid.WORD.findall(text.lower())
    assert list(langid.words_in(None)) == []


def test_unseen_words_are_forgotten_without_a_change(monkeypatch):
    table = pa.table({"lang": ["a", "b", "a"], "size": [0, 1, 1], "key": ["x", "y", "z"], "n": [1, 2, 3], "total": [4, 5, 6]})
    model = langid.Model(table)
    first = langid._Words(model).sum(["x", "yy", "zy", "q"])
    monkeypatch.setattr(langid, "CACHE", 1)
    words = langid._Words(model)
    for _ in range(3):
        words.sum([f"y{c}z" for c in "abcdefgh"])
    assert np.allclose(words.sum(["x", "yy", "zy", "q"]), first)


def test_nulls_empty_tables_repeats_and_clashing_columns(spark, rows):
    given = [(1, "the cat", "en", 0.5, "k"), (None, "le chat", "fr", 0.5, "k"), (2, None, "en", 0.5, "k"), (2, "123", None, 0.5, "k"), (1, "the cat", "en", 0.5, "k")]
    made = spark.createDataFrame(given, "doc_id long, text string, lang string, total double, key string")
    model = langid.train(made)
    got = rows(langid.predict(made, model, keep=["doc_id", "key"]).select("doc_id", "lang_pred", "key"))
    assert got == sorted([(1, "en", "k"), (1, "en", "k"), (None, "fr", "k"), (2, "und", "k"), (2, "und", "k")], key=repr)
    none = langid.train(made.limit(0))
    assert none.languages == []
    assert {r["lang_pred"] for r in langid.predict(made, none).collect()} == {"und"}
    assert langid.predict(made.limit(0), model).collect() == []


def test_learns_from_its_fold_only(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("word"), F.col("id")).alias("text"), F.lit("en").alias("lang"))
    learnt = langid.learnable(docs).count()
    assert learnt == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(400))


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = langid.predict(docs, langid.train(docs), keep=["doc_id", "lang"]).where(langid.held_out("doc_id")).collect()
    assert len(got) > 30 and sum(r["lang"] == r["lang_pred"] for r in got) >= 0.98 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)
