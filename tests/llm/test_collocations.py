"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter

import pytest

from recado.llm import collocations as c
from recado.llm.ranks import first_rows
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string"


def lower(text):
    return "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text)


def brute(rows, least, longest, top):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    f = {k: v for k, v in f.items() if v >= least}
    out = []
    for lang in n:
        found = []
        for (of, p), a in f.items():
            if of != lang or len(p) < 2:
                continue
            inside = any(o == lang and len(q) > len(p) and 100 * m >= 100 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                         for (o, q), m in f.items())
            if not inside:
                cuts = [(1000 * a * n[lang] // (f[lang, p[:j]] * f[lang, p[j:]]), j) for j in range(1, len(p))]
                score, j = min(cuts)
                found.append((-score, -a, " ".join(p).encode(), f[lang, p[:j]], f[lang, p[j:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out, key=repr)


def texts(seed=3, n=120):
    rng = random.Random(seed)
    words = ["of", "the", "New", "york", "é", "É", "x", "a-b", "日本", "tea"]
    out = []
    for i in range(n):
        said = [rng.choice(words) for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.5:
            said += "in New York city hall today".split()
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", " ", "\x0b"]) for w in said)
        out.append((i, text, rng.choice(["en", "en", "fr", None])))
    return out


@pytest.mark.parametrize("least,longest,top", [(5, 5, 2000), (3, 5, 7), (20, 3, 10), (1, 2, 5)])
def test_against_plain_count(spark, rows, least, longest, top):
    made = spark.createDataFrame(texts(), SCHEMA).repartition(5)
    assert rows(c.collocations(made, least, longest, top)) == brute(texts(), least, longest, top)


def test_nulls_repeats_clashing_columns_and_long_texts(spark, rows):
    given = [(1, None, "en"), (None, "a b. a b", "en"), (None, "a b. a b", "en"), (2, "", None), (3, " \t.,", "und"),
             (4, "a b " * 20_000, "fr"), (5, "w" * 300_000 + " b", "fr")]
    made = spark.createDataFrame([(*r, 0, 1, "z", "q") for r in given], f"{SCHEMA}, n long, rank int, words string, phrase string")
    got = c.collocations(made, 2, 3)
    assert rows(got) == brute(given, 2, 3, 2000)
    assert got.dtypes == [("lang", "string"), ("rank", "bigint"), ("phrase", "string"), *[(x, "bigint") for x in ("a", "l", "r", "n", "score")]]
    assert c.collocations(made.limit(0), 2).collect() == []
    assert c.collocations(made.where("text IS NULL"), 2).collect() == []


def test_semi_join_by_bits_loses_nothing_and_counts_stay_exact(spark, rows):
    rng = random.Random(1)
    given = [(i, " ".join(f"w{int(rng.expovariate(0.002))}" for _ in range(300)), "en") for i in range(40)]
    # 15 bits make a crowded table: what passes by chance must fall at the next count
    assert rows(c.collocations(spark.createDataFrame(given, SCHEMA), 2, 4, bits=15)) == brute(given, 2, 4, 2000)


def test_scores_beyond_64_bits(spark):
    big = 10 ** 13
    made = spark.createDataFrame([(big, 10 * big, 3, 7)], "f long, n long, l long, r long")
    d = lambda x: F.col(x).cast("decimal(38,0)")
    got = made.withColumns({"u": F.lit(1).cast("decimal(38,0)") * d("f") * d("n"), "v": d("l") * d("r")}).select(F.expr("u div (v * 1000000000)")).first()[0]
    assert got == big * 10 * big // (21 * 10 ** 9)


def test_clash_of_hashes_ends_the_run(spark):
    counts = "lang string, w1 long, check long, n long"
    five, six = 5 << 32, -6 << 32
    rare = [("en", 1, five, 1), ("en", 1, six, 1), ("en", 2, five | 8, 9), ("en", 2, five | 7, 1)]
    assert c._frequent_words(spark.createDataFrame(rare, counts), 3).collect() == [("en", 2, 10, 7)]
    with pytest.raises(Exception, match="share a hash"):
        c._frequent_words(spark.createDataFrame([("en", 1, five, 2), ("en", 1, six, 1)], counts), 3).collect()


def test_first_rows(spark):
    made = spark.range(2000).select((F.col("id") % 3).alias("k"), (F.col("id") % 50).alias("v"), "id")
    got = first_rows(made, ["k"], [F.col("v"), F.col("id")], 4, ["id"], ways=5).collect()
    want = []
    for k in range(3):
        mine = sorted((i % 50, i) for i in range(2000) if i % 3 == k)[:4]
        want += [(k, v, i, r) for r, (v, i) in enumerate(mine, 1)]
    assert sorted((r["k"], r["v"], r["id"], r["rank"]) for r in got) == sorted(want)
    ties = first_rows(made, ["k"], [F.col("v")], 4, ["id"], ways=5, with_ties=True)
    assert ties.where("k = 0").count() == sum(1 for i in range(2000) if i % 3 == 0 and i % 50 == 0)


def test_a_reader_of_a_relation_holds_a_bounded_number_of_blocks(spark, monkeypatch):
    import glob

    import pyarrow.parquet as pq

    rows, real = [], c.remove
    monkeypatch.setattr(c, "remove", lambda spark, path: rows.extend(
        m.row_group(i).num_rows for f in glob.glob(f"{path}/*.parquet") for m in [pq.ParquetFile(f).metadata] for i in range(m.num_row_groups)) or real(spark, path))
    monkeypatch.setattr(c, "small_batches", lambda batch, column: (batch.slice(i, 1) for i in range(batch.num_rows)))
    docs = spark.createDataFrame([("en", "one two three. four five")] * 100, "lang string, text string").coalesce(1)
    found = c.collocations(docs, least=50)
    assert found.count() > 0 and sum(rows) >= 200 and max(rows) <= 16
