"""What grows with the input: tasks of the fit, rows of a task, the bytes of a table of sentences, joins with a dictionary."""

import os
import random

import pytest
from pyspark.sql import functions as F

from recado.functions.stem import STEPS, _pattern, _runs
from recado.operators import comments as c
from recado.operators import sentences as s
from recado.operators import vectors as v
from recado.operators.tags import ContextLexicon
from recado.plans import clean as pc
from recado.plans import report
from recado.profiles import PT
from recado.sources import files, store
from recado.streaming import ingest
from suite import adapters as a
from suite import queries as q
from suite.profile import TEST


def test_a_text_is_stored_about_once_for_all_its_sentences(spark, tmp_path):
    draw = random.Random(1)
    text = " ".join("".join(draw.choices("abcdefghijklmnop", k=8)) + draw.choice([" ", " ", ". "]).strip() for _ in range(20_000))
    comments = spark.createDataFrame([(1, "2024-01-01", "u", "https://a/b/c", "x", text)],
                                     "comment_id long, interaction_date string, user_name string, url string, content_type string, text string")
    path = str(tmp_path / "cleaned")
    report.clean_and_count(comments, TEST, path)
    assert spark.read.parquet(path).count() > 500
    assert sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path) if f.endswith(".parquet")) < 5 * len(text)


def test_tasks_of_local_tables_have_a_bounded_number_of_rows(spark):
    assert a.spread(spark.range(a.TASK_ROWS * 9 - 5)).rdd.getNumPartitions() == 9
    assert a.spread(spark.range(10)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_copies_of_a_large_dictionary_are_not_broadcast(spark):
    lexicon = spark.createDataFrame([("casas", "NOUN", "casa"), ("foi", "VERB", "ir")], "surface string, pos string, lemma string")
    df = spark.createDataFrame([(1, "as casas"), (2, "foi"), (3, "nada")], "comment_id long, text string")
    found = s.lemmatise_by_join(df, lexicon, ["comment_id"], small_rows=0)
    assert "strategy=merge" in found._jdf.queryExecution().optimizedPlan().toString()
    assert {r.comment_id: r.text for r in found.collect()} == {1: "as casa", 2: "ir", 3: "nada"}


def test_a_small_dictionary_goes_with_the_plan(spark):
    lexicon = spark.createDataFrame([("casas", "NOUN", "casa"), ("casas", "NOUN", "casar"), ("foi", "VERB", "ir"), ("os", "DET", "o"), (None, "NOUN", "x")],
                                    "surface string, pos string, lemma string")
    df = spark.createDataFrame([(1, "as  casas "), (2, "foi os"), (3, ""), (4, None), (None, "foi")], "comment_id long, text string")
    found = s.lemmatise_by_join(df, lexicon, ["comment_id"])
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    joined = s.lemmatise_by_join(df, lexicon, ["comment_id"], small_rows=1)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, joined.collect()), key=repr)
    assert {r.comment_id: r.text for r in found.where(F.col("comment_id").isNotNull()).collect()} == {1: "as  casa ", 2: "ir os", 3: "", 4: None}


@pytest.mark.parametrize("n_sentences,n_words", [(0, 0), (10, 5), (4_400_000, 132_000), (30_000_000, 620_000), (200_000_000, 3_000_000)])
def test_a_round_of_the_fit_hands_on_a_bounded_number_of_vectors(n_sentences, n_words):
    tasks = v.fit_tasks(n_sentences, n_words, 200)
    assert 1 <= tasks <= 1 + n_sentences // v.TASK_SENTENCES
    assert tasks == 1 or tasks * n_words * 200 * 8 <= v.ROUND_BYTES


def test_fits_have_the_tasks_that_the_bound_allows(spark, monkeypatch):
    asked, real, tasks = [], v.word2vec, v.fit_tasks
    monkeypatch.setattr(v, "TASK_SENTENCES", 2)
    monkeypatch.setattr(v, "fit_tasks", lambda n, w, d: tasks(n, w, d, 3 * 2 * 4 * 4 * 2))  # three models of two words
    monkeypatch.setattr(v, "word2vec", lambda partitions, **o: asked.append(partitions) or real(partitions=partitions, **o))
    tokenized = spark.createDataFrame([(["x", "y"],)] * 40, "tokens array<string>")
    v.fit_words(tokenized, vector_size=4, min_count=5, max_iter=1)
    assert asked == [3]


def test_word_table_holds_the_models_vectors(spark):
    tokenized = spark.createDataFrame([(["x", "y", "z"],)] * 20, "tokens array<string>")
    words = v.fit_words(tokenized, vector_size=4, min_count=5, max_iter=1)
    table = v.word_table(words)
    held = {r.word: list(r.vector) for r in words.getVectors().collect()}
    found = {r.word: r.vector for r in table.collect()}
    assert found.keys() == held.keys() and all(found[w] == pytest.approx(held[w]) for w in held)
    assert "LocalTableScan" not in table._jdf.queryExecution().executedPlan().toString()


def test_word_means_over_blocks_repeated_and_null_keys(spark, monkeypatch):
    monkeypatch.setattr(q, "BLOCK_SENTENCES", 2)
    monkeypatch.setattr(q, "BLOCK_WORDS", 3)
    vectors = spark.createDataFrame([("x", [1.0, 0.0]), ("y", [0.0, 4.0])], "word string, vector array<float>")
    given = [(1, 0, ["x", "y", "u"]), (1, 1, ["x", "x", "x", "y"]), (2, 0, ["u"]), (3, 0, []), (4, 0, ["x"]), (4, 0, ["y"]), (None, 0, ["x"]), (5, 0, None)]
    found = q._word_means(spark.createDataFrame(given, "comment_id long, sentence_idx int, tokens array<string>"), vectors).collect()
    assert sorted(((r.comment_id, r.sentence_idx, r.n_known, r.mean) for r in found), key=repr) == sorted([
        (1, 0, 2, [0.5, 2.0]), (1, 1, 4, [0.75, 1.0]), (2, 0, 0, None), (3, 0, 0, None), (4, 0, 2, [0.5, 2.0]), (4, 0, 2, [0.5, 2.0]),
        (None, 0, 0, None), (5, 0, 0, None)], key=repr)


def test_a_stem_is_looked_for_at_the_ends_of_words_only():
    for step in STEPS:
        for run in _runs([r for r in PT.stem_rules if r.step == step]):
            assert _pattern(run).startswith(" (?:")


def test_a_trace_goes_through_a_comment_once_and_only_gives_the_stages_asked_for(spark):
    rows = [(1, "2024-01-01", "a", "", "casas bonitas chegaram hoje. foi bom"), (2, "2024-01-02", None, "", "@x hello"),
            (3, "2024-01-03", "b", "", "Maria Souza, hi"), (4, "2024-01-01", "a", "", "")]
    df = spark.createDataFrame(rows, "comment_id long, interaction_date string, user_name string, url string, text string")
    trace = pc.clean_trace(df, TEST)
    assert "Union" not in trace._jdf.queryExecution().optimizedPlan().toString()
    some = pc.clean_trace(df, TEST, stages=("names", "letters"))
    assert sorted(map(tuple, some.collect()), key=repr) == sorted(map(tuple, trace.where("stage IN ('names', 'letters')").collect()), key=repr)
    assert {r.comment_id for r in some.where("sentence_idx IS NULL").collect()} == {1, 4}


@pytest.mark.parametrize("n,cores,least,most", [(0, 12, 1, 1), (50_000, 12, 48, 48), (3_000_000, 12, 600, 601)])
def test_text_work_has_many_tasks_a_core_and_bounded_ones(n, cores, least, most):
    assert least <= pc.text_tasks(n, cores) <= most


def test_texts_are_cleaned_in_tasks_of_their_own(spark):
    comments = spark.createDataFrame([(i, "2024-01-01", "u", "https://a/b/c", "x", f"text {i}") for i in range(1000)],
                                     "comment_id long, interaction_date string, user_name string, url string, content_type string, text string")
    assert pc.prepared_comments(comments).rdd.getNumPartitions() == pc.text_tasks(1000, spark.sparkContext.defaultParallelism) == 11


COMMENT = "comment_id long, interaction_date string, user_name string, url string, content_type string, text string"


def _long_comments(spark, n):
    draw = random.Random(3)
    texts = [" ".join("".join(draw.choices("abcdefghijklmnop", k=8)) + draw.choice([" ", " ", ". "]).strip() for _ in range(1_500)) for _ in range(n)]
    return texts, spark.createDataFrame([(i, "2024-01-01", f"u{i % 7}", f"https://a/p/{i}", "x", x) for i, x in enumerate(texts)], COMMENT)


def test_cleaned_sentences_are_written_with_each_text_about_once(spark, tmp_path):
    texts, comments = _long_comments(spark, 300)
    found = pc.clean_tagged(comments, TEST)
    found.write.parquet(str(tmp_path / "out"))
    assert found.count() > 10 * len(texts) and _size(tmp_path / "out") < 2 * sum(map(len, texts))
    assert pc.clean_tagged(comments, TEST, with_texts=False).rdd.getNumPartitions() < found.rdd.getNumPartitions()


def test_texts_are_shuffled_once_and_hot_copies_once_a_task(spark, monkeypatch):
    rows = [(i % 3, "2024-01-01", "u", "https://a/p/1", "x", f"text {i % 3} {'twice' if i > 57 else ''}") for i in range(60)]
    comments = spark.createDataFrame(rows, COMMENT).repartition(2)
    want = sorted(map(tuple, c.texts_once(c.with_ids(comments)).collect()))
    prepared = pc.prepared_comments(comments)
    prepared.collect()
    plan = prepared._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 2 and plan.count("original_text") < 3  # one of the texts, one of narrow rows
    assert sorted(map(tuple, c.texts_dealt(c.with_ids(comments), 5).collect())) == want and len(want) == 5
    dealt = c.texts_dealt(c.with_ids(comments), 5, hot_copies=4)
    assert sorted(map(tuple, dealt.collect())) == want and dealt.rdd.getNumPartitions() == 5


def test_sentences_are_not_stored_for_a_dictionary_that_is_looked_up_in_place(spark, monkeypatch):
    names, real = [], s.staged
    monkeypatch.setattr(s, "staged", lambda df, name: names.append(name) or real(df, name))
    monkeypatch.setattr(pc, "staged", lambda df, name: names.append(name) or real(df, name))
    comments = spark.createDataFrame([(1, "2024-01-01", "u", "https://a/p/1", "x", "thin thes reed ntre sion"), (2, "2024-01-01", "v", None, "x", "@x no")], COMMENT)
    table = s.lexicon_table(spark, TEST)
    found = sorted(map(tuple, pc.clean_tagged(comments, TEST, lexicon=table).collect()))
    assert names == ["comments-once"]
    monkeypatch.setattr(s, "LITERAL_LEMMAS", 1)  # larger: joined, and stored first
    assert sorted(map(tuple, pc.clean_tagged(comments, TEST, lexicon=table).collect())) == found and "sentences-before-lemmas" in names


def test_points_of_a_local_table_are_dealt_over_the_cores(spark, monkeypatch, tmp_path):
    spark.range(400).select(F.col("id").alias("vec_id"), F.array(*[F.sin(F.col("id") * k).cast("float") for k in range(1, 5)]).alias("embedding")).coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    seen, fit = [], v.fit_kmeans
    monkeypatch.setattr(v, "fit_kmeans", lambda points, seeds: seen.append(points.rdd.getNumPartitions()) or fit(points, k=5, seeds=seeds))
    assert q.kmeans_fit(spark, str(tmp_path)).where("at_nearest").count() == 400
    assert seen == [spark.sparkContext.defaultParallelism]


def _size(path):
    return sum(os.path.getsize(os.path.join(at, f)) for at, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_ingested_sentences_are_written_with_each_text_about_once(spark, tmp_path, monkeypatch):
    draw, n = random.Random(2), 300
    texts = [" ".join("".join(draw.choices("abcdefghijklmnop", k=8)) + draw.choice([" ", " ", ". "]).strip() for _ in range(1_500)) for _ in range(n)]
    rows = [(i, "2024-01-01", f"u{i % 7}", f"https://a/p/{i}", "x", x) for i, x in enumerate([*texts, *texts[:1] * 25])]
    files.write_comments(spark.createDataFrame(rows, files.COMMENT_SCHEMA).repartition(4), str(tmp_path / "in"), "infer")
    root = str(tmp_path / "root")
    ingest.ingest_comments(ingest.arriving_comments(spark, str(tmp_path / "in")), TEST, root, str(tmp_path / "ck"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plainly = sorted(map(repr, ingest.ingested_sentences(spark, root).collect()))
        monkeypatch.setattr(ingest, "HOT_COMMENTS", 3)  # the text that many hold is dealt out
        found = ingest.ingested_sentences(spark, root)
        found.write.parquet(str(tmp_path / "out"))
        assert sorted(map(repr, found.collect())) == plainly
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert _size(tmp_path / "out") < 2 * sum(map(len, texts))
    assert len(os.listdir(tmp_path / "root" / "texts")) == 1 and spark.read.parquet(f"{root}/texts").count() == n


def test_a_first_merge_stages_the_results_once(spark, tmp_path, monkeypatch):
    names, real = [], store.staged
    monkeypatch.setattr(store, "staged", lambda df, name: names.append(name) or real(df, name))
    new = spark.createDataFrame([("2024-01-01", "u", "x", "t", "a", None, None, None, None, None)], files.RESULT_SCHEMA.replace(" date", " string")).withColumn(
        "interaction_date", F.col("interaction_date").cast("date"))
    before = new.select("interaction_date").limit(0)
    store.replace_texts(new, before, str(tmp_path / "store"))
    assert names == ["new-results"]
    store.replace_texts(new, before, str(tmp_path / "store"))
    assert names == ["new-results", "new-results", "merged-results"] and store.read_store(spark, str(tmp_path / "store")).count() == 1


def test_a_large_dictionary_goes_by_blocks_and_gives_what_a_small_one_gives(spark, monkeypatch):
    monkeypatch.setattr(s, "BLOCK_BYTES", 40)
    draw = random.Random(4)
    given = [(i // 2 if i % 9 else None, " ".join(draw.choices(["casas", "foi", "os", "x", ""], k=5))) for i in range(60)] + [(100, None), (101, ""), (102, "x x")]
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(given)], "row int, comment_id long, text string")
    entries = spark.createDataFrame([("casas", "NOUN", "casa"), ("casas", "VERB", "casar"), ("foi", "VERB", "ir"), ("os", "DET", "o"), (None, "NOUN", "x")],
                                    "surface string, pos string, lemma string")
    parts = df.select("row", "comment_id", F.array(F.struct(F.lit(0).alias("sentence_idx"), "text")).alias("_parts"))
    small, large = (s.fit_tags(parts, entries, "_parts", ["row"], small_rows=n) for n in (100, 0))
    assert small == large
    for lexicon in (entries, ContextLexicon(entries, small)):
        want, found = (s.lemmatise_by_join(df, lexicon, ["row"], small_rows=n) for n in (100, 0))
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect())) and "casa" in repr(found.collect())
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "FlatMapCoGroupsInArrow" in plan and "sha2" not in plan
