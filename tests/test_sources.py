"""Files, look-ups, models and streams."""

import datetime as dt
import os

import pytest

from recado import PT, PT_TAXONOMY, extract_comments
from recado.operators import naming
from recado.operators import vectors as v
from recado.plans import train
from recado.sources import files, lookup, models, staging, store
from recado.streaming import counts, ingest

AWKWARD = ["plain", "two\nlines", 'say "hi", ok; done', "back\\slash", "'single'", " edge spaces ", "semi;colon", "ação ☕", None]


@pytest.mark.parametrize("dialect", files.DIALECTS)
def test_comment_files(spark, rows, tmp_path, dialect):
    df = spark.createDataFrame([(i, "2024-01-01", None, "u", "c", x) for i, x in enumerate(AWKWARD)], files.COMMENT_SCHEMA)
    path = str(tmp_path / dialect)
    files.write_comments(df, path, dialect)
    assert rows(files.read_comments(spark, path, dialect)) == rows(df)


def test_result_files_quote_everything(spark, tmp_path):
    values = [(dt.date(2024, 1, 2), "u", None, "c", 'a "b"\nc', None, None, None, None, "12345678")]
    path = str(tmp_path / "r")
    files.write_results(spark.createDataFrame(values, files.RESULT_SCHEMA), path, "csv")
    text = "".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    assert text.startswith('"interaction_date","user_name"')
    assert '"2024-01-02","u",' in text


def test_extract(spark):
    raw = [("2024-01-02 10:00:00", '{"user_name": "Ana", "key": "instagram_user"}', "u", "1"),
           ("2021-01-02 10:00:00", '{"user_name": "Ana", "key": "instagram_user"}', "u", "2"),
           ("2024-01-02 10:00:00", '{"user_name": "LOJA", "key": "instagram_user"}', "u", "3"),
           ("2024-01-02 10:00:00", '{"user_name": "Ana", "key": "facebook_user"}', "u", "4"),
           ("2024-01-02 10:00:00", '{"key": "instagram_user"}', "u", "5"),
           ("2024-01-03 23:59:59", '{"user_name": "Bia", "key": "instagram_user"}', None, "6"),
           ("2024-01-03 23:59:59", '{"user_name": "Bia", "key": "instagram_user"}', None, "6")]
    df = spark.createDataFrame(raw, "created_at string, social_media string, url string, text string")
    found = extract_comments(df, "instagram_user", "Loja", "2022-01-01").orderBy("text").collect()
    assert [(r.text, str(r.interaction_date), r.user_name) for r in found] == [
        ("1", "2024-01-02 00:00:00", "Ana"), ("6", "2024-01-03 00:00:00", "Bia")]


def test_lookup_json(spark, rows, tmp_path):
    df = spark.createDataFrame([(0, "Ação", "Preço"), (1, None, None), (12, "x", None)],
                               "subclusters_id int, cluster string, problema string")
    path = str(tmp_path / "lookup")
    lookup.write_lookup_json(df, path)
    assert rows(lookup.read_lookup_json(spark, path)) == rows(df)
    assert "Ação" in spark.read.text(path).first().value


def test_taxonomy_file(spark, tmp_path):
    path = tmp_path / "terms.json"
    path.write_text('{"B label": ["x y", "z w"], "A label": ["x y"]}', encoding="utf-8")
    taxonomy = PT_TAXONOMY.with_terms(lookup.read_taxonomy_terms(spark, str(path)))
    assert taxonomy.label_terms() == [("B label", 0, "x y"), ("B label", 0, "z w"), ("A label", 1, "x y")]


def test_latest_model(spark):
    registry = spark.createDataFrame([("c-a", "2024-01-02", "p1"), ("c-a", "2024-01-03", "p2"), ("c-b", "2024-01-09", "p3")],
                                     "name string, created_at string, path string")
    assert models.latest_model(registry, "c-a").first()["path"] == "p2"
    assert models.latest_model(registry, "none").first()["path"] is None


def clustered(spark, sentences):
    return spark.createDataFrame(sentences, "subclusters_id int, text string")


def test_names_with_few_pairs(spark):
    taxonomy = PT_TAXONOMY.with_terms([("Second", ["c d"]), ("Pedido não chegou", ["a b", "x y"]), ("Spam", ["a b"])])
    df = clustered(spark, [(0, "one"), (1, "a b"), (2, "c d a b"), (2, "c d"), (3, "p q r s t u"), (3, "x y"),
                           (4, "m n"), (4, "m n"), (4, "a b"), (4, "a b")])
    found = {r.subclusters_id: (r.cluster, r.problema, r.size) for r in naming.build_lookup(df, taxonomy).collect()}
    assert found == {
        0: (None, None, 1), 1: ("Pedido não chegou", "Entrega não efetuada", 1), 2: ("Second", None, 2), 3: (None, None, 2),
        4: ("Pedido não chegou", "Entrega não efetuada", 4)}


def test_top_pairs_break_ties_by_name(spark):
    top = naming.top_bigrams(naming.bigram_counts(clustered(spark, [(0, "b c d e f g")])))
    assert [r.bigram for r in top.orderBy("rnk").collect()] == ["b c", "c d", "d e", "e f"]


def test_audits(spark):
    taxonomy = PT_TAXONOMY.with_terms([("Spam", ["a b", "a b"]), ("Pedido não chegou", ["c d"])])
    found = train.audit_taxonomy(clustered(spark, [(0, "q r s"), (1, "a b")]), taxonomy)
    assert [r.label for r in found["labels_without_problem"].collect()] == ["Spam"]
    assert [(r.term, r.n) for r in found["duplicate_terms"].collect()] == [("a b", 2)]
    assert sorted(r.bigram for r in found["unnamed_clusters"].collect()) == ["q r", "r s"]


@pytest.fixture(scope="module")
def training(spark):
    texts = ["pedido chegou hoje certo", "pedido nunca chegou loja", "dinheiro volta agora loja", "pedido chegou certo agora"] * 30
    df = spark.createDataFrame([(i, 0, x) for i, x in enumerate(texts)], "comment_id long, sentence_idx int, text string")
    return df, train.train_on_sentences(df, PT_TAXONOMY.with_terms([("Spam", ["pedido chegou"])]), k=3, min_count=35, seeds=(42,),
                                        vector_size=8, max_iter=1, partitions=1)


def test_sentence_vector_is_the_mean_of_known_words(spark, training):
    model = training[1].model
    words = {r.word: list(r.vector) for r in model.pipeline.stages[0].getVectors().collect()}
    assert set(words) == {r.word for r in model.vocabulary.collect()} == {"pedido", "chegou", "certo", "loja", "agora"}
    df = spark.createDataFrame([(1, 0, "pedido zzz loja"), (2, 0, "zzz"), (3, 0, "")],
                               "comment_id long, sentence_idx int, text string")
    found = {r.comment_id: list(r.features) for r in train.predict(model, df).collect()}
    assert found[1] == pytest.approx([(a + b) / 2 for a, b in zip(words["pedido"], words["loja"], strict=True)], abs=1e-6)
    assert found[2] == found[3] == [0.0] * 8


def test_assigned_cluster_is_the_closest(spark, training):
    model = training[1].model
    centers = model.pipeline.stages[1].clusterCenters()
    predicted = train.predict(model, training[0])
    for r in predicted.limit(4).collect():
        distances = [sum((a - b) ** 2 for a, b in zip(r.features, c, strict=True)) for c in centers]
        assert distances[r.subclusters_id] == pytest.approx(min(distances))
    table = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(centers)], "subclusters_id int, center array<double>")
    ours = v.assign_clusters(predicted.withColumnRenamed("subclusters_id", "theirs")
                             .withColumn("features", v.vector_to_array("features")), table)
    assert ours.where("theirs <> subclusters_id").count() == 0


def test_model_survives_saving(spark, rows, training, tmp_path):
    models.save_model(training[1].model, str(tmp_path / "m"))
    again = models.load_model(spark, str(tmp_path / "m"))
    keep = ["comment_id", "subclusters_id"]
    assert rows(train.predict(again, training[0]).select(keep)) == rows(train.predict(training[1].model, training[0]).select(keep))


def test_lookup_counts_the_training_rows(training):
    assert sum(r["size"] for r in training[1].lookup.collect()) == 120


def test_sentence_vectors_are_means_of_known_words(spark):
    texts = ["a b c a b c"] * 6 + ["a z a", "z y", ""]
    tokenized = v.tokenize(spark.createDataFrame(list(enumerate(texts)), "comment_id long, text string"))
    words = v.fit_words(tokenized, vector_size=4, min_count=5, max_iter=1)
    known = {r.word: list(r.vector) for r in words.getVectors().collect()}
    assert sorted(known) == ["a", "b", "c"]
    for r in v.sentence_vectors(tokenized, words).collect():
        have = [known[w] for w in r.tokens if w in known]
        want = [sum(x) / len(have) for x in zip(*have, strict=True)] if have else [0.0] * 4
        assert list(r.features) == pytest.approx(want, abs=1e-6)


def test_comment_files_by_header(spark, tmp_path):
    """Columns in another order, no id, no content type, one column more; a wrong header ends the run."""
    path, bad = str(tmp_path / "in"), str(tmp_path / "bad")
    rows = [("meu pedido", "u", "likes 3", "2024-01-01", "x"), ("meu pedido", "u", "likes 3", "2024-01-01", "x"), ("outro; pedido", None, "", "2024-01-02", "y")]
    files.write_comments(spark.createDataFrame(rows, "text string, user_name string, extra string, interaction_date string, url string").coalesce(1), path)
    found = files.read_comments(spark, path).orderBy("text").collect()
    assert [(r.text, r.user_name, r.interaction_date, r.url, r.content_type) for r in found] == [
        ("meu pedido", "u", "2024-01-01", "x", None)] * 2 + [("outro; pedido", None, "2024-01-02", "y", None)]
    assert found[0].comment_id == found[1].comment_id != found[2].comment_id and found[0].comment_id < 0
    files.write_comments(spark.createDataFrame([("a", "b")], "text string, user string"), bad)
    with pytest.raises(ValueError, match="lack the columns"):
        files.read_comments(spark, bad)


def test_files_with_different_headers_end_the_run(spark, tmp_path):
    for name, columns in (("1", ("interaction_date", "user_name", "url", "text")), ("2", ("user_name", "interaction_date", "url", "text"))):
        (tmp_path / f"{name}.csv").write_text(";".join(columns) + "\n2024-01-01;u;x;t\n")
    with pytest.raises(Exception, match="header"):
        files.read_comments(spark, str(tmp_path)).collect()


def test_bad_records_are_kept_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text("interaction_date;user_name;url;text\n2024-01-01;u;x;good\n2024-01-01;u;short\n2024-01-02;u;x;y;long;one\n")
    assert [r.text for r in files.read_comments(spark, str(tmp_path)).collect()] == ["good"]
    assert sorted(r[files.BAD_RECORD] for r in files.read_bad_records(spark, str(tmp_path)).collect()) == ["2024-01-01;u;short", "2024-01-02;u;x;y;long;one"]


def test_staged_tables_go_with_their_scope(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(root))
    with staging.scratch_scope(spark):
        assert staging.staged(spark.range(3), "kept-for-a-while").count() == 3
        assert set(os.listdir(root)) - before
    assert set(os.listdir(root)) == before


def test_a_merge_reads_only_the_dates_of_the_batch(spark, tmp_path):
    path = str(tmp_path / "store")
    day = lambda n: None if n is None else dt.date(2024, 1, n)
    make = lambda ns, order: spark.createDataFrame([(day(n), "u", None, None, f"text {n}", None, None, None, None, order) for n in ns], files.RESULT_SCHEMA)
    root = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(root))
    store.merge_into_store(make([1, 2, 3, None], "old"), path)
    plan = store.stored_on(spark, path, [day(2), None])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and "PartitionFilters: [" in plan
    store.merge_into_store(make([2, None, 4], "new"), path)
    assert set(os.listdir(root)) == before
    assert sorted((str(r.interaction_date), r.order_number) for r in store.read_store(spark, path).collect()) == [
        ("2024-01-01", "old"), ("2024-01-02", "new"), ("2024-01-03", "old"), ("2024-01-04", "new"), ("None", "new")]


def test_files_that_arrive_later_do_not_repeat_comments(spark, tmp_path):
    arrived, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))

    def arrive(name, days):
        df = spark.createDataFrame([(d, f"2024-01-{d:02}", "u", f"https://s.example/p/{d}", "c", f"meu pedido {d}a nunca chegou")
                                    for d in days], files.COMMENT_SCHEMA)
        files.write_comments(df.coalesce(1), f"{arrived}/{name}", "infer")

    for name, days in (("first", range(1, 7)), ("second", range(3, 9))):
        arrive(name, days)
        stream = ingest.arriving_comments(spark, f"{arrived}/*")
        ingest.ingest_comments(stream, PT, out, checkpoint)
    found = ingest.ingested_sentences(spark, out).collect()
    assert sorted(r.comment_id for r in found) == list(range(1, 9))


def test_rolling_counts_of_a_table(spark):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 10), "P"), ("a", dt.datetime(2024, 1, 12), "P"), ("a", dt.datetime(2024, 1, 12), None)],
                               "user_name string, interaction_date timestamp, problema string")
    daily = counts.daily_counts(df)
    assert [(r.n, str(r.day)) for r in daily.orderBy("day").collect()] == [(1, "2024-01-10"), (1, "2024-01-12")]
    found = {str(r.run): r.n for r in counts.rolling_problem_counts(daily, days=3).collect()}
    assert found == {"2024-01-10": 1, "2024-01-11": 1, "2024-01-12": 2, "2024-01-13": 2, "2024-01-14": 1, "2024-01-15": 1}
