"""Streams over several runs against one batch over all comments."""

import os
import random
import threading
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from recado.operators import labels as lb
from recado.plans import classify as cl
from recado.plans import clean as pc
from recado.sources import files, staging, store
from recado.streaming import counts, ingest, logs
from suite.profile import TAXONOMY, TEST

LABELS = ("Loved it", "Late delivery", "Refund", None)


def label(tagged):
    """Clusters by the words of a sentence: the same whoever sends it."""
    lookup = tagged.sparkSession.createDataFrame(
        [(0, "Loved it", None, 50), (1, "Late delivery", "Delivery", 90), (2, "Refund", "Money", 70)], "subclusters_id int, cluster string, problema string, size long")
    return cl.label_tagged(tagged, lookup, lambda df: df.withColumn("subclusters_id", F.pmod(F.xxhash64("text"), F.lit(3)).cast("int")))


def comments(seed=4, n=160):
    rng = random.Random(seed)
    words = "order delivery late refund money never arrived thanks support the parcel was broken".split()
    texts = [" ".join(rng.choices(words, k=rng.randint(3, 9))) + ". " + " ".join(rng.choices(words, k=5)) for _ in range(40)] + ["Maria Souza, hello", "@x hi", ""]
    rows = []
    for i in range(n):
        text = rng.choice(texts)
        rows.append((None if rng.random() < 0.1 else rng.randrange(120), f"2024-01-{rng.randint(1, 28):02}", rng.choice(["ana", "bia", "caio", None]),
                     f"https://s.example/p/{rng.randrange(6)}/c/{i}", rng.choice(["post", None]), text))
    return rows


def arrive(spark, path, name, rows):
    files.write_comments(spark.createDataFrame(rows, files.COMMENT_SCHEMA).repartition(2), f"{path}/{name}", "infer")


def plain(df):
    return sorted((tuple(str(x) for x in r) for r in df.collect()))


@pytest.mark.parametrize("cuts,files_per_batch", [((0, 160), 100), ((0, 50, 51, 160), 1), ((0, 100, 160), 3)])
def test_any_cut_gives_what_one_batch_gives(spark, tmp_path, cuts, files_per_batch):
    rows = comments()
    arrived, root, out, checkpoint = (str(tmp_path / x) for x in ("in", "root", "store", "checkpoint"))
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        arrive(spark, arrived, f"run{k}", rows[a:b])
        stream = ingest.arriving_comments(spark, f"{arrived}/*", files_per_batch=files_per_batch)
        ingest.ingest_results(stream, TEST, label, TAXONOMY, root, out, checkpoint, network="instagram", days=7)
    whole = files.read_comments(spark, f"{arrived}/*")
    tagged = pc.clean_tagged(whole, TEST, network="instagram", with_text_key=True)
    assert plain(ingest.ingested_sentences(spark, root)) == plain(tagged.drop("text_key"))
    labelled = lb.label_comments(label(tagged.select(*cl.NARROW, "reject_reason", "text")), TAXONOMY)
    want = cl.recent_results(labelled, cl.texts_of(whole), TAXONOMY, days=7)
    assert plain(store.read_store(spark, out)) == plain(want)


def test_an_earlier_copy_takes_over_wherever_it_comes_from(spark, tmp_path):
    """Another post's publish date goes up again, the row moves to another date, and the date it leaves has no folder left."""
    arrived, root, out, checkpoint = (str(tmp_path / x) for x in ("in", "root", "store", "checkpoint"))
    text = "the order never arrived and support was late"
    runs = [[(1, "2024-01-20", "ana", "https://s.example/p/1/c/1", "post", text), (2, "2024-01-25", "bia", "https://s.example/p/1/c/2", "post", text + " again")],
            [(3, "2024-01-05", "ana", "https://s.example/p/2/c/3", "post", text)], [(3, "2024-01-05", "ana", "https://s.example/p/2/c/3", "post", text)]]
    for k, rows in enumerate(runs):
        arrive(spark, arrived, f"run{k}", rows)
        ingest.ingest_results(ingest.arriving_comments(spark, f"{arrived}/*"), TEST, label, TAXONOMY, root, out, checkpoint, network="instagram")
    found = {(r.comment_id, str(r.publish_date)[:10]) for r in ingest.ingested_sentences(spark, root).collect()}
    assert found == {(3, "2024-01-05"), (2, "2024-01-25")}
    assert sorted(d for d in os.listdir(out) if d.startswith("interaction_date")) == ["interaction_date=2024-01-05", "interaction_date=2024-01-25"]
    assert store.read_store(spark, out).count() == 2
    assert logs.read(spark, f"{root}/comments", "comment_id long", after=1).count() == 0  # the third run brought nothing new


def test_a_batch_that_is_repeated_changes_nothing(spark, tmp_path):
    root, rows = str(tmp_path / "root"), comments(seed=9, n=60)
    first, second = (spark.createDataFrame(x, files.COMMENT_SCHEMA) for x in (rows[:30], rows[30:]))
    seen = []
    for number, batch in ((0, first), (1, second), (1, second)):
        with staging.scratch_scope(spark):
            ingest._changes(batch, root, number, "instagram", True)
        seen.append((plain(logs.read(spark, f"{root}/comments", ingest._comment_schema(spark, root))), plain(logs.read(spark, f"{root}/posts", ingest.POSTS))))
    assert seen[1] == seen[2] != seen[0]


def test_only_touched_dates_are_rewritten(spark, tmp_path):
    arrived, root, out, checkpoint = (str(tmp_path / x) for x in ("in", "root", "store", "checkpoint"))
    far = [(i, f"2024-02-{i:02}", f"u{i}", "https://s.example/p/1/c/1", "post", f"order number {'x' * i} never arrived late") for i in range(1, 20)]
    stamp = lambda: {d: os.stat(f"{out}/{d}").st_mtime_ns for d in os.listdir(out) if d.startswith("interaction_date")}
    for k, rows in enumerate((far, [(50, "2024-02-03", "new", "https://s.example/p/9/c/9", "post", "another order that never arrived")])):
        arrive(spark, arrived, f"run{k}", rows)
        before = stamp() if k else {}
        ingest.ingest_results(ingest.arriving_comments(spark, f"{arrived}/*"), TEST, label, TAXONOMY, root, out, checkpoint, network="instagram")
    after = stamp()
    assert {d for d in after if after[d] != before.get(d)} == {"interaction_date=2024-02-03"}


def test_nothing_has_arrived(spark, tmp_path):
    ingest.update_results(spark, str(tmp_path / "root"), TAXONOMY, str(tmp_path / "store"))
    assert not os.path.exists(tmp_path / "store")


def test_scopes_of_two_threads_do_not_meet(spark):
    opened, staged, problems = threading.Event(), threading.Event(), []

    def other():
        try:
            with staging.scratch_scope(spark):
                opened.set()
                staged.wait(60)
        except Exception as e:  # noqa: BLE001 - reported below
            problems.append(e)

    thread = threading.Thread(target=other)
    thread.start()
    opened.wait(60)
    with staging.scratch_scope(spark):
        table = staging.staged(spark.range(10), "mine")
        staged.set()
        thread.join()
        assert table.count() == 10
    assert not problems


def test_two_streams_at_once(spark, tmp_path):
    rows, errors = comments(seed=2, n=80), []
    arrive(spark, str(tmp_path / "in"), "run", rows)

    def run(name):
        try:
            stream = ingest.arriving_comments(spark, f"{tmp_path}/in/*", files_per_batch=1)
            ingest.ingest_comments(stream, TEST, f"{tmp_path}/{name}", f"{tmp_path}/check-{name}", network="instagram")
        except Exception as e:  # noqa: BLE001 - reported below
            errors.append(e)

    threads = [threading.Thread(target=run, args=(n,)) for n in ("a", "b")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    assert plain(ingest.ingested_sentences(spark, f"{tmp_path}/a")) == plain(ingest.ingested_sentences(spark, f"{tmp_path}/b")) != []


def test_logs_read_up_to_a_batch_and_by_key(spark, tmp_path):
    path = str(tmp_path / "log")
    schema = "k string, v long"
    assert logs.read(spark, path, schema).count() == 0
    for batch, rows in enumerate(([("a", 1), (None, 2)], [("a", 3)], [("b", 4)])):
        logs.append(spark.createDataFrame(rows, schema), path, batch)
    assert logs.read(spark, path, schema, after=0, upto=1).collect() == [("a", 3, 1)]
    assert sorted(tuple(r)[:2] for r in logs.latest(logs.read(spark, path, schema), ["k"]).where("k IS NOT NULL").collect()) == [("a", 3), ("b", 4)]
    keys = spark.createDataFrame([(None,), ("b",)], "k string")
    assert sorted(r.v for r in logs.of_keys(logs.read(spark, path, schema), keys).collect()) == [2, 4]


def test_problem_modes_over_runs(spark, tmp_path):
    """Against a loop over users and days, after each run; the second run leaves far days alone."""
    rng, root, arrived = random.Random(3), str(tmp_path / "root"), str(tmp_path / "in")
    schema = "comment_id long, sentence_idx int, user_name string, interaction_date timestamp, problema string, sentimento string"
    taxonomy = TAXONOMY
    make = lambda i, day: (i, 0, rng.choice(["ana", "bia", None]), None if rng.random() < 0.05 else datetime(2024, 1, 1) + timedelta(days=day),
                           rng.choice(["P", "Q", "R", None]), rng.choice([*taxonomy.severity[:3], None]))
    runs = [[make(i, rng.randrange(60)) for i in range(80)], [make(100 + i, 20 + rng.randrange(3)) for i in range(12)]]
    for k, rows in enumerate(runs):
        spark.createDataFrame(rows, schema).write.parquet(f"{arrived}/run{k}")
        counts.ingest_problem_modes(spark.readStream.schema(schema).parquet(f"{arrived}/*"), taxonomy, root, str(tmp_path / "check"), days=6)
        everything = [r for part in runs[:k + 1] for r in part if r[2] and r[3]]
        want = {}
        for user in {r[2] for r in everything}:
            for run in {r[3] + timedelta(days=d) for r in everything if r[2] == user for d in range(7)}:
                inside = [r for r in everything if r[2] == user and run - timedelta(days=6) <= r[3] <= run]
                n = {p: sum(r[4] == p for r in inside) for p in {r[4] for r in inside if r[4]}}
                best = sorted(p for p in n if n[p] == max(n.values()))
                rank = lambda r: (taxonomy.severity.index(r[5]) if r[5] else 1000, r[3], r[0])
                want[user, run.date()] = (max(inside, key=rank)[4] if len(best) > 1 else (best or [None])[0], len(inside))
        got = {(r.user_name, r.run): (r.problema_30d, r.n) for r in counts.stored_problem_modes(spark, root).collect()}
        assert got == want
    second = logs.read(spark, f"{root}/modes", counts.MODES, after=0)
    assert {r.run.day for r in second.collect()} <= set(range(21, 30))
