"""Labels, modes, replay and upserts on small hand-made tables."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from recado import PT_TAXONOMY as TAX
from recado import label_comments, replay_problem_mode, upsert_results, user_problem_mode
from recado.operators import labels as lb
from recado.operators import modes as m
from recado.operators.skew import attach
from recado.sources import files, store

SCHEMA = ("comment_id long, sentence_idx int, user_name string, interaction_date timestamp, original_text string, "
          "cluster string, problema string, size long")
NEG, NEG2, POS, UNK = "Pedido não chegou", "Muita demora", "Amei comprar", "Cluster não identificado"
DAY = dt.datetime(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, 0, *r) for i, r in enumerate(rows)], SCHEMA)


def row(user, text, cluster, size, problem=None, day=0):
    return (user, DAY + dt.timedelta(days=day), text, cluster, problem, size)


def modes_of(spark, rows):
    felt = lb.add_sentiment(frame(spark, rows), TAX)
    return {(r.user_name, r.sentimento): r.cluster_mode for r in lb.comment_label_mode(felt).collect()}


def test_one_mode(spark):
    rows = [row("a", "t", NEG, 5), row("a", "t", NEG, 5), row("a", "t", NEG2, 90)]
    assert modes_of(spark, rows) == {("a", "Negativo"): NEG}


def test_tie_goes_to_the_largest_cluster_even_if_not_tied(spark):
    third = "Problema na entrega"
    rows = [row("a", "t", NEG, 5)] * 2 + [row("a", "t", NEG2, 6)] * 2 + [row("a", "t", third, 90)]
    assert modes_of(spark, rows) == {("a", "Negativo"): third}


def test_no_label_and_no_user(spark):
    rows = [row("a", "t", None, None), row(None, "t", NEG, 3)]
    assert modes_of(spark, rows) == {("a", "Não identificado"): None}


def test_the_problem_wins_over_the_praise(spark):
    rows = [row("a", "t", POS, 500), row("a", "t", NEG, 2, "Entrega não efetuada"), row("a", "t", None, None)]
    found = label_comments(frame(spark, rows), TAX).collect()
    assert [(r.cluster, r.sentimento, r.problema) for r in found] == [(NEG, "Negativo", "Entrega não efetuada")]


def test_same_text_of_two_users_is_one_row_unless_asked(spark):
    rows = [row("a", "t", NEG, 2), row("b", "t", NEG, 7)]
    assert [r.user_name for r in label_comments(frame(spark, rows), TAX).collect()] == ["b"]
    assert len(label_comments(frame(spark, rows), TAX, per_user=True).collect()) == 2


def test_no_size_outranks_any_size(spark):
    rows = [row("a", "t", UNK, 400), row("b", "t", None, None)]
    found = label_comments(frame(spark, rows), TAX).collect()
    assert [(r.user_name, r.cluster, r.sentimento) for r in found] == [("b", None, None)]


def test_label_comments_is_the_steps_in_sequence(spark, rows):
    random.seed(5)
    made = [row(random.choice("abc"), random.choice("xyzw"), random.choice([NEG, NEG2, POS, UNK, None]), random.randint(1, 4))
            for _ in range(300)]
    df = frame(spark, made)
    felt = lb.add_sentiment(df, TAX)
    step = lb.apply_label_mode(felt, lb.comment_label_mode(felt))
    step = lb.null_sentinels(lb.one_row_per_comment(step, TAX), TAX)
    columns = ["comment_id", "cluster", "sentimento", "problema", "size"]
    assert rows(step.select(columns)) == rows(label_comments(df, TAX).select(columns))


def mode_30d(spark, rows, **options):
    felt = lb.null_sentinels(lb.add_sentiment(frame(spark, rows), TAX), TAX)
    return {r.user_name: r.problema_30d for r in user_problem_mode(felt, TAX, **options).collect()}


def test_thirty_days_are_in_and_thirty_one_are_out(spark):
    rows = [row("a", "1", NEG, 1, "A", 0), row("a", "2", NEG, 1, "A", 1), row("a", "3", NEG, 1, "A", 1),
            row("a", "4", NEG, 1, "B", 31), row("a", "5", NEG, 1, "B", 31), row("a", "6", NEG, 1, "B", 30)]
    assert mode_30d(spark, rows) == {"a": "B"}
    assert mode_30d(spark, [*rows[1:3], row("a", "7", NEG, 1, "B", 31)]) == {"a": "A"}
    assert mode_30d(spark, [rows[0], row("a", "8", NEG, 1, "B", 31)]) == {"a": "B"}


def test_tie_goes_to_the_most_severe_row_of_all_time(spark):
    rows = [row("a", "1", NEG, 1, "Old", 0), row("a", "2", POS, 1, "A", 50), row("a", "3", POS, 1, "B", 50)]
    assert mode_30d(spark, rows) == {"a": "Old"}
    rows.append(row("a", "4", None, None, None, 50))
    assert mode_30d(spark, rows) == {"a": None}


def test_no_problems(spark):
    assert mode_30d(spark, [row("a", "1", NEG, 1), row(None, "2", NEG, 1, "A")]) == {"a": None}


def test_as_of(spark):
    rows = [row("a", "1", NEG, 1, "A", 0), row("a", "2", NEG, 1, "B", 20), row("a", "3", NEG, 1, "B", 21)]
    assert mode_30d(spark, rows, as_of="2024-01-10") == {"a": "A"}


def naive_replay(rows, start, end, days, severity):
    """The day loop, in plain Python: rows are dicts, changed in place."""
    day = start
    while day < end:
        inside = [r for r in rows if day - dt.timedelta(days=days) <= r["day"] <= day]
        for user in {r["user"] for r in inside if r["user"]}:
            mine = [r for r in inside if r["user"] == user]
            counts = Counter(r["problem"] for r in mine if r["problem"])
            modes = [p for p, n in counts.items() if n == max(counts.values())]
            if len(modes) > 1:
                value = max(mine, key=lambda r: (severity(r), r["day"], r["id"]))["problem"]
            else:
                value = modes[0] if modes else None
            for r in mine:
                r["out"] = value
        day += dt.timedelta(days=1)


@pytest.mark.parametrize("seed", [1, 2])
def test_replay_equals_the_day_loop(spark, seed):
    random.seed(seed)
    made = [row(random.choice(["a", "b", "c", None]), str(i), random.choice([NEG, POS, "Spam", None]), 1,
                random.choice(["A", "B", "C", None]), random.randint(0, 90)) for i in range(400)]
    felt = lb.null_sentinels(lb.add_sentiment(frame(spark, made), TAX), TAX)
    start, end = DAY + dt.timedelta(days=20), DAY + dt.timedelta(days=70)
    done = replay_problem_mode(felt, TAX, str(start.date()), str(end.date()))
    order = {None: 9, "Outro": 1, "Positivo": 2, "Negativo": 3}
    sentiments = {r.comment_id: r.sentimento for r in felt.collect()}
    plain = [{"id": i, "user": r[0], "day": r[1], "problem": r[4], "out": None} for i, r in enumerate(made)]
    naive_replay(plain, start, end, 30, lambda r: order[sentiments[r["id"]]])
    assert {r.comment_id: r.problema_30d for r in done.collect()} == {r["id"]: r["out"] for r in plain}


def test_date_range(spark):
    days = [str(r.day) for r in m.date_range(spark, "2024-02-27", "2024-03-01").collect()]
    assert days == ["2024-02-27", "2024-02-28", "2024-02-29"]
    assert m.date_range(spark, "2024-03-01", "2024-03-01").count() == 0
    assert m.date_range(spark, "2024-03-02", "2024-03-01").count() == 0


@pytest.mark.parametrize("hot_rows", [0, 2, 1000])
def test_attach_with_hot_and_null_keys(spark, rows, hot_rows):
    df = spark.createDataFrame([(i, "hot" if i < 50 else None if i < 60 else f"k{i}") for i in range(80)], "id long, k string")
    groups = df.groupBy("k").agg(F.min("id").alias("low"), F.count("*").alias("n_rows"))
    found = attach(df, groups, ["k"], ["low"], row_id=["id"], hot_rows=hot_rows)
    assert rows(found) == sorted(((i, "hot", 0) if i < 50 else (i, None, None) if i < 60 else (i, f"k{i}", i)
                                  for i in range(80)), key=repr)


RESULT = {"url": "u", "content_type": None, "cluster": None, "sentimento": None, "problema": None, "problema_30d": None}


def results(spark, rows):
    data = [(dt.date(2024, 1, d), user, "u", None, text, None, None, None, None, number) for d, user, text, number in rows]
    return spark.createDataFrame(data, files.RESULT_SCHEMA)


def test_upsert(spark, rows):
    stored = results(spark, [(1, "a", "x", "old"), (1, None, "x", "old"), (2, "a", "x", "old"), (3, "b", "y", "old"), (3, "b", "y", "old2")])
    new = results(spark, [(1, "a", "x", "new"), (1, None, "x", "new"), (9, "c", "z", "new"), (9, "c", "z", "new2")])
    assert sorted(r.order_number for r in upsert_results(stored, new).collect()) == sorted(
        ["old", "old", "old2", "new", "new", "new", "new2"])


def test_store_merges_by_date_and_repeats_safely(spark, rows, tmp_path):
    path = str(tmp_path / "store")
    first = results(spark, [(1, "a", "x", "old"), (2, "a", "x", "old"), (2, "b", "y", "old")])
    second = results(spark, [(2, "a", "x", "new"), (3, "a", "x", "new")])
    for batch in (first, second, second):
        store.merge_into_store(batch, path)
    assert rows(store.read_store(spark, path).select("interaction_date", "user_name", "order_number")) == sorted([
        (dt.date(2024, 1, 1), "a", "old"), (dt.date(2024, 1, 2), "a", "new"), (dt.date(2024, 1, 2), "b", "old"),
        (dt.date(2024, 1, 3), "a", "new")], key=repr)
