import itertools
import math

import pytest
from pyspark.sql import functions as F

from recado.operators import sentences as s
from recado.operators import tags as tg
from recado.plans.clean import clean_tagged, kept
from recado.profiles import PT

LEXICON = [
    ("o", "DET", "o"), ("a", "DET", "a"), ("ela", "PRON", "ela"), ("ele", "PRON", "ele"), ("hoje", "ADV", "hoje"),
    ("casa", "NOUN", "casa"), ("livro", "NOUN", "livro"), ("porta", "NOUN", "porta"), ("chegou", "VERB", "chegar"),
    ("canta", "VERB", "cantar"), ("sempre", "ADV", "sempre"), ("abre", "VERB", "abrir"),
    ("compra", "NOUN", "compra"), ("compra", "VERB", "comprar"), ("conta", "NOUN", "conta"), ("conta", "VERB", "contar"),
    ("caro", "ADJ", "caro"), ("caro", "NOUN", "caroço"), ("caro", "VERB", "carear"), ("vale", "NOUN", "vale"), ("vale", "VERB", "valer")]
SENTENCES = ["o livro chegou hoje", "a casa", "ela canta sempre", "ele abre a porta", "ela canta hoje", "a porta abre", "ele canta"]
ASKED = ["a compra chegou", "ela compra sempre", "ele conta", "a conta", "ela compra  conta caro", "zzz compra", "vale", "", "livro caro conta compra vale"]


def frame(spark, texts):
    return spark.createDataFrame([(i, 0, x) for i, x in enumerate(texts)], "comment_id long, sentence_idx int, text string")


def parts(df):
    return df.select("comment_id", F.array(F.struct("sentence_idx", "text")).alias("_parts"))


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame(LEXICON, "surface string, pos string, lemma string")


@pytest.fixture(scope="module")
def model(spark, lexicon):
    return s.fit_tags(parts(frame(spark, SENTENCES)), lexicon, "_parts", ["comment_id"])


def options_of(word, exempt=()):
    found = {}
    for surface, pos, lemma in LEXICON:
        if surface == word:
            lemma = lemma if pos in ("VERB", "ADJ", "NOUN") and word not in exempt else word
            found[pos] = min(lemma, found.get(pos, lemma))
    return sorted(found.items()) or [(tg.UNKNOWN, word)]


def brute_model():
    names = ("", "?", *sorted({pos for _, pos, _ in LEXICON}))
    counts = {}
    for text in SENTENCES:
        seen = [""] + [o[0][0] if len(o := options_of(w)) == 1 else None for w in text.split(" ")] + [""]
        for pair in itertools.pairwise(seen):
            if None not in pair:
                counts[pair] = counts.get(pair, 0) + 1
    row = {x: sum(n for (before, _), n in counts.items() if before == x) for x in names}
    return names, {(x, y): round(1000 * math.log((row[x] + len(names)) / (counts.get((x, y), 0) + 1))) for x in names for y in names}


def brute_path(text, exempt=()):
    names, costs = brute_model()
    paths = itertools.product(*[options_of(w, exempt) for w in text.split(" ")])
    best = min(paths, key=lambda p: (sum(costs[x, y] for x, y in itertools.pairwise(["", *[t for t, _ in p], ""])), [names.index(t) for t, _ in p]))
    return " ".join(lemma for _, lemma in best)


def test_the_model_has_the_costs_of_counted_pairs(model):
    names, costs = brute_model()
    assert model.tags == names
    assert dict(zip(itertools.product(names, names), model.costs, strict=True)) == costs
    assert tg.TagModel.from_json(model.to_json()) == model


@pytest.mark.parametrize("small_rows", [0, 100])
@pytest.mark.parametrize("exempt", [(), ("vale", "conta")])
def test_lemmas_are_those_of_the_cheapest_path(spark, lexicon, model, small_rows, exempt):
    done = s.lemmatise_by_join(frame(spark, ASKED), tg.ContextLexicon(lexicon, model), ["comment_id"], exempt, small_rows=small_rows)
    assert {r.comment_id: r.text for r in done.collect()} == {i: brute_path(x, exempt) for i, x in enumerate(ASKED)}


def test_neighbours_choose(spark, lexicon, model):
    done = s.lemmatise_by_join(frame(spark, ASKED[:4]), tg.ContextLexicon(lexicon, model), ["comment_id"])
    assert [r.text for r in done.orderBy("comment_id").collect()] == ["a compra chegar", "ela comprar sempre", "ele contar", "a conta"]


def test_one_lemma_for_each_surface_gives_what_the_plain_dictionary_gives(spark, rows, model):
    plain = spark.createDataFrame([x for x in LEXICON if len(options_of(x[0])) == 1], "surface string, pos string, lemma string")
    df = frame(spark, [*SENTENCES, *ASKED])
    assert rows(s.lemmatise_by_join(df, tg.ContextLexicon(plain, model), ["comment_id"])) == rows(s.lemmatise_by_join(df, plain, ["comment_id"]))


def test_nulls_repeats_and_empty_tables(spark, lexicon, model):
    odd = spark.createDataFrame([*LEXICON, *LEXICON, (None, "NOUN", "x"), ("casa", None, "y"), ("livro", "VERB", None)], lexicon.schema)
    df = spark.createDataFrame([(None, 0, "a compra chegou"), (1, 0, None), (2, 0, "livro")], "comment_id long, sentence_idx int, text string")
    done = s.lemmatise_by_join(df, tg.ContextLexicon(odd, model), ["comment_id"])
    assert {r.comment_id: r.text for r in done.collect()} == {None: "a compra chegar", 1: None, 2: "livro"}
    none = spark.createDataFrame([], lexicon.schema)
    empty = s.fit_tags(parts(frame(spark, [])), none, "_parts", ["comment_id"])
    assert empty.tags == ("", "?") and set(empty.costs) == {round(1000 * math.log(2))}
    assert s.lemmatise_by_join(df.where("comment_id = 2"), tg.ContextLexicon(none, empty), ["comment_id"]).first().text == "livro"


def test_too_many_tags_are_refused(spark):
    many = spark.range(70).selectExpr("'x' AS surface", "CAST(id AS STRING) AS pos", "'y' AS lemma")
    with pytest.raises(ValueError, match="parts of speech"):
        tg.tags_of(many)


def test_the_cleaner_takes_a_context_lexicon(spark, lexicon, model):
    df = spark.createDataFrame([(1, "2024-01-01", "a", None, "t", "ela compra sempre pedido"), (2, "2024-01-01", "b", None, "t", "pedido casa compra chegou")],
                               "comment_id long, interaction_date string, user_name string, url string, content_type string, text string")
    out = kept(clean_tagged(df, PT, stemming=False, lexicon=tg.ContextLexicon(lexicon, model)))
    assert {r.comment_id: "comprar" in r.text for r in out.collect()} == {1: True, 2: False}
