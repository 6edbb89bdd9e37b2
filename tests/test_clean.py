"""The Portuguese cleaner on worked examples, stage by stage, and its invariants."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from recado import PT, clean, clean_tagged, clean_trace
from recado.functions import text as t
from recado.functions.stem import EXCLUSIVE, STEPS, stem
from recado.operators import comments as c
from recado.operators import sentences as s

# The worked example's inputs and its texts after each stage.
TEXTS = [
    None, "Oi", "Oi", "@claudia verdade!", "Renata Aragão verdade amiga",
    "loja Eu estou esperando há dias e nada da minha encomenda", "@loja estou esperando",
    "Não imaginava, que mandava     o produto tão rápido kkkk *** \n obrigado",
    "Lindo esse vestido minha filha vai adorar", "",
]

STAGES = {
    "deduped": [1, 3, 4, 5, 6, 7, 8, 9],
    "mentions": [1, 4, 5, 6, 7, 8, 9],
    "names": [1, 5, 6, 7, 8, 9],
    "lower": ["oi", "loja eu estou esperando há dias e nada da minha encomenda", "@loja estou esperando",
              "não imaginava, que mandava     o produto tão rápido kkkk *** \n obrigado",
              "lindo esse vestido minha filha vai adorar", ""],
    "handles": ["oi", "loja eu estou esperando há dias e nada da minha encomenda", " estou esperando",
                "não imaginava, que mandava     o produto tão rápido kkkk *** \n obrigado",
                "lindo esse vestido minha filha vai adorar", ""],
    "marks": ["oi", " eu estou esperando há dias e nada da minha encomenda", " estou esperando",
              "não imaginava. que mandava     o produto tão rápido kkkk *** \n obrigado",
              "lindo esse vestido minha filha vai adorar", ""],
    "sentences": ["oi", " eu estou esperando há dias e nada da minha encomenda", " estou esperando", "não imaginava.",
                  "que mandava     o produto tão rápido kkkk *** \n obrigado", "lindo esse vestido minha filha vai adorar", ""],
    "brand": ["oi", " eu estou esperando há dias e nada da minha encomenda", " estou esperando",
              "não imaginava, que mandava     o produto tão rápido kkkk *** \n obrigado",
              "lindo esse vestido minha filha vai adorar", ""],
    "stop_words": ["oi", " esperando dias nada encomenda", " esperando", "não imaginava ",
                   "que mandava produto tão rápido kkkk obrigado", "lindo vestido filha vai adorar", ""],
    "residue": ["oi", "esperando dias nada encomenda", "esperando", "não imaginava ",
                "que mandava produto tão rápido  obrigado", "lindo vestido filha vai adorar", ""],
    "letters": ["oi", "esperando dias nada encomenda", "esperando", "não imaginava ",
                "que mandava produto tão rápido  obrigado", "lindo vestido filha vai adorar", ""],
    "length": ["esperando dias nada encomenda", "que mandava produto tão rápido  obrigado", "lindo vestido filha vai adorar"],
    "lemmas": ["esperar dia nada encomendar", "que mandar produto tão rápido  obrigar", "lindar vestir filho vai adorar"],
    "accents": ["esperar dia nada encomendar", "que mandar produto tao rapido  obrigar", "lindar vestir filho vai adorar"],
    "synonyms": ["esperar tempo nada encomendar", "que mandar pedido tao rapido  obrigar", "lindar vestir filho vai amo"],
    "mandatory": ["esperar tempo nada encomendar", "que mandar pedido tao rapido  obrigar"],
    "useless": ["esperar tempo nada encomendar", "que mandar pedido tao rapido   "],
    "stems": ["esper temp nad encomend", "que mand ped tao rap"],
    "final": ["esper temp nad encomend", "que mand ped tao rap"],
}


def comments(spark, texts, users=None):
    rows = [(i, f"2024-01-{1 + i % 28:02}", (users or {}).get(i, "u"), f"https://s.example/p/{i % 2}/c/{i}", text)
            for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "comment_id long, interaction_date string, user_name string, url string, text string")


@pytest.fixture(scope="module")
def trace(spark):
    return clean_trace(comments(spark, TEXTS), PT).orderBy("stage_ord", "comment_id", "sentence_idx").collect()


@pytest.mark.parametrize("stage", STAGES)
def test_trace(trace, stage):
    found = [r for r in trace if r.stage == stage]
    want = STAGES[stage]
    assert [r.comment_id if isinstance(want[0], int) else r.text for r in found] == want


def test_reasons(spark, rows):
    tagged = clean_tagged(comments(spark, [*TEXTS, "qual o numero pedido de voces hoje"]), PT, keep_length_rejects=True)
    assert rows(tagged.select("comment_id", "sentence_idx", "reject_reason")) == sorted([
        (1, 0, "length"), (3, None, "mention"), (4, None, "name"), (5, 0, None), (6, 0, "length"), (7, 0, "length"),
        (7, 1, None), (8, 0, "mandatory"), (9, 0, "length"), (10, 0, "blacklist")], key=repr)


def test_without_the_mandatory_rule(spark):
    kept, removed = clean(comments(spark, TEXTS), PT, remove_mandatory=False)
    assert {r.comment_id for r in kept.collect()} == {5, 7, 8}
    assert {r.reject_reason for r in removed.collect()} == {"mention", "name"}


def test_useless_only_is_blank(spark):
    tagged = clean_tagged(comments(spark, ["loja loja loja assim"]), PT)
    assert [(r.reject_reason, r.text) for r in tagged.collect()] == [("blank", "")]


def test_empty_input(spark):
    assert clean_tagged(comments(spark, TEXTS).where("false"), PT).count() == 0


def test_every_sentence_is_accounted_for(spark):
    df = comments(spark, [f"{x} Outro pedido que nunca chegou. E mais {i}" for i, x in enumerate(TEXTS) if x])
    tagged = clean_tagged(df, PT, keep_length_rejects=True)
    whole = tagged.where("sentence_idx is null").count()
    trace = clean_trace(df, PT)
    assert tagged.count() - whole == trace.where("stage = 'sentences'").count()
    assert whole == trace.where("stage = 'deduped'").count() - trace.where("stage = 'names'").count()


def test_partitioning_does_not_matter(spark, rows):
    df = comments(spark, TEXTS * 5)
    assert rows(clean_tagged(df.repartition(1), PT)) == rows(clean_tagged(df.repartition(8), PT))


def test_repeated_comments_change_nothing(spark, rows):
    df = comments(spark, TEXTS)
    again = df.withColumn("comment_id", F.col("comment_id") + 1000)
    later = df.withColumn("comment_id", F.lit(None).cast("bigint")).withColumn("interaction_date", F.lit("2024-06-01"))
    assert rows(clean_tagged(df.unionByName(df).unionByName(again).unionByName(later), PT)) == rows(clean_tagged(df, PT))


def test_rows_without_an_id_get_one(spark):
    df = comments(spark, [x for x in TEXTS if x] * 2)
    nameless = df.withColumn("comment_id", F.when(F.col("comment_id") % 2 == 0, F.col("comment_id")))
    found = clean_tagged(nameless, PT, keep_length_rejects=True)
    want = clean_tagged(df, PT, keep_length_rejects=True)
    texts = lambda x: sorted((r.original_text, r.text) for r in x.collect())
    assert texts(found) == texts(want) and found.where("comment_id is null").isEmpty()
    assert texts(clean_tagged(df.drop("comment_id"), PT, keep_length_rejects=True)) == texts(want)


def test_an_edited_comment_is_two_texts(spark):
    df = spark.createDataFrame([(1, "2024-01-01", "u", "x", "meu pedido nunca chegou"), (1, "2024-01-02", "u", "x", "meu pedido ainda nunca chegou")],
                               "comment_id long, interaction_date string, user_name string, url string, text string")
    assert sorted((r.original_text, str(r.interaction_date)[:10]) for r in clean_tagged(df, PT).collect()) == [
        ("meu pedido ainda nunca chegou", "2024-01-02"), ("meu pedido nunca chegou", "2024-01-01")]


def test_bad_dates_end_a_strict_run_and_are_listed_by_a_tolerant_one(spark):
    df = comments(spark, ["meu pedido nunca chegou", "meu outro pedido nunca chegou"]).withColumn(
        "interaction_date", F.when(F.col("comment_id") == 1, "31/13/2024").otherwise("2024-01-01"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE"):
        clean_tagged(df, PT).collect()
    assert [r.comment_id for r in clean_tagged(df, PT, strict_dates=False).collect()] == [0]
    assert [(r.comment_id, r.interaction_date) for r in c.bad_dates(df).collect()] == [(1, "31/13/2024")]


def test_a_large_profile_dictionary_becomes_a_table(spark, rows, monkeypatch):
    df = comments(spark, TEXTS)
    want = rows(clean_tagged(df, PT))
    monkeypatch.setattr(s, "LITERAL_LEMMAS", 3)
    assert rows(clean_tagged(df, PT)) == want


@pytest.mark.parametrize("turned", [False, True])
def test_a_surface_with_two_lemmas_has_one_on_both_sides_of_the_limit(spark, rows, monkeypatch, turned):
    doubled = tuple(replace(PT.lemmas[0], surface="vestido", pos=pos, lemma=lemma) for pos, lemma in (("NOUN", "veste"), ("VERB", "vestir")))
    profile = replace(PT, lemmas=(*PT.lemmas, *(reversed(doubled) if turned else doubled)))
    df = comments(spark, ["meu pedido do vestido nunca chegou"])
    want = rows(clean_tagged(df, profile, stemming=False))
    assert "veste " in str(want)
    monkeypatch.setattr(s, "LITERAL_LEMMAS", 3)
    assert rows(clean_tagged(df, profile, stemming=False)) == want


def test_lemmas_by_join_equal_lemmas_of_the_profile(spark, rows):
    lexicon = spark.createDataFrame([(e.surface, e.pos, e.lemma) for e in PT.lemmas], "surface string, pos string, lemma string")
    df = comments(spark, TEXTS)
    assert rows(clean_tagged(df, PT, lexicon=lexicon)) == rows(clean_tagged(df, PT))


def test_exempt_words_and_other_parts_of_speech_keep_their_form(spark):
    lexicon = spark.createDataFrame([("vale", "NOUN", "valer"), ("para", "ADP", "parar"), ("dias", "NOUN", "dia")],
                                    "surface string, pos string, lemma string")
    df = spark.createDataFrame([(1, 0, "vale para dias"), (1, 1, "dias dias")], "comment_id long, sentence_idx int, text string")
    for small_rows in (0, 100):
        done = s.lemmatise_by_join(df, lexicon, ["comment_id", "sentence_idx"], PT.lemma_exempt, small_rows=small_rows)
        assert {r.sentence_idx: r.text for r in done.collect()} == {0: "vale para dia", 1: "dia dia"}


def test_duplicates_keep_the_earliest_and_null_users_are_equal(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-03", "a", "x"), (2, "2024-01-02", "a", "x"), (3, "2024-01-02", "a", "x"), (4, "2024-01-01", "b", "x"),
         (5, "2024-01-02", None, "x"), (6, "2024-01-01", None, "x")],
        "comment_id long, interaction_date string, user_name string, text string")
    assert sorted(r.comment_id for r in c.dedupe_comments(df).collect()) == [2, 4, 6]
    assert c.duplicate_ratio(df).first()["duplicate_pct"] == 50.0


@pytest.mark.parametrize(("url", "path", "query"), [
    ("https://s.example/p/1/c/2", "https://s.example/p/1/c", ""),
    ("https://s.example/p/1/", "https://s.example/p/1", ""),
    ("https://s.example/p?id=1?c=2", "https://s.example", "https://s.example/p/id=1"),
    ("plain", "", ""),
    (None, "", ""),
])
def test_post_urls(spark, url, path, query):
    df = spark.createDataFrame([(url,)], "url string")
    found = df.select(t.post_url_from_path(F.col("url")), t.post_url_from_query(F.col("url"))).first()
    assert tuple(found) == (path, query)


@pytest.mark.parametrize(("text", "number"), [
    ("pedido 1234567", None), ("pedido 12345678", "12345678"), ("n 1234567890 e 87654321", "1234567890"),
    ("n 12345678901", "1234567890"), (None, None), ("", None),
])
def test_order_number(spark, text, number):
    assert spark.createDataFrame([(text,)], "t string").select(t.order_number(F.col("t"))).first()[0] == number


def test_synonyms_run_in_order(spark):
    rules = dict(PT.synonym_rules())
    assert rules["entregar"] == "recebido"
    df = spark.createDataFrame([("vou mandar n entregar normal",)], "t string")
    assert df.select(t.replace_synonyms(F.col("t"), PT.synonym_rules())).first()[0] == "vou mandar nao recebido normau"


def test_brand_aliases_become_the_brand():
    from dataclasses import replace
    rules = replace(PT, brand_aliases=("lojinha",)).synonym_rules()
    assert rules.index(("lojinha", "loja")) == rules.index(("loja", "loja")) + 1


def test_stop_words():
    words = PT.all_stop_words()
    assert {"pra", "para", "de"} <= set(words)
    assert not {"não", "que", "sem", "está"} & set(words)


def stem_word(word, rules):
    """The published procedure, word by word."""
    for step in STEPS:
        for rule in sorted((r for r in rules if r.step == step), key=lambda r: -len(r.suffix)):
            if (word.endswith(rule.suffix) and len(word) >= len(rule.suffix) + rule.min_stem
                    and word not in rule.exceptions):
                word = word[:len(word) - len(rule.suffix)] + rule.replacement
                if step in EXCLUSIVE:
                    return word
                break
    return word


def test_stems(spark):
    words = ("retornom ninguem atras transportador situacao pessimo mensagem solicitar respeitar verdadeiro gratis tenis "
             "ultima primeira negativo decepcionar enganosa consumidor devolucao fiscal valor mais mes servico extremamente "
             "campeona patrona chinesa super hoje que pedido nossos quinhao raquinho pobrezinho amavel terrivel possivel "
             "sangue jegue gangue dica medica bonitas boas leis animais papeis funis atores moveis mal ser s a").split()
    words += [p + r.suffix for r in PT.stem_rules for p in ("b", "br", "bra", "brac", "bracon", "braconam")]
    words += [w for r in PT.stem_rules for w in r.exceptions]
    df = spark.createDataFrame([(" ".join(words),)], "t string")
    found = df.select(stem(F.col("t"), PT.stem_rules)).first()[0].split(" ")
    assert dict(zip(words, found, strict=True)) == {w: stem_word(w, PT.stem_rules) for w in words}
    assert [stem_word(w, PT.stem_rules) for w in ("ninguem", "solicitar", "verdadeiro", "consumidor", "tenis", "super")] == [
        "ning", "solic", "verd", "consum", "tenil", "sup"]


def test_accents(spark):
    letters = "".join(map(chr, range(0xC0, 0x100)))
    plain = spark.createDataFrame([(letters,)], "t string").select(t.strip_accents(F.col("t"))).first()[0]
    assert plain == ("AAAAAAAECEEEEIIIIDNOOOOOxOUUUUYThss" "aaaaaaaeceeeeiiiidnooooo/ouuuuythy")


def test_letter_classes(spark):
    everything = "".join(chr(i) for i in range(1, 0x250)) + "日😀 "
    kept = spark.createDataFrame([(everything,)], "t string").select(t.letters_only(F.col("t"))).first()[0]
    assert kept == "".join(x for x in everything if x == " " or (x.isascii() and x.isalpha()) or 0xC0 <= ord(x) <= 0xFF)


def test_one_pass_residue_equals_the_steps(spark):
    texts = [" oi kkkk 12ab k1k ", "r$ abc_def", "kk", "", " ", "a日b kkk  "]
    df = spark.createDataFrame([(x,) for x in texts], "t string").select(t.remove_stop_words(F.col("t"), ["abc"]).alias("t"))
    both = df.select(t.residue_to_letters(F.col("t")), t.letters_only(t.strip_residue(F.col("t")))).collect()
    assert all(x[0] == x[1] for x in both)


@pytest.mark.parametrize(("least", "most"), [(0, 2), (1, 1), (3, 5)])
def test_length_test_is_the_word_count(spark, least, most):
    texts = ["", " ", "a", " a ", "a  b", "a b c ", " a b c d e", "a b c d e f", "x " * 20000]
    df = spark.createDataFrame([(x,) for x in texts], "t string")
    found = df.select(t.has_words(F.col("t"), least, most).alias("fits"), t.word_count(F.col("t")).alias("n")).collect()
    assert all(r.fits == (least <= r.n <= most) for r in found)
