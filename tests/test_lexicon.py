import pytest

from recado.plans.clean import learn_context
from recado.profiles import PT
from recado.sources import lexicon as lx


def line(number, form, lemma, pos):
    return "\t".join([number, form, lemma, pos, "_", "_", "0", "root", "_", "_"])


CONLLU = "\n".join([
    "# text = Ele canta na casa", line("1", "Ele", "ele", "PRON"), line("2", "canta", "Cantar", "VERB"), line("3-4", "na", "_", "_"),
    line("3", "em", "em", "ADP"), line("4", "a", "o", "DET"), line("5", "casa", "casa", "NOUN"), line("5.1", "x", "x", "NOUN"), "",
    line("1", "Casa", "casar", "VERB"), line("2", "casa", "casa", "NOUN"), line("3", "bom", "_", "ADJ"), line("4", "_", "_", "PUNCT"), "1\tbroken", ""])


def test_words_of_a_tagged_corpus(spark, rows, tmp_path):
    (tmp_path / "a.conllu").write_text(CONLLU)
    want = [("_", "PUNCT", "_"), ("a", "DET", "o"), ("canta", "VERB", "cantar"), ("casa", "NOUN", "casa"), ("casa", "VERB", "casar"),
            ("ele", "PRON", "ele"), ("em", "ADP", "em")]
    assert rows(lx.read_conllu(spark, str(tmp_path))) == want
    assert rows(lx.read_conllu(spark, str(tmp_path), least=2)) == [("casa", "NOUN", "casa")]


def test_an_empty_corpus_has_no_words(spark, tmp_path):
    (tmp_path / "a.conllu").write_text("# nothing\n\n")
    assert lx.read_conllu(spark, str(tmp_path)).count() == 0


def test_a_table_is_read_by_its_header(spark, rows, tmp_path):
    (tmp_path / "a.tsv").write_text("lemma\tsurface\tmore\tpos\ncasa\tcasas\t1\tNOUN\ncasa\tcasas\t2\tNOUN\n\tdias\t1\tNOUN\n")
    assert rows(lx.read_lexicon(spark, str(tmp_path / "a.tsv"))) == [("casas", "NOUN", "casa")]
    (tmp_path / "b.csv").write_text("surface,lemma\ncasas,casa\n")
    with pytest.raises(ValueError, match="lacks pos"):
        lx.read_lexicon(spark, str(tmp_path / "b.csv"), ",")


def test_a_context_is_learnt_from_comments_and_a_read_dictionary(spark, tmp_path):
    (tmp_path / "a.conllu").write_text(CONLLU)
    df = spark.createDataFrame([(1, "2024-01-01", "a", None, "t", "ele canta bem sempre"), (2, "2024-01-02", "b", None, "t", None)],
                               "comment_id long, interaction_date string, user_name string, url string, content_type string, text string")
    model = learn_context(df, PT, lx.read_conllu(spark, str(tmp_path))).model
    assert set(model.tags) == {"", "?", "PRON", "VERB", "ADP", "DET", "NOUN", "PUNCT"}
    size = len(model.tags)
    at = lambda x, y: model.costs[model.tags.index(x) * size + model.tags.index(y)]
    assert at("VERB", "?") < at("VERB", "NOUN") == at("VERB", "DET")
