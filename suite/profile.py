"""A test profile whose words occur in the test tables (invented prose in en, fr, de and es)."""

from __future__ import annotations

from recado.functions.text import NO_LETTER
from recado.profiles import PT, LanguageProfile, Lemma, Taxonomy

TEST = LanguageProfile(
    name="test",
    brand="erreth",
    stop_words=tuple("the of and to a is that it for was on with be as by this are at an from in la le der die de que "
                     "des und et en les un".split()),
    keep_words=("that", "with", "from"),
    extra_stop_words=("du", "zu"),
    synonyms=((" er ", " erst "), ("ntreou", "ntre"), ("thth", "thing"), ("thing", "thin"), (" nd ", " and "),
              ("esndha", "esth"), ("eaux", "eau"), ("onre", "onr"), ("heit", "keit"), ("cion", "sion"), ("ing", "en")),
    mandatory=("thin", "thinor", "ntre", "reed", "onr", "keit", "eau", "sion", "thnd", "erth", "lich", "esth", "haer"),
    blacklist=("onlyhe atshsh", "licensed"),
    useless=("thsh", "ha reedes", f"(^|{NO_LETTER})(re){NO_LETTER}", f"(^|{NO_LETTER})(ti){NO_LETTER}", "sch", "schl"),
    lemma_exempt=("los",),
    lemmas=(
        Lemma("thndly", "VERB", "thndar"), Lemma("aterth", "NOUN", "aterthes"), Lemma("therhean", "ADJ", "therno"),
        Lemma("für", "ADP", "fur"), Lemma("thes", "NOUN", "theso"), Lemma("ha", "VERB", "haben"),
        Lemma("los", "NOUN", "lo"), Lemma("erin", "VERB", "erir"), Lemma("éen", "NOUN", "éon"),
    ),
    stem_rules=PT.stem_rules,
)

TAXONOMY = Taxonomy(
    terms=(
        ("Loved it", ("thndly thtithly", "nd theaeati", "sch erüver")),
        ("Late delivery", ("esndha reedes", "er ntre", "para osóciónta")),
        ("Wrong item", ("erin ntreou", "nicht aulich", "er ntre")),
        ("Unknown cluster", ("für sch", "onesnt nd")),
        ("Refund", ("ndnd onre", "ti thintith")),
        ("Advert", ("licensed under",)),
    ),
    sentiments=(
        ("Positivo", ("Loved it",)),
        ("Negativo", ("Late delivery", "Wrong item", "Refund")),
        ("Outro", ("Advert",)),
    ),
    problems=(("Delivery", ("Late delivery", "Wrong item")), ("Money", ("Refund",))),
    unknown_label="Unknown cluster",
)
