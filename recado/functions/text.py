"""Text steps as column expressions: one function per cleaning step, all evaluated in the JVM.

Character classes are spelled out (``WS``, ``NON_WORD``) because ``\\s`` and ``\\w`` cover only ASCII
in Java, while comments hold any Unicode text.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WS = r"[\x09-\x0d\x1c-\x20\x85\p{Z}]"
NOT_WS = r"[^\x09-\x0d\x1c-\x20\x85\p{Z}]"
OTHER_WS = r"[\x09-\x0d\x1c-\x1f\x85\p{Z}&&[^ ]]"
NON_WORD = r"[^\p{L}\p{N}_]+"

# Patterns of the cleaning rules.
NAME_START = rf"^[A-ZÀ-Ú][a-zà-ú]+({WS}|,)[A-ZÀ-Ú][a-zà-ú]{{1,15}}"
HANDLE = rf"@{NOT_WS}+"
DOTS = r"\.\.+"
SPACE_BEFORE_MARK = rf'{WS}([?.!"](?:{WS}|$))'
SENTENCE_END = rf"(?<=[.!?]){WS}+"
LAUGHTER = r"kk+"
CURRENCY = r"r\$"
LITERAL_NEWLINE = r"(?:\\n)+"
LITERAL_TAB = r"(?:\\t)+"
# All but a-z, A-Z and À-ÿ, and the same without the space. Written as ranges to remove: the JDK is many
# times slower on a negated class of several ranges.
NO_LETTER = r"[\x00-@\[-`{-\xbf\x{100}-\x{10ffff}]"
NOT_LETTER_OR_SPACE = r"[\x00-\x1f!-@\[-`{-\xbf\x{100}-\x{10ffff}]+"
ORDER_NUMBER = r"(\p{Nd}{8,10})"

# Letters U+00C0 to U+00FF and their plain forms, then those that become two letters.
ACCENTED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖ×ØÙÚÛÜÝàáâãäåçèéêëìíîïðñòóôõö÷øùúûüýÿ"
PLAIN = "AAAAAACEEEEIIIIDNOOOOOxOUUUUYaaaaaaceeeeiiiidnooooo/ouuuuyy"
TWO_LETTERS = (("Æ", "AE"), ("Þ", "Th"), ("ß", "ss"), ("æ", "ae"), ("þ", "th"))


def shortest_terms(terms: Iterable[str]) -> list[str]:
    """The terms needed to find any of them: where a term that holds another one is, so is the shorter."""
    needed: list[str] = []
    for term in sorted(dict.fromkeys(terms), key=len):
        if not any(short in term for short in needed):
            needed.append(term)
    return needed


# -- comment level -------------------------------------------------------------------------------

def is_foreign_mention(text: Column, brand: str) -> Column:
    """Starts with a handle and does not name the brand's own one."""
    return text.startswith("@") & ~text.contains("@" + brand)


def is_name_first(text: Column, brand: str) -> Column:
    """Starts with two capitalised words, as a tagged person's name does, and never names the brand."""
    return text.rlike(NAME_START) & ~text.contains(brand)


def post_url_from_path(url: Column) -> Column:
    """The post's address: last path segment and empty segments dropped. NULL becomes ''."""
    parts = F.split(F.coalesce(url, F.lit("no_url")), "/")
    kept = F.filter(F.slice(parts, 1, F.size(parts) - 1), lambda p: p != "")
    return F.replace(F.array_join(kept, "/"), F.lit(":/"), F.lit("://"))


def post_url_from_query(url: Column) -> Column:
    """The post's address: everything after the last '?' dropped; '' when there is none."""
    parts = F.split(F.coalesce(url, F.lit("no_url")), "[?]")
    kept = F.filter(F.slice(parts, 1, F.size(parts) - 1), lambda p: p != "")
    return F.array_join(kept, "/")


def lower(text: Column) -> Column:
    return F.lower(text)


def strip_handles(text: Column) -> Column:
    return F.regexp_replace(text, HANDLE, "")


def strip_brand(text: Column, brand: str) -> Column:
    """Only at the very start, and without asking for a word boundary."""
    return F.regexp_replace(text, "^" + re.escape(brand), "")


def normalise_marks(text: Column) -> Column:
    """Runs of dots to one, no space before a closing mark, commas to dots."""
    one_dot = F.regexp_replace(text, DOTS, ".")
    closed_up = F.regexp_replace(one_dot, SPACE_BEFORE_MARK, "$1")
    return F.replace(closed_up, F.lit(","), F.lit("."))


STOP_OF_WORD = "\ue000"  # stands for the stop of an abbreviation until sentences are split


def protect_abbreviations(text: Column, abbreviations: Sequence[str]) -> Column:
    """Lower-case text in which the stops of these words, given without their last stop, end no sentence."""
    if not abbreviations:
        return text
    words = "|".join(re.escape(w) for w in sorted(abbreviations, key=lambda w: (-len(w), w)))
    return F.regexp_replace(text, rf"(?<![\p{{L}}\p{{N}}.])({words})\.(?=\s)", "$1" + STOP_OF_WORD)


def sentences(text: Column, protected: bool = False) -> Column:
    """Split after '.', '!' or '?' followed by white space. An empty comment gives one empty sentence.

    ``protected``: the stops that `protect_abbreviations` has marked are given back.
    """
    parts = F.split(F.regexp_replace(text, SENTENCE_END + r"\z", ""), SENTENCE_END)
    return F.transform(parts, lambda s: F.replace(s, F.lit(STOP_OF_WORD), F.lit("."))) if protected else parts


# -- sentence level ------------------------------------------------------------------------------

def remove_stop_words(text: Column, stop_words: Sequence[str]) -> Column:
    """Words kept in order, joined by one space. An empty edge token survives, so edge spaces do too."""
    words = F.split(F.regexp_replace(text, NON_WORD, " "), " ")
    kept = F.filter(words, lambda w: ~w.isin(list(stop_words)) & ~w.rlike(r"^\p{N}+$"))
    return F.array_join(kept, " ")


def strip_residue(text: Column) -> Column:
    text = collapse_spaces(text)
    text = F.regexp_replace(text, rf"^{WS}+", "")
    text = F.regexp_replace(text, LAUGHTER, "")
    text = F.regexp_replace(text, CURRENCY, "")
    text = F.regexp_replace(text, LITERAL_NEWLINE, ". ")
    return F.regexp_replace(text, LITERAL_TAB, ". ")


def letters_only(text: Column) -> Column:
    return F.regexp_replace(text, NOT_LETTER_OR_SPACE, "")


def residue_to_letters(text: Column) -> Column:
    """`strip_residue`, then `letters_only`, for words that single spaces separate: what `remove_stop_words`
    gives. There are no double spaces, marks or backslashes left to find in such a text, and neither
    removal makes new matches for the other, so one pass over it is enough."""
    return F.regexp_replace(F.ltrim(text), f"{LAUGHTER}|{NOT_LETTER_OR_SPACE}", "")


def tokens(text: Column) -> Column:
    """Words between white space, no empty ones."""
    return F.filter(F.split(F.regexp_replace(text, OTHER_WS, " "), " "), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(tokens(text))


def has_words(text: Column, least: int, most: int) -> Column:
    """Word count within both limits, for words that spaces separate."""
    words = rf"[^ ]+(?: +[^ ]+){{{max(least, 1) - 1},{most - 1}}}"
    return text.rlike(rf"^ *{words} *$" if least > 0 else rf"^ *(?:{words})? *$")


def length_class(n_words: Column, lower_limit: int, upper_limit: int) -> Column:
    return (F.when(n_words < lower_limit, "small")
            .when(n_words > upper_limit, "large")
            .otherwise("medium"))


def strip_accents(text: Column) -> Column:
    for accented, plain in TWO_LETTERS:
        text = F.replace(text, F.lit(accented), F.lit(plain))
    return F.translate(text, ACCENTED, PLAIN)


def replace_synonyms(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Ordered literal replacement: each rule works on what the one before it left.

    A fold over a constant array: 80 nested calls would outgrow the JIT's method size.
    """
    if not rules:
        return text
    table = F.array(*[F.struct(F.lit(k).alias("old"), F.lit(v).alias("new")) for k, v in rules])
    return F.aggregate(table, text, lambda acc, r: F.replace(acc, r["old"], r["new"]))


def has_any(text: Column, terms: Iterable[str]) -> Column:
    """Any term found as a substring."""
    needed = shortest_terms(terms)
    return F.exists(F.array(*map(F.lit, needed)), lambda term: F.contains(text, term)) if needed else F.lit(False)


def remove_useless(text: Column, patterns: Sequence[str]) -> Column:
    for pattern in patterns:
        text = F.regexp_replace(text, pattern, " ")
    return text


def collapse_spaces(text: Column) -> Column:
    return F.regexp_replace(text, " {2,}", " ")


def is_blank(text: Column) -> Column:
    return text.isin("", " ")


def bigrams(text: Column) -> Column:
    """Adjacent word pairs, as 'first second'; none for fewer than two words."""
    return _pairs(tokens(text))


def _pairs(words: Column) -> Column:
    first = F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0)))
    return F.zip_with(first, F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
                      lambda a, b: F.concat_ws(" ", a, b))


def order_number(text: Column) -> Column:
    """First run of 8 to 10 digits; a longer run gives its first 10."""
    return F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), ORDER_NUMBER, 1), F.lit(""))


def text_key(text: Column) -> Column:
    """A 32-byte stand-in for a long text, so that shuffles by text need not carry it."""
    return F.unhex(F.sha2(text, 256))
