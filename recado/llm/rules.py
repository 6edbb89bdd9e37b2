"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation weighs them, a posterior decides.

Everything is DataFrame expressions. The base figures of a text are worked out inside its row; no word leaves it. The corpus
enters the fit as counts of vote patterns: at most 3 ** (number of rules) rows, whatever its size, written once and
aggregated again in each round of the expectation-maximisation. Only the estimates (two per rule) pass through the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recado.sources.staging import staged

BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
#: A word of letters, its capital at the start if anywhere, with at most one mark of a sentence behind it.
PLAIN = r"(?<![^\x20\x09-\x0D])\p{L}[\p{Ll}\p{Lo}\p{Lm}\p{M}'’-]*+[.,;:?!]?(?![^\x20\x09-\x0D])"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
START = (0.95, 0.005), (0.7, 0.25)  # votes for and against: of a good document, of a bad one
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """Votes ``bad`` where a share is above one limit, ``good`` where it is at most the other, and abstains between."""

    name: str
    share: Column
    good_to: float
    bad_over: float

    def vote(self) -> Column:
        return (F.when(self.share > self.bad_over, F.lit(-1)).when(self.share <= self.good_to, F.lit(1)).otherwise(F.lit(0))
                .cast("tinyint"))


@dataclass
class Model:
    """Share of good documents, and for each rule how often it votes good and bad on either kind."""

    prior: float
    on_good: dict[str, tuple[float, float]] = field(default_factory=dict)
    on_bad: dict[str, tuple[float, float]] = field(default_factory=dict)

    def posterior(self, votes: dict[str, Column]) -> Column:
        """Probability of a good document, given its votes. A vote never counts against its own meaning; none tells nothing."""
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for name, vote in votes.items():
            (gg, gb), (bg, bb) = self.on_good[name], self.on_bad[name]
            odds += F.when(vote == 1, max(0.0, math.log(gg / bg))).when(vote == -1, min(0.0, math.log(gb / bb))).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def per_word(column: str) -> Column:
    return F.col(column) / F.greatest(F.col("n_words"), F.lit(1))


def rules() -> list[Rule]:
    return [
        Rule("symbols", F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1)), 0.02, 0.10),
        Rule("bars", per_word("_bars"), 0.02, 0.25),
        Rule("marks", per_word("_marks"), 0.05, 0.40),
        Rule("capitals", F.col("_capitals") / F.greatest(F.col("word_chars"), F.lit(1)), 0.25, 0.60),
        Rule("repeats", per_word("n_repeat_words"), 0.10, MAX_REPEAT_PERCENT / 100),
        Rule("doubles", per_word("_doubles"), 0.10, 0.30),
        Rule("lines", F.col("n_dup_lines") / F.greatest(F.col("_lines"), F.lit(1)), 0.20, 0.60),
        Rule("plain", 1 - per_word("_plain"), 0.30, 0.70),
        Rule("variety", 1 - per_word("_distinct"), 0.60, 0.85),
    ]


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _with_next(hashes: Column, step: int) -> Column:
    """Each hash joined with the one ``step`` places on."""
    return F.transform(hashes, lambda h, k: F.xxhash64(h, F.get(hashes, k + step)))


def _repeated_words(words: Column, windows: Column) -> Column:
    """Words in windows that occur twice or more, each counted once.

    The window hashes are sorted with their places, so equal ones stand side by side; the windows themselves are compared
    too, so a chance match of hashes does not count.
    """
    def same(order: Column, x: Column, k: Column) -> Column:
        other = F.get(order, k)
        return F.coalesce((other["h"] == x["h"]) & (F.slice(words, other["i"], WINDOW) == F.slice(words, x["i"], WINDOW)),
                          F.lit(False))

    def count(order: Column) -> Column:
        twice = F.filter(order, lambda x, k: same(order, x, k - 1) | same(order, x, k + 1))
        return F.aggregate(F.sort_array(F.transform(twice, lambda x: x["i"])),
                           F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
                           lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")),
                           lambda a: a["n"])

    order = F.sort_array(F.transform(windows, lambda h, k: F.struct(h.alias("h"), (k + 1).alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), let(order, count)).otherwise(F.lit(0).cast("long"))


def figures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base figures and what the rules need besides; a NULL text has no word and no line.

    The figures come out of a generator, one row for one row: filters on them are not moved below it, so the text is worked
    through once. Window hashes are built by doubling (1, 2, 4, 8 words) and compared as a set first; places are sorted
    only for texts in which some hash comes twice.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    count = lambda t, pattern: F.regexp_count(t, F.lit(pattern)).cast("long")

    def from_words(t: Column, words: Column, one: Column, windows: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            count(t, SYMBOLS).alias("n_symbols"),
            let(F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD)), lambda rows: F.struct(
                F.size(rows).alias("n"), (F.size(rows) - F.size(F.array_distinct(rows))).cast("long").alias("dup"))).alias("_rows"),
            _repeated_words(words, windows).alias("n_repeat_words"),
            count(t, r"\|").alias("_bars"),
            count(t, "!!").alias("_marks"),
            count(t, r"\p{Lu}").alias("_capitals"),
            count(t, PLAIN).alias("_plain"),
            F.size(F.filter(one, lambda h, k: F.coalesce(F.get(one, k - 1) == h, F.lit(False)))).alias("_doubles"),
            F.size(F.array_distinct(one)).alias("_distinct"))

    found = let(body, lambda t: let(F.filter(F.split(t, BLANKS), lambda w: w != ""), lambda words: let(
        F.transform(words, lambda w: F.xxhash64(w)), lambda one: let(_with_next(one, 1), lambda two: let(
            _with_next(two, 2), lambda four: let(
                F.slice(_with_next(four, 4), F.lit(1), F.greatest(F.size(four) - (WINDOW - 1), F.lit(0))),
                lambda windows: from_words(t, words, one, windows)))))))
    return docs.select("*", F.inline_outer(F.array(found))).withColumns(
        {"n_dup_lines": F.col("_rows.dup"), "_lines": F.col("_rows.n")}).drop("_rows")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def patterns(scored: DataFrame, chosen: list[Rule]) -> DataFrame:
    """Documents that pass the base rules, counted by their votes."""
    return scored.where(~base_failed()).groupBy(*[r.vote().alias(r.name) for r in chosen]).agg(F.count(F.lit(1)).alias("n"))


def estimate(counted: DataFrame, names: list[str], rounds: int = 25, settled: float = 1e-6) -> Model:
    """Expectation-maximisation over counted vote patterns, from ``START``: a rule seldom speaks against a good document,
    and a bad one trips about one rule in four, as there are many ways to be bad.

    Shares are smoothed by a few imagined votes of the same make, so that a rule which never votes bad, or a corpus without
    bad documents, does not turn the meaning of the two kinds round.
    """
    good, bad = [tuple(10 * x for x in (*s, 1 - sum(s))) for s in START]  # imagined votes: good, bad, none
    model = Model(0.8, dict.fromkeys(names, START[0]), dict.fromkeys(names, START[1]))
    for _ in range(rounds):
        p = model.posterior({n: F.col(n) for n in names})
        sums = {"all": F.sum("n"), "good": F.sum(F.col("n") * F.col("_p"))}
        for n in names:
            for vote, label in ((1, "up"), (-1, "down")):
                sums[f"{n}_{label}"] = F.sum(F.when(F.col(n) == vote, F.col("n")).otherwise(0))
                sums[f"{n}_{label}_good"] = F.sum(F.when(F.col(n) == vote, F.col("n") * F.col("_p")).otherwise(0.0))
        row = counted.withColumn("_p", p).agg(*[s.alias(k) for k, s in sums.items()]).first()
        if not row["all"]:
            return model
        n_good, n_bad = row["good"], row["all"] - row["good"]
        new = Model(min(0.999, max(0.001, (n_good + 4) / (row["all"] + 5))))
        for n in names:
            up, down = row[f"{n}_up_good"], row[f"{n}_down_good"]
            new.on_good[n] = (up + good[0]) / (n_good + sum(good)), (down + good[1]) / (n_good + sum(good))
            up, down = row[f"{n}_up"] - up, row[f"{n}_down"] - down
            new.on_bad[n] = (up + bad[0]) / (n_bad + sum(bad)), (down + bad[1]) / (n_bad + sum(bad))
        moved = max(abs(a - b) for n in names for x, y in ((new.on_good, model.on_good), (new.on_bad, model.on_bad))
                    for a, b in zip(x[n], y[n], strict=True))
        model = new
        if moved < settled:
            break
    return model


def _judged(scored: DataFrame, model: Model, chosen: list[Rule], least: float) -> DataFrame:
    return scored.withColumns({
        "base_failed": base_failed(), "p_good": model.posterior({r.name: r.vote() for r in chosen})}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("p_good") >= least))


def judge(docs: DataFrame, row_id: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """``row_id``, the base figures, ``base_failed``, the probability ``p_good`` and ``kept``, a row for each row of ``docs``.

    Every text is read once: its figures are written to the shared folder, the fit and the verdicts read them there. A NULL
    or empty text has no words and so fails the base. ``kept`` needs a passed base and a probability of ``least`` or more.
    """
    chosen = rules()
    scored = staged(figures(docs.select(row_id, F.col(text).alias("_text")), "_text").drop("_text"), "figures")
    model = estimate(staged(patterns(scored, chosen), "votes"), [r.name for r in chosen])
    return _judged(scored, model, chosen, least).select(row_id, *BASE, "base_failed", "p_good", "kept")


def keep_good(docs: DataFrame, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, as they are, that ``judge`` keeps.

    Texts are read twice, for the fit and for the verdicts, as that is less than writing and sorting them for a join.
    """
    chosen = rules()
    model = estimate(staged(patterns(figures(docs.select(F.col(text).alias("_text")), "_text"), chosen), "votes"),
                     [r.name for r in chosen])
    own = docs.select(F.struct(*docs.columns).alias("_row"), F.col(text).alias("_text"))
    kept = _judged(figures(own, "_text"), model, chosen, least).where("kept")
    return kept.select("_row.*")
