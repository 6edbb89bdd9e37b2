"""The composed cleaner: comments in, sentences out, with a reason for each rejected row."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from recado.functions import text as t
from recado.functions.stem import stem
from recado.operators import comments as c
from recado.operators import sentences as s
from recado.operators.tags import ContextLexicon
from recado.profiles import LanguageProfile
from recado.sources.staging import staged

TRACE = "array<struct<sentence_idx:int,stage_ord:int,stage:string,text:string>>"
TASK_COMMENTS = 5_000  # comments that a task cleans at most, about
TASK_TEXT_BYTES = 512 * 1024  # of texts that stand beside their sentences: half of what a dictionary of a Parquet file holds by default
COMMENT_COLUMNS = ("comment_id", "interaction_date", "user_name", "url", "content_type")


def narrow_comments(df: DataFrame, strict_dates: bool = True) -> DataFrame:
    """Comments with a text, dates parsed, with a digest for the text: what de-duplication and publish dates need.

    Without ``strict_dates`` comments with a bad date are left out (`comments.bad_dates` has them), else they end the run.
    """
    return _narrow(df, strict_dates).drop("text")


def _narrow(df: DataFrame, strict_dates: bool) -> DataFrame:
    df = c.with_ids(c.drop_null_text(df))
    dated = c.parse_dates(df if strict_dates else df.where(c.has_good_date()))
    return c.with_text_key(dated.select(*COMMENT_COLUMNS, "text"))


@dataclass(frozen=True)
class CommentCounts:
    """Comments with a text, and those that stay of them, counted while the cleaning reads them."""

    given: Observation = field(default_factory=Observation)
    once: Observation = field(default_factory=Observation)


def prepared_comments(df: DataFrame, network: str | None = None, strict_dates: bool = True, counts: CommentCounts | None = None,
                      with_texts: bool = True) -> DataFrame:
    """NULL texts and duplicates dropped, post address and publish date added; with ``text_key``.

    Which rows stay, and their dates, is worked out on narrow columns with a digest for the text; the
    texts themselves are shuffled once, by id and digest, into the tasks of the text work, and cut to one copy there, so that a comment that
    several extracts bring stays one. ``strict_dates``: see `narrow_comments`; ``with_texts``: see `clean_tagged`.
    """
    narrow, n = _narrow(df, strict_dates).withColumn("_bytes", F.octet_length("text")).drop("text"), F.count(F.lit(1)).alias("n")
    posts = c.dedupe_comments(narrow.observe(counts.given, n) if counts else narrow)
    posts = (posts.observe(counts.once, n) if counts else posts).withColumn("url", c.post_url(F.col("url"), network))
    posts = staged(posts, "comments-once")  # read for the posts' dates, then for their rows
    found = posts.agg(n, F.coalesce(F.sum("_bytes"), F.lit(0)).alias("bytes")).first()
    tasks = text_tasks(found["n"], df.sparkSession.sparkContext.defaultParallelism)
    if with_texts:
        tasks = max(tasks, 1 + found["bytes"] // TASK_TEXT_BYTES)
    texts = c.texts_dealt(c.with_ids(c.drop_null_text(df)), tasks)
    return (texts.join(c.publish_date(posts.drop("_bytes")).repartition(tasks, *c.IDENTITY), list(c.IDENTITY))
            .select(*COMMENT_COLUMNS, "publish_date", F.col("text").alias("original_text"), "text_key"))


def text_tasks(n_comments: int, cores: int) -> int:
    """Tasks for the text work, which takes far longer than reading its rows: Spark would cut it by bytes, into one or two tasks a core that end far apart."""
    return max(1 + n_comments // TASK_COMMENTS, min(4 * cores, 1 + n_comments // 100))


def clean_tagged(df: DataFrame, profile: LanguageProfile, remove_mandatory: bool = True, stemming: bool = True,
                 network: str | None = None, keep_length_rejects: bool = False,
                 lexicon: DataFrame | ContextLexicon | None = None, with_text_key: bool = False, strict_dates: bool = True,
                 counts: CommentCounts | None = None, with_texts: bool = True) -> DataFrame:
    """Every sentence, and every comment rejected whole, with ``reject_reason`` (NULL when kept).

    Sentences of the wrong length are in neither output, unless asked for. With a ``lexicon`` table the
    lemmas come from it instead of the profile's own entries; a profile with more entries than a plan may carry is
    such a table too. `learn_context` gives one that chooses among a word's lemmas by its neighbours. ``with_text_key`` keeps the digest of the original text. ``strict_dates``: see `narrow_comments`.

    A text stands beside each of its sentences, and a Parquet file keeps it once as long as its dictionary holds all texts of the task: so
    there is a task for each `TASK_TEXT_BYTES` of texts, unless ``with_texts`` says that the texts are not written.
    """
    tagged = tagged_sentences(prepared_comments(df, network, strict_dates, counts, with_texts), profile, remove_mandatory, stemming, keep_length_rejects, lexicon)
    return tagged if with_text_key else tagged.drop("text_key")


def tagged_sentences(prepared: DataFrame, profile: LanguageProfile, remove_mandatory: bool = True, stemming: bool = True,
                     keep_length_rejects: bool = False, lexicon: DataFrame | ContextLexicon | None = None) -> DataFrame:
    """Sentences of rows with ``original_text`` and ``text_key``: the rows' columns, ``sentence_idx``, ``reject_reason``, ``text``."""
    if lexicon is None and len(profile.lemma_map()) > s.LITERAL_LEMMAS:
        lexicon = s.lexicon_table(prepared.sparkSession, profile)
    tagged = prepared.withColumn("_reason", c.comment_reject_reason(F.col("original_text"), profile.brand))
    front = s.front(F.col("original_text"), profile, keep_length_rejects)
    as_rejected = F.array(F.struct(
        F.lit(None).cast("int").alias("sentence_idx"), F.col("_reason").alias("reject_reason"),
        F.col("original_text").alias("text")))
    options = {"remove_mandatory": remove_mandatory, "stemming": stemming, "keep_length_rejects": keep_length_rejects}

    if lexicon is not None:
        fronted = tagged.withColumn("_front", F.when(F.col("_reason").isNull(), front))
        keys = [x for x in (*c.IDENTITY, "user_name") if x in prepared.columns]
        tagged = s.with_lemmas(fronted, lexicon, "_front", keys, profile.lemma_exempt, store="sentences-before-lemmas")
        front = F.col("_front")
    parts = F.when(F.col("_reason").isNull(), s.back(front, profile, lemmas_done=lexicon is not None, **options)).otherwise(as_rejected)
    return tagged.select(*prepared.columns, F.inline(parts))


def learn_context(df: DataFrame, profile: LanguageProfile, lexicon: DataFrame, strict_dates: bool = True) -> ContextLexicon:
    """A dictionary table with the model of tag pairs learnt from the sentences of these comments, each comment once.

    Comments that are rejected whole, and sentences of the wrong length, are not learnt from. Pass the result as ``lexicon`` to training and inference
    alike: its model is a small value (`TagModel.to_json`).
    """
    prepared = prepared_comments(df, strict_dates=strict_dates, with_texts=False)
    wanted = prepared.where(c.comment_reject_reason(F.col("original_text"), profile.brand).isNull())
    front = staged(wanted.select(*c.IDENTITY, "user_name", s.front(F.col("original_text"), profile).alias("_front")), "sentences-for-tags")
    return ContextLexicon(lexicon, s.fit_tags(front, lexicon, "_front", [*c.IDENTITY, "user_name"]))


def kept(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("reject_reason").isNull()).drop("reject_reason")


def removed(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("reject_reason").isNotNull())


def clean(df: DataFrame, profile: LanguageProfile, **options) -> tuple[DataFrame, DataFrame]:
    """``(kept, removed)``. Both read the same tagged plan; store ``clean_tagged`` to run it once."""
    tagged = clean_tagged(df, profile, **options)
    return kept(tagged), removed(tagged)


def clean_trace(df: DataFrame, profile: LanguageProfile, stemming: bool = True, stages: Collection[str] | None = None) -> DataFrame:
    """The text after each stage, for the rows that reach it: ``(comment_id, sentence_idx, stage_ord, stage, text)``.

    Each comment is gone through once, its sentences an array in its row. ``stages`` names those whose rows are wanted, if not all.
    """
    brand = profile.brand
    text = F.col("text")
    tasks = text_tasks(df.count(), df.sparkSession.sparkContext.defaultParallelism)
    base = c.dedupe_comments(c.with_ids(c.drop_null_text(df)).select("comment_id", "interaction_date", "user_name", "text"))
    base = base.repartition(tasks, "comment_id", "user_name")
    mention, named = t.is_foreign_mention(text, brand), t.is_name_first(text, brand)
    no_stops = lambda x: t.remove_stop_words(x, profile.all_stop_words())

    whole = base.select("comment_id", "text", mention.alias("_mention"), named.alias("_named"))
    for name, source, fn in (
            ("lower", "text", t.lower),
            ("handles", "lower", t.strip_handles),
            ("brand", "handles", lambda x: t.strip_brand(x, brand)),
            ("marks", "brand", t.normalise_marks)):
        whole = whole.withColumn(name, fn(F.col(source)))
    reach = ~F.col("_mention") & ~F.col("_named")
    in_whole = {
        "deduped": (text, F.lit(True)),
        "mentions": (text, ~F.col("_mention")),
        "names": (text, reach),
        **{name: (F.col(name), reach) for name in ("lower", "handles", "brand", "marks")},
    }

    marks = t.normalise_marks(t.protect_abbreviations(F.col("brand"), profile.abbreviations)) if profile.abbreviations else F.col("marks")
    parts = F.transform(F.when(reach, t.sentences(marks, bool(profile.abbreviations))), lambda x, i: F.struct(
        i.alias("sentence_idx"), x.alias("sentences")))
    # A stage is worked out for the sentences that reach it: NULL for the others, which have no such row.
    always, sized, wanted = lambda p: F.lit(True), lambda p: p["_sized"], lambda p: p["_wanted"]
    fields = ["sentence_idx", "sentences"]
    for name, source, reached, fn in (
            ("stop_words", "sentences", always, lambda p, x: no_stops(x)),
            ("residue", "stop_words", always, lambda p, x: t.strip_residue(x)),
            ("letters", "residue", always, lambda p, x: t.letters_only(x)),
            ("_sized", "letters", always, lambda p, x: s.has_right_length(x, profile)),
            ("lemmas", "letters", sized, lambda p, x: s.lemmatise(x, profile)),
            ("accents", "lemmas", sized, lambda p, x: t.strip_accents(x)),
            ("synonyms", "accents", sized, lambda p, x: t.replace_synonyms(x, profile.synonym_rules())),
            ("_wanted", "synonyms", always, lambda p, x: sized(p) & s.reject_reason(x, profile).isNull()),
            ("useless", "synonyms", wanted, lambda p, x: t.remove_useless(x, profile.useless)),
            ("stems", "useless", wanted, lambda p, x: stem(F.trim(t.collapse_spaces(x)), profile.stem_rules) if stemming else x),
            ("final", "stems", wanted, lambda p, x: t.collapse_spaces(x))):
        parts = F.transform(parts, lambda p: F.struct(*[p[f].alias(f) for f in fields], F.when(reached(p), fn(p, p[source])).alias(name)))
        fields.append(name)

    def in_part(p: Column) -> Column:
        return _stages({
            **{name: (p[name], always(p)) for name in ("sentences", "stop_words", "residue", "letters")},
            "length": (p["letters"], sized(p)),
            **{name: (p[name], sized(p)) for name in ("lemmas", "accents", "synonyms")},
            "mandatory": (p["synonyms"], wanted(p)),
            **{name: (p[name], wanted(p)) for name in ("useless", "stems")},
            "final": (p["final"], wanted(p) & ~t.is_blank(p["final"])),
        }, 1 + len(in_whole), p["sentence_idx"], stages)

    comment_rows = _stages(in_whole, 1, F.lit(None).cast("int"), stages)
    sentence_rows = F.coalesce(F.flatten(F.transform(parts, in_part)), F.array().cast(TRACE))
    return whole.select("comment_id", F.inline(F.concat(comment_rows, sentence_rows)))


def _stages(stages: dict[str, tuple[Column, Column]], first: int, idx: Column, wanted: Collection[str] | None) -> Column:
    entries = [F.when(reached, F.struct(idx.alias("sentence_idx"), F.lit(first + i).alias("stage_ord"), F.lit(name).alias("stage"), text.alias("text")))
               for i, (name, (text, reached)) in enumerate(stages.items()) if wanted is None or name in wanted]
    return (F.filter(F.array(*entries), lambda e: e.isNotNull()) if entries else F.array()).cast(TRACE)
