"""Cleaning of sentences, kept as arrays inside the comment's row until the last step.

``front`` gives an array of ``(sentence_idx, text)`` for a comment, up to the length rule; ``back``
carries it through to ``(sentence_idx, reject_reason, text)``. As no row is exploded before the end,
no filter can be pushed below the text work and make Spark do that work twice.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recado.functions import text as t
from recado.functions.stem import stem
from recado.operators import tags
from recado.operators.skew import SMALL_ROWS
from recado.operators.tags import ContextLexicon, TagModel
from recado.profiles import LEMMATISED, LanguageProfile
from recado.sources.staging import staged

LITERAL_LEMMAS = 500  # entries a plan carries; a larger dictionary is a table
BLOCK_BYTES = 4 * 1024 * 1024  # of sentences that get the entries of their words from a large dictionary together


def comment_text(text: Column, brand: str, abbreviations: Sequence[str] = ()) -> Column:
    """Lower case, handles, brand, marks: the last text before the split. Stops of ``abbreviations`` are marked before commas become
    stops."""
    return t.normalise_marks(t.protect_abbreviations(t.strip_brand(t.strip_handles(t.lower(text)), brand), abbreviations))


def sentence_letters(text: Column, profile: LanguageProfile) -> Column:
    return t.residue_to_letters(t.remove_stop_words(text, profile.all_stop_words()))


def front(text: Column, profile: LanguageProfile, keep_length_rejects: bool = False) -> Column:
    whole = comment_text(text, profile.brand, profile.abbreviations)
    parts = F.transform(t.sentences(whole, bool(profile.abbreviations)), lambda s, i: F.struct(
        i.alias("sentence_idx"), sentence_letters(s, profile).alias("text")))
    if keep_length_rejects:
        return parts
    return F.filter(parts, lambda s: has_right_length(s["text"], profile))


def has_right_length(text: Column, profile: LanguageProfile) -> Column:
    return t.has_words(text, profile.lower_limit, profile.upper_limit)


def unaccented(text: Column, profile: LanguageProfile) -> Column:
    """Accents, then synonyms."""
    return t.replace_synonyms(t.strip_accents(text), profile.synonym_rules())


def reject_reason(text: Column, profile: LanguageProfile) -> Column:
    return (F.when(~t.has_any(text, profile.mandatory), "mandatory")
            .when(t.has_any(text, profile.blacklist), "blacklist"))


def stemmed(text: Column, profile: LanguageProfile, stemming: bool) -> Column:
    text = t.remove_useless(text, profile.useless)
    if not stemming:
        return t.collapse_spaces(text)
    return stem(F.trim(t.collapse_spaces(text)), profile.stem_rules)


def back(parts: Column, profile: LanguageProfile, remove_mandatory: bool = True, stemming: bool = True,
         lemmas_done: bool = False, keep_length_rejects: bool = False) -> Column:
    """From sentences after the length rule to sentences with their final text and reject reason."""
    lemma = (lambda x: x) if lemmas_done else (lambda x: lemmatise(x, profile))

    def length_reason(s: Column) -> Column:
        if not keep_length_rejects:
            return F.lit(None).cast("string")
        return F.when(~has_right_length(s["text"], profile), "length")

    parts = F.transform(parts, lambda s: F.struct(s["sentence_idx"].alias("sentence_idx"), length_reason(s).alias("reject_reason"), s["text"].alias("text")))
    parts = F.transform(parts, lambda s: F.struct(
        s["sentence_idx"].alias("sentence_idx"), s["reject_reason"].alias("reject_reason"),
        F.when(s["reject_reason"].isNull(), unaccented(lemma(s["text"]), profile)).otherwise(s["text"]).alias("text")))
    if remove_mandatory:
        parts = F.transform(parts, lambda s: F.struct(
            s["sentence_idx"].alias("sentence_idx"),
            F.when(s["reject_reason"].isNull(), reject_reason(s["text"], profile)).otherwise(s["reject_reason"])
            .alias("reject_reason"), s["text"].alias("text")))
    parts = F.transform(parts, lambda s: F.struct(
        s["sentence_idx"].alias("sentence_idx"), s["reject_reason"].alias("reject_reason"),
        F.when(s["reject_reason"].isNull(), stemmed(s["text"], profile, stemming)).otherwise(s["text"]).alias("text")))
    return F.transform(parts, lambda s: F.struct(
        s["sentence_idx"].alias("sentence_idx"),
        F.when(s["reject_reason"].isNull() & t.is_blank(s["text"]), "blank").otherwise(s["reject_reason"])
        .alias("reject_reason"), s["text"].alias("text")))


def lemmatise(text: Column, profile: LanguageProfile) -> Column:
    """Dictionary lemmas of a profile, by a constant map that the plan carries: no shuffle.

    Each word is looked up by a pass over the map, so `plans.clean` gives more than `LITERAL_LEMMAS` entries to `with_lemmas`.
    """
    return _looked_up(text, profile.lemma_map())


def _looked_up(text: Column, lemmas: dict[str, str]) -> Column:
    if not lemmas:
        return text
    return _replaced(text, F.create_map(*[F.lit(x) for pair in lemmas.items() for x in pair]))


def _replaced(text: Column, table: Column) -> Column:
    return F.array_join(F.transform(F.split(text, " "), lambda w: F.coalesce(F.try_element_at(table, w), w)), " ")


def lexicon_table(spark: SparkSession, profile: LanguageProfile) -> DataFrame:
    """A profile's own entries as ``(surface, pos, lemma)``."""
    return spark.createDataFrame([(e.surface, e.pos, e.lemma) for e in profile.lemmas], "surface string, pos string, lemma string")


def with_lemmas(df: DataFrame, lexicon: DataFrame | ContextLexicon, parts: str, keys: list[str], exempt: tuple[str, ...] = (),
                small_rows: int = SMALL_ROWS, store: str | None = None) -> DataFrame:
    """``df`` with lemmas in the sentences ``parts`` (arrays of ``(sentence_idx, text)``), from a ``(surface, pos, lemma)`` table.

    A surface with several lemmas gets the smallest; with a `ContextLexicon`, the one that its neighbours speak for. A table of up to
    `LITERAL_LEMMAS` words that change goes with the plan and is looked up in place; a larger one is joined, and reads ``df`` twice:
    it should be stored, or is first, under the name ``store``. ``keys`` tell its rows apart, NULLs included.
    """
    stored = lambda: staged(df, store) if store else df
    if isinstance(lexicon, ContextLexicon):
        found = _with_word_map(stored(), tags.surface_options(lexicon.entries, lexicon.model.tags, exempt), parts, keys, small_rows)
        options = F.transform(parts, lambda p: F.struct(
            p["sentence_idx"].alias("sentence_idx"), p["text"].alias("text"), _options(p["text"]).alias("options")))
        lemmas = F.transform(options, lambda p: F.struct(
            p["sentence_idx"].alias("sentence_idx"), F.array_join(tags.best_words(p["options"], lexicon.model), " ").alias("text")))
        looked_up = F.when(F.col("_words").isNull(), F.col(parts)).otherwise(lemmas)
    else:
        entries = (lexicon.where(F.col("pos").isin(*LEMMATISED) & ~F.col("surface").isin(*exempt))
                   .groupBy("surface").agg(F.min("lemma").alias("lemma")).where("lemma <> surface"))
        most = min(LITERAL_LEMMAS, small_rows)
        few = entries.limit(most + 1).collect()
        if len(few) <= most:
            return df.withColumn(parts, F.transform(parts, lambda p: F.struct(
                p["sentence_idx"].alias("sentence_idx"), _looked_up(p["text"], {r["surface"]: r["lemma"] for r in few}).alias("text"))))
        found = _with_word_map(stored(), entries, parts, keys, small_rows)
        looked_up = F.when(F.col("_words").isNull(), F.col(parts)).otherwise(F.transform(parts, lambda p: F.struct(
            p["sentence_idx"].alias("sentence_idx"), _replaced(p["text"], F.col("_words")).alias("text"))))
    return found.withColumn(parts, looked_up).drop("_row", "_words")


def _options(text: Column) -> Column:
    words = F.coalesce(F.col("_words"), F.create_map().cast(f"map<string, array<{tags.OPTION}>>"))
    return tags.word_options(F.split(text, " "), words)


def _with_word_map(df: DataFrame, entries: DataFrame, parts: str, keys: list[str], small_rows: int) -> DataFrame:
    """``df`` with ``_words``: a map from a row's words to what ``entries``, a surface and a value, has for them; NULL if it has none.

    The dictionary is cut to the distinct words of the corpus. A row's few such words are joined with it and come back to
    the row as a small map, so no sentence is taken apart and put together again. A large dictionary goes by blocks (`_with_block_maps`).
    """
    value = next(x for x in entries.columns if x != "surface")
    row = F.sha2(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}), 256)
    words = df.where(F.col(parts).isNotNull()).select(row.alias("_row"), F.explode(F.array_distinct(F.flatten(
        F.transform(parts, lambda p: F.split(p["text"], " "))))).alias("surface"))
    used = staged(entries.join(words.select("surface").distinct(), "surface", "left_semi"), "lemmas")
    if used.limit(small_rows + 1).count() > small_rows:
        return _with_block_maps(df, used, value, parts, keys)
    found = words.join(F.broadcast(used), "surface")
    maps = found.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("surface", value))).alias("_words"))
    return df.withColumn("_row", row).join(maps, "_row", "left")


def _with_block_maps(df: DataFrame, entries: DataFrame, value: str, parts: str, keys: list[str]) -> DataFrame:
    """`_with_word_map` for a large dictionary: rows are dealt into blocks of about `BLOCK_BYTES` of sentences, and a block gets the entries of its
    distinct words once, so neither a row's words nor their entries are shuffled with a digest of the row.

    A word is joined once a block at most, however common. The entries are never broadcast.
    """
    own = F.flatten(F.transform(parts, lambda p: F.split(p["text"], " ")))
    n_bytes = df.select(F.aggregate(parts, F.lit(0).cast("bigint"), lambda n, p: n + F.coalesce(F.octet_length(p["text"]), F.lit(0))).alias("n")).agg(F.sum("n")).first()[0] or 0
    blocks = 1 + n_bytes // BLOCK_BYTES
    block = F.pmod(F.xxhash64(*keys, parts), F.lit(blocks))
    rows = df.withColumn("_block", block).repartition(blocks, "_block").withColumn("_own", F.array_distinct(own))
    words = rows.select(F.col("_block").alias("_of"), F.explode("_own").alias("surface")).distinct()  # where the rows of a block are
    mine = words.join(entries.hint("merge"), "surface").select("_of", "surface", value)

    def look_up(rows: pa.Table, known: pa.Table) -> pa.Table:
        words = rows.column("_own").combine_chunks()
        flat = words.flatten()
        place = pc.index_in(flat, value_set=known.column("surface").combine_chunks())
        found = place.is_valid()
        owner = pc.list_parent_indices(words).filter(found).to_numpy()
        offsets = np.append(0, np.cumsum(np.bincount(owner, minlength=len(words)))).astype("int32")
        maps = pa.MapArray.from_arrays(pa.array(offsets), flat.filter(found), known.column(value).combine_chunks().take(place.filter(found)))
        return rows.drop_columns(["_block", "_own"]).append_column("_words", maps)

    schema = T.StructType([*df.schema, T.StructField("_words", T.MapType(T.StringType(), entries.schema[value].dataType))])
    found = rows.groupBy("_block").cogroup(mine.groupBy("_of")).applyInArrow(look_up, schema)
    return found.withColumns({"_row": F.lit(None).cast("string"), "_words": F.when(F.size("_words") > 0, F.col("_words"))})


def fit_tags(df: DataFrame, lexicon: DataFrame, parts: str, keys: list[str], small_rows: int = SMALL_ROWS) -> TagModel:
    """The model of tag pairs of the sentences ``parts``, for a `ContextLexicon`. ``df`` should be stored, its rows told apart by ``keys``.

    Only counts of pairs of tags come to the driver. Without sentences, all pairs cost the same.
    """
    names = tags.tags_of(lexicon)
    found = _with_word_map(df, tags.surface_options(lexicon, names), parts, keys, small_rows)
    sentences = found.select("_words", F.explode(parts).alias("_part")).select(_options(F.col("_part.text")).alias("_options"))
    return tags.tag_model([(r["before"], r["after"], r["n"]) for r in tags.tag_pairs(sentences, "_options").collect()], names)


def lemmatise_by_join(df: DataFrame, lexicon: DataFrame | ContextLexicon, keys: list[str], exempt: tuple[str, ...] = (),
                      small_rows: int = SMALL_ROWS) -> DataFrame:
    """Lemmas of a table of sentences ``(keys, text)``, from a dictionary table ``(surface, pos, lemma)`` of any size."""
    one = df.withColumn("_parts", F.array(F.struct(F.lit(0).alias("sentence_idx"), "text"))).drop("text")
    return with_lemmas(one, lexicon, "_parts", keys, exempt, small_rows=small_rows).withColumn("text", F.col("_parts")[0]["text"]).drop("_parts").select(*df.columns)


def length_report(df: DataFrame, profile: LanguageProfile) -> DataFrame:
    """Counts of short, long, kept and all sentences, for a table of sentences before the length rule."""
    sized = df.select(t.length_class(t.word_count(F.col("text")), profile.lower_limit, profile.upper_limit).alias("size"))
    return sized.agg(
        F.count_if(F.col("size") == "small").alias("n_small"),
        F.count_if(F.col("size") == "large").alias("n_large"),
        F.count_if(F.col("size") == "medium").alias("n_kept"),
        F.count(F.lit(1)).alias("n_total"))


def mandatory_report(df: DataFrame, profile: LanguageProfile) -> DataFrame:
    """Percentage of sentences without a mandatory term or with a blacklisted one, to 1 decimal."""
    flagged = df.select(reject_reason(F.col("text"), profile).isNotNull().alias("gone"))
    return flagged.agg(F.round(100 * F.count_if("gone") / F.count(F.lit(1)), 1).alias("removed_pct"))


def vocabulary_report(stages: DataFrame) -> DataFrame:
    """Distinct words per stage, for a long table ``(stage, text)``."""
    words = stages.select("stage", F.explode(t.tokens(F.col("text"))).alias("word"))
    return words.groupBy("stage").agg(F.count_distinct("word").alias("n_words"))
