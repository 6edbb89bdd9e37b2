"""The registered queries: what each runs on Spark, over the whole test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recado.functions import text as t
from recado.functions.stem import stem
from recado.operators import abbreviations as ab
from recado.operators import comments as c
from recado.operators import labels as lb
from recado.operators import modes as m
from recado.operators import naming
from recado.operators import sentences as s
from recado.operators import vectors as v
from recado.operators.skew import broadcast_if_small
from recado.operators.tags import ContextLexicon
from recado.operators.upsert import upsert_results
from recado.plans import classify as cl
from recado.plans import clean as pc
from recado.plans import report, train
from recado.profiles import PT_TAXONOMY
from recado.session import scratch_dir
from recado.sources import files, interactions, lexicon, lookup, models, store
from recado.sources.staging import staged
from recado.streaming import counts, ingest
from suite import adapters as a
from suite.profile import TAXONOMY, TEST

Query = Callable[[SparkSession, str], DataFrame]
ONE_START = (42,)  # what is compared does not hang on the best of several starts
QUERIES: dict[str, Query] = {}

REPLAY_START, REPLAY_END = "2024-01-05", "2024-01-26"
WEEK = 7
SINCE = "2024-01-08"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd").alias(column)


def text_query(name: str, fn: Callable[[Column], Column]) -> None:
    """A per-text step over all comment texts."""
    QUERIES[name] = lambda spark, sf: a.texts(spark, sf).select("comment_id", fn(F.col("text")).alias("result"))


# -- sources and sinks ---------------------------------------------------------------------------

def _interactions(spark: SparkSession, sf: str) -> DataFrame:
    return a.table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("string").alias("created_at"),
        F.to_json(F.struct(
            F.when(F.col("user_id") % 13 != 0, F.concat(F.lit("User_"), F.col("user_id").cast("string"))).alias("user_name"),
            F.concat("event_type", F.lit("_user")).alias("key"))).alias("social_media"),
        F.concat(F.lit("https://social.example/e/"), F.col("event_id").cast("string")).alias("url"),
        F.col("props").alias("text"))


@query
def extract_events(spark: SparkSession, sf: str) -> DataFrame:
    found = interactions.extract_comments(_interactions(spark, sf), "click_user", "user_8", SINCE, id_column="event_id")
    return found.select("comment_id", day("interaction_date"), "user_name", "url", "text")


@query
def extract_landed(spark: SparkSession, sf: str) -> DataFrame:
    """The same from a landing table that two deliveries wrote, the first of them twice."""
    path, raw = scratch_dir(spark, "landing"), _interactions(spark, sf)
    for batch in (0, 1, 0):
        interactions.land_interactions(raw.where(F.col("event_id") % 2 == batch), path, f"b{batch}")
    found = interactions.extract_landed(spark, path, "click_user", "user_8", SINCE, id_column="event_id")
    return found.select("comment_id", day("interaction_date"), "user_name", "url", "text")


def _csv_roundtrip(dialect: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        path = scratch_dir(spark, f"csv-{dialect}")
        files.write_comments(a.comments(spark, sf).select(*_COMMENT_COLUMNS), path, dialect)
        return files.read_comments(spark, path, dialect)
    return run


_COMMENT_COLUMNS = ("comment_id", "interaction_date", "user_name", "url", "content_type", "text")
for _dialect in files.DIALECTS:
    QUERIES[f"csv_roundtrip_{_dialect}"] = _csv_roundtrip(_dialect)


def _csv_read(dialect: str) -> Query:
    """Cleaned sentences of files without id and content type, their columns in another order."""
    def run(spark: SparkSession, sf: str) -> DataFrame:
        path = scratch_dir(spark, f"csv-read-{dialect}")
        files.write_comments(a.comments(spark, sf).select("text", "url", "user_name", "interaction_date"), path, dialect)
        tagged = pc.clean_tagged(files.read_comments(spark, path, dialect), TEST, network="instagram")
        return tagged.select(day("interaction_date"), "user_name", "url", F.sha2("original_text", 256).alias("text_digest"),
                             F.coalesce(F.col("sentence_idx"), F.lit(-1)).cast("bigint").alias("sentence_idx"), "reject_reason", "text")
    return run


for _dialect in files.DIALECTS:
    QUERIES[f"csv_read_{_dialect}"] = _csv_read(_dialect)


@query
def lookup_json_read(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "lookup-json")
    lookup.write_lookup_json(a.event_lookup(a.event_sentences(spark, sf)), path)
    return lookup.read_lookup_json(spark, path)


@query
def lookup_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "lookup")
    lookup.write_lookup(a.event_lookup(a.event_sentences(spark, sf)), path)
    return lookup.read_lookup(spark, path).select("subclusters_id", "cluster", "problema", "size")


@query
def latest_model(spark: SparkSession, sf: str) -> DataFrame:
    registry = a.table(spark, sf, "orders").select(
        F.concat(F.lit("comments-"), F.lower("o_orderpriority")).alias("name"), F.col("o_orderdate").alias("created_at"),
        F.concat(F.lit("models/"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("path"))
    return models.latest_model(registry, "urgent").select("path", day("created_at"))


def _results(spark: SparkSession, sf: str) -> DataFrame:
    rows = a.event_sentences(spark, sf)
    rows = lb.add_sentiment(lb.join_lookup(rows, a.event_lookup(rows)), TAXONOMY)
    return lb.finish_results(rows.withColumn("problema_30d", F.col("problema")))


def _show(results: DataFrame) -> DataFrame:
    return results.select(*[day(x) if x == "interaction_date" else x for x in files.RESULT_COLUMNS])


@query
def results_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "results-csv")
    files.write_results(_results(spark, sf), path, "csv")
    return _show(files.read_results(spark, path, "csv"))


@query
def upsert_results_query(spark: SparkSession, sf: str) -> DataFrame:
    """Results of all events under those of the later ones, which name another order number."""
    stored = _results(spark, sf)
    new = stored.where(F.col("interaction_date") >= F.lit("2024-01-20").cast("date")).withColumn("order_number", F.lit("12345678"))
    return _show(upsert_results(stored, new))


QUERIES["upsert_results"] = QUERIES.pop("upsert_results_query")


# -- comments ------------------------------------------------------------------------------------

@query
def drop_null_text(spark: SparkSession, sf: str) -> DataFrame:
    return c.drop_null_text(a.comments(spark, sf)).select("comment_id", "text")


@query
def dedupe_comments(spark: SparkSession, sf: str) -> DataFrame:
    return c.dedupe_comments(c.drop_null_text(a.comments(spark, sf))).select(*_COMMENT_COLUMNS)


@query
def duplicate_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return c.duplicate_ratio(c.drop_null_text(a.comments(spark, sf)))


@query
def canonical_url_path(spark: SparkSession, sf: str) -> DataFrame:
    return a.table(spark, sf, "pages").select("page_id", t.post_url_from_path(F.col("url")).alias("post_url"))


@query
def canonical_url_query(spark: SparkSession, sf: str) -> DataFrame:
    return a.table(spark, sf, "pages").select("page_id", t.post_url_from_query(F.col("url")).alias("post_url"))


@query
def publish_date(spark: SparkSession, sf: str) -> DataFrame:
    posts = c.parse_dates(a.comments(spark, sf)).select(
        "comment_id", "interaction_date", c.post_url(F.col("url"), "instagram").alias("url"))
    return c.publish_date(posts).select("comment_id", "url", day("interaction_date"), day("publish_date"))


@query
def filter_mentions(spark: SparkSession, sf: str) -> DataFrame:
    return c.filter_mentions(c.drop_null_text(a.comments(spark, sf)), TEST.brand).select("comment_id", "text")


@query
def filter_names(spark: SparkSession, sf: str) -> DataFrame:
    return c.filter_names(c.drop_null_text(a.comments(spark, sf)), TEST.brand).select("comment_id", "text")


# -- text ----------------------------------------------------------------------------------------

text_query("norm_lower", t.lower)
text_query("strip_handles", t.strip_handles)
text_query("strip_brand", lambda x: t.strip_brand(t.lower(x), TEST.brand))
text_query("norm_punct", t.normalise_marks)
text_query("remove_stopwords", lambda x: t.remove_stop_words(t.lower(x), TEST.all_stop_words()))
text_query("norm_residue", t.strip_residue)
text_query("letters_only", t.letters_only)
text_query("word_count", lambda x: t.word_count(x).cast("bigint"))
text_query("length_class", lambda x: t.length_class(t.word_count(x), TEST.lower_limit, TEST.upper_limit))
text_query("strip_accents", t.strip_accents)
text_query("synonyms", lambda x: t.replace_synonyms(t.lower(x), TEST.synonyms))
text_query("useless_terms", lambda x: t.remove_useless(t.lower(x), TEST.useless))
text_query("order_number", t.order_number)
text_query("tokenize", lambda x: F.array_join(t.tokens(x), "|"))
text_query("bigrams", lambda x: F.array_join(t.bigrams(x), "|"))


@query
def explode_sentences(spark: SparkSession, sf: str) -> DataFrame:
    split = t.sentences(s.comment_text(F.col("text"), TEST.brand))
    return (a.texts(spark, sf).select("comment_id", F.posexplode(split).alias("sentence_idx", "text"))
            .withColumn("sentence_idx", F.col("sentence_idx").cast("bigint")))


@query
def learn_abbreviations(spark: SparkSession, sf: str) -> DataFrame:
    """Words that ever carry a stop, with what speaks for their being abbreviations."""
    scores = ab.abbreviation_scores(ab.stop_counts(a.table(spark, sf, "documents")))
    return scores.select("word", "n_stop", "n_plain", F.round("score", 4).alias("score"), (F.col("score") >= ab.LEAST_SCORE).alias("is_abbreviation"))


@query
def stopword_list(spark: SparkSession, sf: str) -> DataFrame:
    """How often each word of the assembled stop list occurs."""
    words = F.split(F.regexp_replace(F.lower("text"), t.NON_WORD, " "), " ")
    return (a.texts(spark, sf).select(F.explode(words).alias("word"))
            .where(F.col("word").isin(TEST.all_stop_words()))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def _sentences(spark: SparkSession, sf: str) -> DataFrame:
    """All sentences up to the length rule, before it."""
    parts = s.front(F.col("text"), TEST, keep_length_rejects=True)
    return a.texts(spark, sf).select("comment_id", F.inline(parts))


@query
def length_filter(spark: SparkSession, sf: str) -> DataFrame:
    return (a.texts(spark, sf).select("comment_id", F.inline(s.front(F.col("text"), TEST)))
            .withColumn("sentence_idx", F.col("sentence_idx").cast("bigint")))


@query
def length_report(spark: SparkSession, sf: str) -> DataFrame:
    return s.length_report(_sentences(spark, sf), TEST)


@query
def lemmatize_lexicon(spark: SparkSession, sf: str) -> DataFrame:
    """Lemmas by a joined dictionary."""
    done = s.lemmatise_by_join(_sentences(spark, sf), s.lexicon_table(spark, TEST), ["comment_id", "sentence_idx"], TEST.lemma_exempt)
    return done.select("comment_id", F.col("sentence_idx").cast("bigint").alias("sentence_idx"), "text")


def _open_lexicon(sentences: DataFrame) -> DataFrame:
    """A dictionary of all words of the sentences, most of which can be several parts of speech: by their length."""
    words = sentences.select(F.explode(F.split("text", " ")).alias("surface")).where("surface <> ''").distinct()
    kinds = F.transform(F.lit(list(a.OPEN_KINDS)), lambda k: F.split(k, ":"))
    entries = words.select("surface", F.explode(kinds).alias("k")).where(F.col("k")[0].cast("int") == F.length("surface") % 7)
    return entries.select("surface", F.col("k")[1].alias("pos"), F.concat("surface", F.col("k")[2]).alias("lemma"))


def _medium(spark: SparkSession, sf: str) -> DataFrame:
    return a.texts(spark, sf).select("comment_id", F.inline(s.front(F.col("text"), TEST)))


@query
def lexicon_conllu(spark: SparkSession, sf: str) -> DataFrame:
    """Dictionary entries read back from the words of all texts, written as a tagged corpus; those seen five times or more."""
    path = scratch_dir(spark, "conllu")
    words = a.texts(spark, sf).select(F.explode(F.split("text", " ")).alias("w")).where(F.col("w").rlike("^[a-z]+$"))
    pos = F.when(F.length("w") % 2 == 0, "NOUN").when(F.length("w") % 3 == 0, "_").otherwise("VERB")
    rest = [F.lit("_")] * 6
    words.select(F.concat_ws("\t", F.length("w").cast("string"), "w", F.concat("w", F.lit("ar")), pos, *rest)).write.text(path)
    return lexicon.read_conllu(spark, path, least=5)


@query
def lemmatize_context(spark: SparkSession, sf: str) -> DataFrame:
    """Lemmas chosen by their neighbours: the cheapest path of tags, under a model learnt from the same sentences."""
    sentences = staged(_medium(spark, sf), "medium-sentences")
    entries = staged(_open_lexicon(sentences), "open-lexicon")
    keys = ["comment_id", "sentence_idx"]
    parts = sentences.select(*keys, F.array(F.struct("sentence_idx", "text")).alias("_parts"))
    context = ContextLexicon(entries, s.fit_tags(parts, entries, "_parts", keys))
    done = s.lemmatise_by_join(sentences, context, keys, TEST.lemma_exempt)
    return done.select("comment_id", F.col("sentence_idx").cast("bigint").alias("sentence_idx"), "text")


def _with_synonyms(spark: SparkSession, sf: str, wanted: Callable[[Column], Column] | None = None) -> DataFrame:
    """Sentences after the synonyms; a test on them is put to the array, as a filter would repeat the text work."""
    parts = F.transform(s.front(F.col("text"), TEST, keep_length_rejects=True), lambda x: F.struct(
        x["sentence_idx"].cast("bigint").alias("sentence_idx"), s.unaccented(x["text"], TEST).alias("text")))
    if wanted:
        parts = F.filter(parts, lambda x: wanted(x["text"]))
    return a.texts(spark, sf).select("comment_id", F.inline(parts))


@query
def mandatory_filter(spark: SparkSession, sf: str) -> DataFrame:
    return _with_synonyms(spark, sf, lambda x: t.has_any(x, TEST.mandatory))


@query
def blacklist_filter(spark: SparkSession, sf: str) -> DataFrame:
    return _with_synonyms(spark, sf, lambda x: ~t.has_any(x, TEST.blacklist))


@query
def mandatory_report(spark: SparkSession, sf: str) -> DataFrame:
    return s.mandatory_report(_with_synonyms(spark, sf), TEST)


@query
def stem_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    """Each distinct word of the comments and its stem."""
    words = t.tokens(t.strip_accents(t.letters_only(t.lower(F.col("text")))))
    vocabulary = a.texts(spark, sf).select(F.explode(words).alias("word")).distinct()
    return vocabulary.select("word", stem(F.col("word"), TEST.stem_rules).alias("stem"))


@query
def drop_blank(spark: SparkSession, sf: str) -> DataFrame:
    """Texts that only hold useless terms and spaces go."""
    cleaned = t.collapse_spaces(t.remove_useless(F.col("text"), TEST.useless))
    return (_sentences(spark, sf).select("comment_id", F.col("sentence_idx").cast("bigint").alias("sentence_idx"), cleaned.alias("text"))
            .where(~t.is_blank(F.col("text"))))


@query
def vocab_report(spark: SparkSession, sf: str) -> DataFrame:
    return report.vocabulary_by_stage(a.comments(spark, sf), TEST)


# -- composed cleaning ---------------------------------------------------------------------------

def _tagged(spark: SparkSession, sf: str, with_texts: bool = False) -> DataFrame:
    return pc.clean_tagged(a.comments(spark, sf, dealt=False), TEST, network="instagram", with_texts=with_texts)


def _show_sentences(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(
        "comment_id", day("interaction_date"), "user_name", "url", "content_type", day("publish_date"), "original_text",
        F.coalesce(F.col("sentence_idx"), F.lit(-1)).cast("bigint").alias("sentence_idx"), *columns, "text")


@query
def clean_kept(spark: SparkSession, sf: str) -> DataFrame:
    return _show_sentences(pc.kept(_tagged(spark, sf, with_texts=True)))


def _repeated(spark: SparkSession, sf: str) -> DataFrame:
    """Every comment twice: the copies are equal, or have another id, or no id and a later date."""
    comments, i = a.comments(spark, sf, dealt=False), F.col("comment_id")
    later = F.date_format(F.date_add(F.col("interaction_date").cast("date"), 1), "yyyy-MM-dd")
    copies = comments.withColumn("interaction_date", F.when(i % 3 == 2, later).otherwise(F.col("interaction_date"))).withColumn(
        "comment_id", F.when(i % 3 == 0, i).when(i % 3 == 1, i + 2 * a.NO_TEXT_IDS))
    return comments.unionByName(copies)


@query
def clean_repeated(spark: SparkSession, sf: str) -> DataFrame:
    return _show_sentences(pc.kept(pc.clean_tagged(_repeated(spark, sf), TEST, network="instagram")))


@query
def clean_lexicon(spark: SparkSession, sf: str) -> DataFrame:
    """The composed cleaner with its lemmas from a dictionary table."""
    return _show_sentences(pc.kept(pc.clean_tagged(a.comments(spark, sf, dealt=False), TEST, network="instagram", lexicon=s.lexicon_table(spark, TEST))))


@query
def bad_dates(spark: SparkSession, sf: str) -> DataFrame:
    """A tolerant run: comments whose date cannot be read are left out of the sentences, and listed with their date."""
    comments = _with_bad_dates(spark, sf)
    kept = pc.clean_tagged(comments, TEST, network="instagram", strict_dates=False, with_texts=False).groupBy("comment_id").agg(F.count(F.lit(1)).alias("n"))
    return kept.select("comment_id", "n", F.lit(None).cast("string").alias("bad_date")).unionByName(
        c.bad_dates(c.drop_null_text(comments)).select("comment_id", F.lit(0).cast("bigint").alias("n"), F.col("interaction_date").alias("bad_date")))


def _with_bad_dates(spark: SparkSession, sf: str) -> DataFrame:
    return a.comments(spark, sf).withColumn("interaction_date", F.when(F.col("comment_id") % 11 == 5, "31/13/2024").otherwise(F.col("interaction_date")))


@query
def clean_removed(spark: SparkSession, sf: str) -> DataFrame:
    return _show_sentences(pc.removed(_tagged(spark, sf, with_texts=True)), "reject_reason")


@query
def clean_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The counts of one cleaning run, taken while it writes its sentences, and how many rows it wrote."""
    path = scratch_dir(spark, "cleaned")
    found = report.clean_and_count(a.comments(spark, sf), TEST, path, network="instagram")
    written = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_written"))
    return written.select("n_written", *[F.lit(found[x]).cast("double" if x.endswith("pct") else "long").alias(x) for x in sorted(found)])


@query
def rejected_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rejected rows per reason, and what is left."""
    return report.clean_report(_tagged(spark, sf))


@query
def clean_trace(spark: SparkSession, sf: str) -> DataFrame:
    trace = pc.clean_trace(a.comments(spark, sf), TEST)
    return trace.select("comment_id", F.coalesce(F.col("sentence_idx"), F.lit(-1)).cast("bigint").alias("sentence_idx"), "stage", "text")


# -- vectors and clusters ------------------------------------------------------------------------

def _joined(column: str, decimals: int = 6) -> Column:
    """An array of doubles as text, so that results compare as plain values."""
    return F.array_join(F.transform(column, lambda x: F.format_number(F.round(x, decimals) + 0.0, decimals)), "|").alias(column)


def _kept_sentences(spark: SparkSession, sf: str) -> DataFrame:
    return train.staged(pc.kept(_tagged(spark, sf)).select("comment_id", "sentence_idx", "text"), "sentences")


@query
def vocab_min_count(spark: SparkSession, sf: str) -> DataFrame:
    return v.vocabulary(v.tokenize(a.texts(spark, sf)), 10)


@query
def word2vec_fit(spark: SparkSession, sf: str) -> DataFrame:
    """The words that get a vector, and its length."""
    fitted = v.fit_words(train.staged(v.tokenize(_sentences(spark, sf)).select("tokens"), "tokens"))
    return v.word_table(fitted).select("word", F.size("vector").alias("n_dimensions"))


@query
def sentence_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Each sentence's known words, and how far its vector is from their mean, worked out word by word."""
    keys = ["comment_id", "sentence_idx"]
    tokenized = train.staged(v.tokenize(_sentences(spark, sf)).select(*keys, "tokens"), "tokens")
    fitted = v.fit_words(tokenized)
    means = train.staged(_word_means(tokenized, v.word_table(fitted)), "word-means")
    found = v.sentence_vectors(means, fitted).withColumn("features", v.vector_to_array("features"))
    mean = F.coalesce("mean", F.transform("features", lambda _: F.lit(0.0)))
    gap = F.array_max(F.zip_with("features", mean, lambda x, y: F.abs(x - y)))
    return found.select("comment_id", F.col("sentence_idx").cast("bigint").alias("sentence_idx"), "n_known", (gap < 1e-6).alias("is_mean"))


BLOCK_SENTENCES, BLOCK_WORDS = 20_000, 20_000


def _word_means(tokenized: DataFrame, vectors: DataFrame) -> DataFrame:
    """Sentences with ``n_known`` and ``mean``, of the words of all rows with their id and place; NULL without known words or with a NULL key.

    Sentences are dealt into blocks, and each block gets the vectors of its distinct words once, so no vector goes with every single word.
    """
    keys = ["comment_id", "sentence_idx"]
    blocks = 1 + tokenized.count() // BLOCK_SENTENCES
    kinds = tokenized.select(*keys).schema
    as_text = [F.col(k).cast("string").alias(k) for k in keys]  # pandas has no NULL among whole numbers
    dealt = tokenized.select(F.pmod(F.xxhash64(*keys), F.lit(blocks)).alias("block"), *as_text, "tokens")
    words = dealt.select(F.col("block").alias("of_block"), F.explode("tokens").alias("word")).distinct().join(vectors.hint("merge"), "word")

    def means(sentences: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        group = sentences.groupby(keys).ngroup().fillna(-1).to_numpy(dtype="int64")  # -1 where a key is NULL
        n_groups = int(group.max(initial=-1)) + 1
        tokens = [() if x is None else x for x in sentences["tokens"]]
        owner = np.repeat(group, [len(x) for x in tokens])
        place = pd.Index(known["word"], dtype="object").get_indexer(pd.Index([w for x in tokens for w in x], dtype="object"))
        owner, place = owner[(owner >= 0) & (place >= 0)], place[(owner >= 0) & (place >= 0)]
        n = np.bincount(owner, minlength=n_groups)
        if len(place):
            matrix = np.vstack(known["vector"].to_list()).astype("float64")
            sums = np.zeros((n_groups, matrix.shape[1]))
            for at in range(0, len(place), BLOCK_WORDS):
                np.add.at(sums, owner[at:at + BLOCK_WORDS], matrix[place[at:at + BLOCK_WORDS]])
        n_known = [int(n[g]) if g >= 0 else 0 for g in group]
        return sentences[[*keys, "tokens"]].assign(
            n_known=n_known, mean=[sums[g] / k if k else None for g, k in zip(group, n_known, strict=True)])

    schema = ", ".join([*[f"{k} string" for k in keys], "tokens array<string>, n_known long, mean array<double>"])
    found = dealt.groupBy("block").cogroup(words.groupBy("of_block")).applyInPandas(means, schema)
    return found.withColumns({k: F.col(k).cast(kinds[k].dataType) for k in keys})


@query
def mean_vector(spark: SparkSession, sf: str) -> DataFrame:
    means = v.mean_vector(a.table(spark, sf, "embeddings"), "label", "embedding")
    return means.select("label", F.posexplode("center").alias("i", "value")).select(
        "label", F.col("i").cast("bigint").alias("i"), F.round("value", 6).alias("value"))


@query
def kmeans_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Each point, and whether it was put to the nearest of the fitted centres."""
    points = a.spread(a.table(spark, sf, "embeddings")).select("vec_id", "embedding", v.array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    model = v.fit_kmeans(points, seeds=(1, 2))
    centres = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "subclusters_id int, center array<double>")
    put = model.transform(points).withColumnRenamed("subclusters_id", "put").join(centres.withColumnRenamed("subclusters_id", "put"), "put")
    far = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, d: s + d)
    nearest = v.assign_clusters(put, centres, "embedding").join(centres.withColumnRenamed("center", "near"), "subclusters_id")
    return nearest.select("vec_id", (far(F.col("embedding"), F.col("center")) <= far(F.col("embedding"), F.col("near")) + 1e-5).alias("at_nearest"))


@query
def assign_cluster(spark: SparkSession, sf: str) -> DataFrame:
    points = a.table(spark, sf, "embeddings")
    centers = v.mean_vector(points, "label", "embedding").select(
        F.col("label").alias("subclusters_id"), F.transform("center", lambda x: F.round(x, 4)).alias("center"))
    return v.assign_clusters(points, centers, "embedding").select("vec_id", "subclusters_id")


@query
def train_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """What a training of full size has in its look-up: every kept sentence, in at most 140 clusters."""
    lookup_ = train.train_on_sentences(_kept_sentences(spark, sf), TAXONOMY, seeds=ONE_START).lookup
    return lookup_.agg(F.sum("size").alias("n_sentences"), (F.count_distinct("subclusters_id") <= v.N_CLUSTERS).alias("within_k"),
                       (F.count_distinct("subclusters_id") == F.count(F.lit(1))).alias("one_row_each"))


@query
def model_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences, and how many of them a saved and loaded model puts elsewhere."""
    sentences = _kept_sentences(spark, sf)
    model = train.train_on_sentences(sentences, TAXONOMY, seeds=ONE_START).model
    path = scratch_dir(spark, "model")
    models.save_model(model, path)
    keys = ["comment_id", "sentence_idx"]
    before = train.predict(model, sentences).select(*keys, F.col("subclusters_id").alias("was"))
    after = train.predict(models.load_model(spark, path), sentences).select(*keys, "subclusters_id")
    return before.join(after, keys).agg(F.count(F.lit(1)).alias("n_sentences"), F.count_if(F.col("was") != F.col("subclusters_id")).alias("n_changed"))


@query
def registry_classify(spark: SparkSession, sf: str) -> DataFrame:
    """Train, register beside an older entry, load the newest with its look-up, classify: the columns that do not hang on the model."""
    training = train.train_on_sentences(_kept_sentences(spark, sf), TAXONOMY, seeds=ONE_START)
    root = scratch_dir(spark, "registry")
    older = training.lookup.withColumn("cluster", F.lit("old"))
    models.register(training.model, older, root, "comments-old", TEST, TAXONOMY, dt.datetime(2020, 1, 1))
    models.register(training.model, training.lookup, root, "comments-new", TEST, TAXONOMY)
    model, lookup = models.load_newest(spark, root, "comments", TEST, TAXONOMY)
    results = cl.classify(a.comments(spark, sf), TEST, TAXONOMY, lookup, cl.by_model(model), network="instagram")
    return results.where(~F.col("cluster").eqNullSafe("old")).select("original_text", "order_number")


@query
def cluster_size(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes counted in the sentences, attached to the look-up by id."""
    sentences = a.event_sentences(spark, sf)
    named = a.event_lookup(sentences).select("subclusters_id", "cluster", "problema")
    return v.attach_size(named, v.cluster_size(sentences))


# -- naming --------------------------------------------------------------------------------------

def _clustered(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences with their document's source number as cluster id."""
    docs = a.spread(a.table(spark, sf, "documents").select("source", "text"))
    return docs.select(F.substring("source", 4, 9).cast("int").alias("subclusters_id"), F.inline(s.front(F.col("text"), TEST)))


def _top(spark: SparkSession, sf: str) -> DataFrame:
    return naming.top_bigrams(naming.bigram_counts(_clustered(spark, sf)))


@query
def bigram_counts(spark: SparkSession, sf: str) -> DataFrame:
    return naming.bigram_counts(_clustered(spark, sf))


@query
def top_bigrams(spark: SparkSession, sf: str) -> DataFrame:
    return _top(spark, sf).select("subclusters_id", "bigram", "n", F.col("rnk").cast("bigint").alias("rnk"))


@query
def cluster_name(spark: SparkSession, sf: str) -> DataFrame:
    return naming.cluster_names(_top(spark, sf), naming.term_table(spark, TAXONOMY))


@query
def cluster_problem(spark: SparkSession, sf: str) -> DataFrame:
    names = naming.cluster_names(_top(spark, sf), naming.term_table(spark, TAXONOMY))
    return naming.cluster_problems(names, naming.problem_table(spark, TAXONOMY))


def _label_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Each taxonomy term with its number of sentences, so that audits say how much they concern."""
    pairs = _clustered(spark, sf).select(F.explode(t.bigrams(F.col("text"))).alias("term"))
    counts = pairs.join(broadcast_if_small(naming.term_table(spark, TAXONOMY)), "term").groupBy("label", "term").agg(F.count(F.lit(1)).alias("n"))
    return naming.term_table(spark, TAXONOMY).join(counts, ["label", "term"], "left")


@query
def audit_labels_no_problem(spark: SparkSession, sf: str) -> DataFrame:
    terms = _label_counts(spark, sf)
    missing = naming.labels_without_problem(terms, naming.problem_table(spark, TAXONOMY))
    return (terms.join(missing, "label", "left_semi").groupBy("label")
            .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_bigrams")))


@query
def audit_duplicate_terms(spark: SparkSession, sf: str) -> DataFrame:
    terms = _label_counts(spark, sf)
    return (naming.duplicate_terms(terms).join(terms.groupBy("term").agg(F.max("n").alias("n_bigrams")), "term")
            .select("term", "n", F.coalesce("n_bigrams", F.lit(0)).alias("n_bigrams")))


@query
def audit_unnamed_clusters(spark: SparkSession, sf: str) -> DataFrame:
    top = _top(spark, sf)
    unnamed = naming.unnamed_clusters(top, naming.cluster_names(top, naming.term_table(spark, TAXONOMY)))
    return unnamed.withColumn("rnk", F.col("rnk").cast("bigint"))


@query
def cluster_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """From stored sentences, as in training: sizes and names both read them."""
    return naming.build_lookup(train.staged(_clustered(spark, sf), "clustered"), TAXONOMY)


def _portuguese(spark: SparkSession, sf: str) -> DataFrame:
    """Events as sentences of two stemmed terms of the shipped taxonomy, a cluster for each type and remainder."""
    terms = F.array(*[F.lit(x) for _, _, x in PT_TAXONOMY.label_terms()])
    term = lambda i: F.element_at(terms, (F.pmod(i, F.size(terms)) + 1).cast("int"))
    i = F.col("event_id")
    rows = a.table(spark, sf, "events").select(
        F.pmod(i, F.lit(140)).cast("int").alias("subclusters_id"), term(F.pmod(i, F.lit(140)) * 3).alias("one"), term(F.floor(i / 3)).alias("two"))
    return rows.select("subclusters_id", F.concat_ws(" ", "one", "two").alias("text"))


@query
def cluster_lookup_pt(spark: SparkSession, sf: str) -> DataFrame:
    """Clusters named with the shipped Portuguese terms. The sentences are made of the terms themselves, a pair for each event, as the
    tables hold no Portuguese: this proves the look-up, not the naming of real text."""
    return naming.build_lookup(train.staged(_portuguese(spark, sf), "portuguese"), PT_TAXONOMY)


# -- labelling -----------------------------------------------------------------------------------

def _labelled(spark: SparkSession, sf: str, teams: bool = False) -> DataFrame:
    rows = a.event_sentences(spark, sf, teams)
    return lb.join_lookup(rows, a.event_lookup(rows))


def _felt(spark: SparkSession, sf: str, teams: bool = False) -> DataFrame:
    return lb.add_sentiment(_labelled(spark, sf, teams), TAXONOMY)


@query
def join_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return _labelled(spark, sf).select("comment_id", "subclusters_id", "cluster", "problema", "size")


@query
def append_rejected(spark: SparkSession, sf: str) -> DataFrame:
    turns = a.table(spark, sf, "conversations").select(
        F.col("conv_id").alias("comment_id"), F.col("turn").cast("int").alias("sentence_idx"),
        F.col("role").alias("user_name"), F.col("text").alias("original_text"))
    both = lb.append_rejected(_labelled(spark, sf).select(
        "comment_id", "sentence_idx", "user_name", "original_text", "cluster", "problema"), turns)
    return both.withColumn("sentence_idx", F.col("sentence_idx").cast("bigint"))


@query
def sentiment(spark: SparkSession, sf: str) -> DataFrame:
    return _felt(spark, sf).select("comment_id", "cluster", "sentimento")


@query
def comment_label_mode(spark: SparkSession, sf: str) -> DataFrame:
    rows = _felt(spark, sf, teams=True)
    modes = lb.comment_label_mode(rows)
    texts = rows.groupBy(t.text_key(F.col("original_text")).alias("text_key")).agg(F.first("original_text").alias("original_text"))
    return modes.join(texts, "text_key").select("user_name", "original_text", "sentimento", "cluster_mode", "n_rows")


@query
def apply_label_mode(spark: SparkSession, sf: str) -> DataFrame:
    rows = _felt(spark, sf, teams=True)
    return lb.apply_label_mode(rows, lb.comment_label_mode(rows)).select("comment_id", "sentimento", "cluster", "problema")


@query
def one_row_per_comment(spark: SparkSession, sf: str) -> DataFrame:
    rows = lb.one_row_per_comment(_felt(spark, sf), TAXONOMY)
    return rows.select("comment_id", "original_text", "sentimento", "size")


@query
def label_comments(spark: SparkSession, sf: str) -> DataFrame:
    rows = lb.label_comments(_labelled(spark, sf, teams=True), TAXONOMY)
    return rows.select("comment_id", "user_name", "original_text", "cluster", "sentimento", "problema", "size")


@query
def null_sentinels(spark: SparkSession, sf: str) -> DataFrame:
    return lb.null_sentinels(_felt(spark, sf), TAXONOMY).select("comment_id", "cluster", "sentimento")


def _user_mode(days: int) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        rows = lb.null_sentinels(_felt(spark, sf), TAXONOMY)
        return m.attach_user_problem(rows, m.user_problem_mode(rows, TAXONOMY, days)).select("comment_id", "user_name", "problema_30d")
    return run


QUERIES["user_problem_mode_30d"] = _user_mode(30)
QUERIES["user_problem_mode_7d"] = _user_mode(WEEK)


@query
def replay_problem_mode(spark: SparkSession, sf: str) -> DataFrame:
    rows = lb.null_sentinels(_felt(spark, sf), TAXONOMY)
    done = m.replay_problem_mode(rows, TAXONOMY, REPLAY_START, REPLAY_END, WEEK)
    return done.select("comment_id", "user_name", day("interaction_date"), "problema_30d")


@query
def date_range(spark: SparkSession, sf: str) -> DataFrame:
    """Every day of the range with its number of events."""
    events = a.table(spark, sf, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return (m.date_range(spark, "2023-12-25", "2024-02-05").join(events, "day", "left")
            .select(day("day"), F.coalesce("n", F.lit(0)).alias("n")))


@query
def result_projection(spark: SparkSession, sf: str) -> DataFrame:
    return _show(_results(spark, sf))


@query
def sorted_results(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "results-sorted")
    files.write_results(_results(spark, sf), path, "parquet", sort=True)
    return _show(files.read_results(spark, path))


def _assign(spark: SparkSession) -> cl.Assign:
    return lambda df: v.assign_clusters(df.withColumn("features", a.features()), a.centroid_table(spark))


@query
def classify_comments(spark: SparkSession, sf: str) -> DataFrame:
    """All of it, with given centroids: clean, assign, label, recent problem, finish."""
    return _show(cl.classify(a.comments(spark, sf), TEST, TAXONOMY, a.fixed_lookup(spark), _assign(spark), network="instagram"))


@query
def replay_comments(spark: SparkSession, sf: str) -> DataFrame:
    return _show(cl.replay(a.comments(spark, sf), TEST, TAXONOMY, a.fixed_lookup(spark), _assign(spark),
                           "2024-01-20", "2024-02-20", network="instagram"))


@query
def classify_repeated(spark: SparkSession, sf: str) -> DataFrame:
    """The same comments as overlapping extracts bring them: the results are those of each comment once."""
    return _show(cl.classify(_repeated(spark, sf), TEST, TAXONOMY, a.fixed_lookup(spark), _assign(spark), network="instagram"))


@query
def classify_trained(spark: SparkSession, sf: str) -> DataFrame:
    """With a model trained on the same comments: the columns that do not hang on the model."""
    training = train.train_on_sentences(_kept_sentences(spark, sf), TAXONOMY, seeds=ONE_START)
    results = cl.classify(a.comments(spark, sf), TEST, TAXONOMY, training.lookup, cl.by_model(training.model), network="instagram")
    return results.select("original_text", "order_number")


# -- streams -------------------------------------------------------------------------------------

def _deliver(spark: SparkSession, sf: str, path: str, run: int, runs: int) -> None:
    """A run's share of the comments, as files. Copies of a text come in different runs, and later dates often come first."""
    mine = F.pmod(F.col("comment_id") * 5 + F.floor(F.col("comment_id") / 7), F.lit(runs)) == run
    files.write_comments(a.comments(spark, sf, dealt=False).select(*_COMMENT_COLUMNS).where(mine).repartition(max(2, 8 // runs)), f"{path}/run={run}", "infer")


def _ingested(spark: SparkSession, sf: str, files_per_batch: int, runs: int = 1) -> DataFrame:
    arrived, root, checkpoint = (scratch_dir(spark, x) for x in ("arrived", "stream-root", "stream-checkpoint"))
    for run in range(runs):
        _deliver(spark, sf, arrived, run, runs)
        ingest.ingest_comments(ingest.arriving_comments(spark, f"{arrived}/*", files_per_batch=files_per_batch), TEST, root, checkpoint,
                               network="instagram")
    return _show_sentences(ingest.ingested_sentences(spark, root), "reject_reason")


def _stream_results(spark: SparkSession, sf: str, files_per_batch: int, runs: int = 1) -> DataFrame:
    arrived, root, path, checkpoint = (scratch_dir(spark, x) for x in ("arrived", "stream-root", "store", "store-checkpoint"))
    for run in range(runs):
        _deliver(spark, sf, arrived, run, runs)
        ingest.ingest_results(
            ingest.arriving_comments(spark, f"{arrived}/*", files_per_batch=files_per_batch), TEST,
            lambda tagged: cl.label_tagged(tagged, a.fixed_lookup(spark), _assign(spark)), TAXONOMY, root, path, checkpoint, network="instagram")
    return _show(store.read_store(spark, path))


@query
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Arriving files cleaned: all columns, publish dates included."""
    return _ingested(spark, sf, 100)


@query
def stream_ingest_in_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Three files at a time: the same sentences."""
    return _ingested(spark, sf, 3)


@query
def stream_ingest_in_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Two deliveries with a run after each: the same sentences, from the earliest copies."""
    return _ingested(spark, sf, 100, runs=2)


@query
def stream_classify(spark: SparkSession, sf: str) -> DataFrame:
    """Arriving files labelled, made into results and merged into the stored ones."""
    return _stream_results(spark, sf, 100)


@query
def stream_classify_in_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Two files at a time: the same results."""
    return _stream_results(spark, sf, 2)


@query
def stream_classify_in_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Three deliveries with a run after each: the same results, nothing stale."""
    return _stream_results(spark, sf, 100, runs=3)


@query
def stream_problem_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a stream: rolling counts of all spans, open ones included."""
    path = scratch_dir(spark, "rolling")
    schema = a.table(spark, sf, "events").schema
    arrived = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    rows = arrived.select(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_name"),
        F.date_trunc("day", F.col("ts").cast("timestamp")).alias("interaction_date"),
        F.when(F.col("event_type") != "signup", F.col("event_type")).alias("problema"))
    counts.ingest_daily_counts(rows, path, scratch_dir(spark, "rolling-checkpoint"))
    return counts.stored_rolling_counts(spark, path, WEEK).select("user_name", day("run"), "problema", "n")


@query
def stream_problem_mode(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled events in two deliveries, with a run after each: every user's most frequent problem for every day."""
    rows = lb.null_sentinels(_felt(spark, sf), TAXONOMY).select("comment_id", "sentence_idx", "user_name", "interaction_date", "problema", "sentimento")
    arrived, root, checkpoint = (scratch_dir(spark, x) for x in ("events", "modes-root", "modes-checkpoint"))
    for run in range(2):
        rows.where(F.pmod("comment_id", F.lit(2)) == run).write.parquet(f"{arrived}/run={run}")
        stream = spark.readStream.schema(rows.schema).parquet(f"{arrived}/*")
        counts.ingest_problem_modes(stream, TAXONOMY, root, checkpoint, WEEK)
    return counts.stored_problem_modes(spark, root).select("user_name", day("run"), "problema_30d", "n")
