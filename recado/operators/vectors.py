"""Word vectors, sentence vectors and clusters, on MLlib."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import StopWordsRemover, Word2Vec, Word2VecModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recado.functions import text as t
from recado.operators.skew import broadcast_if_small
from recado.sources.staging import scratch_path, staged

# Training settings.
VECTOR_SIZE = 200
WINDOW_SIZE = 7
MIN_COUNT = 10
N_CLUSTERS = 140
SEEDS = tuple(range(42, 52))  # ten starts, of which the best is kept

TASK_SENTENCES = 50_000
ROUND_BYTES = 12_000_000_000  # vectors that all tasks of a round of the fit may hand on together
BLOCK_VALUES = 4_000_000  # distances, or components, that a task holds at once


def tokenize(df: DataFrame) -> DataFrame:
    return df.withColumn("tokens", t.tokens(F.col("text")))


def vocabulary(tokenized: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """Words that occur at least ``min_count`` times: ``(word, n)``."""
    return (tokenized.select(F.explode("tokens").alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min_count))


def word2vec(vector_size: int = VECTOR_SIZE, window: int = WINDOW_SIZE, min_count: int = MIN_COUNT, seed: int = 42,
             max_iter: int = 5, partitions: int = 1) -> Word2Vec:
    """Skip-gram word vectors; as a transformer, the sum of the vectors of a sentence's known words by all its words."""
    return Word2Vec(vectorSize=vector_size, windowSize=window, minCount=min_count, maxIter=max_iter, seed=seed,
                    numPartitions=partitions, inputCol="tokens", outputCol="features")


def fit_words(tokenized: DataFrame, **options) -> Word2VecModel:
    """Fitted word vectors. Words under the least count are left out of sentences before windows are taken.

    A task fits `TASK_SENTENCES` sentences, and vectors are averaged over tasks after each round: more tasks are faster on
    large tables, and learn a little less from each round. Every task hands on the two vectors of each word that it met, so there are
    no more tasks than `ROUND_BYTES` holds models (`fit_tasks`): what a round shuffles is bounded, and tasks grow instead.
    """
    partitions = options.pop("partitions", None)
    if not partitions:
        n_words = vocabulary(tokenized, options.get("min_count", MIN_COUNT)).count()
        partitions = fit_tasks(tokenized.count(), n_words, options.get("vector_size", VECTOR_SIZE))
    return word2vec(partitions=partitions, **options).fit(tokenized)


def fit_tasks(n_sentences: int, n_words: int, vector_size: int, round_bytes: int = ROUND_BYTES) -> int:
    """Tasks of a fit: one for each `TASK_SENTENCES`, as long as their models, two vectors of floats a word, are within ``round_bytes``."""
    model_bytes = 2 * 4 * vector_size * max(n_words, 1)
    return max(1, min(1 + n_sentences // TASK_SENTENCES, round_bytes // model_bytes))


def word_table(words: Word2VecModel) -> DataFrame:
    """The model's words and vectors as a stored table ``(word, vector)``; `getVectors` would keep them in the driver and in each plan."""
    spark = SparkSession.active()
    path = scratch_path(spark, "word-vectors")
    words.write().save(path)
    return spark.read.schema("word string, vector array<float>").parquet(f"{path}/data")


def sentence_vectors(tokenized: DataFrame, words: Word2VecModel) -> DataFrame:
    """Add ``features``: the mean vector of a sentence's known words, zeros if it has none.

    The model divides by all words of a sentence; that is put right by the number of unknown ones, which a stop word
    remover with the model's own words leaves over. The words are on the driver anyway, with the model.
    """
    known = [r["word"] for r in word_table(words).select("word").collect()]
    rest = StopWordsRemover(inputCol="tokens", outputCol="_unknown", caseSensitive=True, stopWords=known)
    n_known = F.size("tokens") - F.size("_unknown")
    scale = F.when(n_known > 0, F.size("tokens") / n_known).otherwise(0.0)
    return (words.transform(rest.transform(tokenized)).withColumn("_scale", scale)
            .withColumn("features", array_to_vector(F.transform(vector_to_array("features"), lambda x: x * F.col("_scale"))))
            .drop("_unknown", "_scale"))


def fit_kmeans(vectors: DataFrame, k: int = N_CLUSTERS, seeds: Sequence[int] = SEEDS, max_iter: int = 300,
               tol: float = 1e-4) -> KMeansModel:
    """The best of one fit per seed, by training cost; of equal ones, the first. ``vectors`` should be stored or cached: fits iterate.

    Time grows with the starts; fewer ``seeds`` are for quick looks.
    """
    fits = [KMeans(k=k, initMode="k-means||", maxIter=max_iter, tol=tol, seed=seed, featuresCol="features",
                   predictionCol="subclusters_id").fit(vectors) for seed in seeds]
    return min(fits, key=lambda m: m.summary.trainingCost)


def fit_pipeline(tokenized: DataFrame, k: int = N_CLUSTERS, seeds: Sequence[int] = SEEDS, **vector_options) -> PipelineModel:
    """Word vectors, then clusters of sentence vectors, which are stored because the fits iterate. `predict` applies it."""
    words = fit_words(tokenized, **vector_options)
    vectors = staged(sentence_vectors(tokenized, words).select("features"), "sentence-vectors")
    return PipelineModel([words, fit_kmeans(vectors, k, seeds)])


def predict(pipeline: PipelineModel, tokenized: DataFrame) -> DataFrame:
    """Add ``features`` and ``subclusters_id``."""
    words, clusters = pipeline.stages
    return clusters.transform(sentence_vectors(tokenized, words))


def cluster_size(clustered: DataFrame) -> DataFrame:
    return clustered.groupBy("subclusters_id").agg(F.count(F.lit(1)).alias("size"))


def attach_size(lookup: DataFrame, sizes: DataFrame) -> DataFrame:
    """Look-up rows with their training size, by id."""
    return lookup.join(broadcast_if_small(sizes), "subclusters_id", "left")


def mean_vector(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Mean vector per key, with partial sums before the shuffle: ``(key, center)``."""
    means = df.groupBy(key).agg(Summarizer.mean(array_to_vector(F.col(vector).cast("array<double>"))).alias("m"))
    return means.select(key, vector_to_array("m").alias("center"))


def assign_clusters(df: DataFrame, centroids: DataFrame, vector: str = "features", decimals: int = 6) -> DataFrame:
    """Add ``subclusters_id`` of the nearest centroid; equal distances (after rounding) go to the lowest id.

    Centroids ``(subclusters_id, center)`` are a model's k points, a number chosen and not counted: they go to each task as a
    matrix. A NULL vector has no cluster; one that is not finite is equally far from all. See `nearest_centres`.
    """
    points = centroids.orderBy("subclusters_id").toPandas()
    if not len(points):
        return df.withColumn("subclusters_id", F.lit(None).cast("int"))
    shared = df.sparkSession.sparkContext.broadcast(
        (points["subclusters_id"].to_numpy(), np.vstack(points["center"].to_list()).astype("float64")))

    @F.pandas_udf("int")
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ids, centres = shared.value
        for batch in batches:
            found = pd.Series(pd.NA, index=batch.index, dtype="Int32")
            known = batch.notna().to_numpy()
            if known.any():
                found[known] = ids[nearest_centres(np.vstack(batch[known].to_list()).astype("float64"), centres, decimals)]
            yield found

    return df.withColumn("subclusters_id", nearest(F.col(vector)))


def nearest_centres(vectors: np.ndarray, centres: np.ndarray, decimals: int) -> np.ndarray:
    """The place of each vector's nearest centre by rounded squared distance, the first of equal ones.

    Squared norms less twice a matrix product give all distances of a block but for rounding errors, whose bound is known.
    Only centres that could still be first within that bound, one for most vectors, have their distance worked out component by component.
    """
    found = np.zeros(len(vectors), dtype="int64")
    norms = np.einsum("ij,ij->i", centres, centres)
    error = 8 * (centres.shape[1] + 2) * np.finfo("float64").eps
    rows = max(1, BLOCK_VALUES // max(centres.shape))
    for start in range(0, len(vectors), rows):
        block = vectors[start:start + rows]
        squares = np.einsum("ij,ij->i", block, block)
        rough = squares[:, None] + norms - 2 * (block @ centres.T)
        slack = 2 * error * (squares + norms.max()) + 10.0 ** -decimals
        row, centre = np.nonzero(rough <= (rough.min(axis=1) + slack)[:, None])
        exact = np.empty(len(row))
        for at in range(0, len(row), rows):
            exact[at:at + rows] = np.square(block[row[at:at + rows]] - centres[centre[at:at + rows]]).sum(axis=1)
        exact = np.round(exact, decimals)
        order = np.lexsort((centre, exact, row))
        first = order[np.unique(row[order], return_index=True)[1]]
        found[start + row[first]] = centre[first]
    return found
