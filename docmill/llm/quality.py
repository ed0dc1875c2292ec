"""Quality classifier: hashed word n-gram logistic regression, follow-the-regularised-leader.

The model is fitted on a bounded sample of labelled ids (documented bounds): the ``sample`` ids that hash
smallest, as far as their texts have ``chars`` characters in all and ``chars`` / 64 each. One row of each id
counts, so repeated rows do not weigh more. The fit runs in the order of those hashes, in one task whose
input the bounds limit; it gets the sample once for each pass and holds one batch of it at a time. Scores of all texts are sparse dot products in a map over Arrow batches; the
weights (1 MB) are broadcast. Labels, language, source and id are never inputs of a score. Beside word and
word-shape n-grams there is one more feature, the share of words that equal their neighbour.

Defined cases: null and empty texts have no features and score by the intercept; several
labels of one id count as their largest, of several texts of one id the smallest is learned; without any label
all scores are 0.5; null ids have no label and are not held out; equal hashes of ids are ordered by the id;
repeated rows give repeated results; very long texts are scored whole; an empty table gives an empty result;
other columns are ignored, or passed through by ``keep_good``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._store import map_texts, materialize
from .linear import DIM, Ftrl, QualityFeatures, dot, probability, summed

SAMPLE = 12_000
SAMPLE_CHARS = 64_000_000
PASSES = 2


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo 3; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int, chars: int, id_col: str, text_col: str, columns: list[str], passes: int = 1) -> DataFrame:
    """(id, text, *columns) of at most ``sample`` training ids and ``chars`` characters, in one partition, in the order of their ids' hashes, ``passes`` times over."""
    chosen = (
        labels.filter(fold(id_col) != 1)
        .groupBy(F.col(id_col).alias("l_id"))
        .agg(*[F.max(c).cast("int").alias(c) for c in columns])
        .dropna()
        .orderBy(F.xxhash64("l_id"), "l_id")
        .limit(sample)
    )
    joined = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), F.col("id") == F.col("l_id"))
    texts = joined.groupBy("id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), *[F.first(c).alias(c) for c in columns])
    found = materialize(texts.withColumn("n", F.length("text")).filter(F.col("n") <= chars // 64), "fit-sample")
    # at most ``sample`` rows of numbers, hence one task
    upto = F.sum("n").over(Window.orderBy(F.xxhash64("id"), "id").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    kept = found.select("id", upto.alias("upto")).filter(F.col("upto") <= chars).select("id")
    learned = found.join(F.broadcast(kept), "id").select("id", "text", *columns).repartition(1)
    if passes == 1:
        return learned.sortWithinPartitions(F.xxhash64("id"), "id")
    again = learned.withColumn("__pass", F.explode(F.sequence(F.lit(1), F.lit(passes))))
    return again.sortWithinPartitions("__pass", F.xxhash64("id"), "id").drop("__pass")


def fit_quality(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", chars: int = SAMPLE_CHARS
) -> np.ndarray:
    """Weights, the intercept last."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, model = QualityFeatures(), Ftrl(alpha=0.5, l1=0.1, l2=0.1)
        for b in batches:
            for t, y in zip(texts_of(b, 1), b.column(2).to_pylist()):
                idx, x = summed(*features(t))
                model.learn(idx.astype(np.int32), x, y)
        yield pa.RecordBatch.from_arrays([pa.array([model.weights().tobytes()], pa.binary())], ["w"])

    learned = labelled_sample(docs, labels, sample, chars, id_col, text_col, ["quality"], PASSES)
    rows = map_texts(learned, train, "w binary").collect()
    return np.frombuffer(rows[0]["w"], np.float32) if rows else np.zeros(DIM + 1, np.float32)


def texts_of(batch: pa.RecordBatch, column: int, size: int = 512) -> Iterator[str]:
    for at in range(0, batch.num_rows, size):
        for t in batch.column(column).slice(at, size).to_pylist():
            yield t or ""


def score_quality(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, features = shared.value, QualityFeatures()
        for b in batches:
            s = [probability(dot(w, *features(t))) for t in texts_of(b, 1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], ["id", "score"])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    scored = map_texts(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, f"id {kind}, score double")
    return scored.select(
        F.col("id").alias(id_col),
        F.coalesce(fold("id") == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, weights: np.ndarray, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, all columns as they are."""
    shared, at = docs.sparkSession.sparkContext.broadcast(weights), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, features = shared.value, QualityFeatures()
        for b in batches:
            yield b.filter(pa.array([dot(w, *features(t)) >= 0 for t in texts_of(b, at)], pa.bool_()))

    return map_texts(docs, run, docs.schema)
