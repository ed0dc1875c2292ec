"""Toxicity by a classifier chain.

The categories are predicted in a fixed order by linear models over the terms of a text.
Each later model also gets the probabilities that the earlier ones give. In training
these are out-of-fold predictions (``FOLDS`` folds by a hash of the id), so that a later model
sees what it will see on new texts; the models used for scoring are fitted on all
training rows. The same predictions choose the probability from which a category is flagged: that with the best F1, as
a rare category's probabilities stay low while its words are few. All models are trained with follow-the-regularised-leader updates in one task, on a sample
with the documented bounds of ``quality.labelled_sample``: ``sample`` ids, ``chars`` characters.

The categories are columns of ``labels`` with 0 or 1, in the order of ``categories``. The given tables mark one
category of toxicity, ``toxic``; the registered query puts ``low_quality`` (1 - quality) before it, which is
no category of toxicity but the only other mark that a chain can learn from there.

Defined cases: null and empty texts have no terms; several labels of one id count as
their largest, rows with a null label in any category are not learned, of several texts of one id the smallest is
learned; without any label all probabilities are 0 and nothing is flagged; null ids have no label;
repeated rows give repeated results; very long texts are read whole; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .linear import DIM, Ftrl, TermFeatures, dot, probability
from .quality import SAMPLE, SAMPLE_CHARS, labelled_sample, texts_of

FOLDS = 3
PASSES = 4


def _model(links: int) -> Ftrl:
    return Ftrl(dim=DIM + links, alpha=1.0, l1=8.0, l2=0.1)


def _linked(idx: np.ndarray, x: np.ndarray, earlier: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Terms and, behind them, the earlier categories' probabilities."""
    if not earlier:
        return idx, x
    return np.append(idx, DIM + np.arange(len(earlier), dtype=np.int32)), np.append(x, earlier)


def _fit(rows: list[tuple[np.ndarray, np.ndarray]], y: list[int], links: int) -> Ftrl:
    model = _model(links)
    for _ in range(PASSES):
        for (idx, x), label in zip(rows, y):
            model.learn(idx, x, label)
    return model


class Model(NamedTuple):
    """One category: weights of terms, links to earlier categories and intercept, and the probability from which it is flagged."""

    weights: np.ndarray
    threshold: float


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The probability from which flags have the best F1, in the middle of its gap; 0.5 without rows of both kinds."""
    if not 0 < y.sum() < len(y):
        return 0.5
    order = np.argsort(-p, kind="stable")
    p, hits = p[order], np.cumsum(y[order])
    ends = np.append(p[1:] < p[:-1], True)  # equal probabilities are flagged together
    f1 = np.where(ends, 2 * hits / (np.arange(1, len(p) + 1) + y.sum()), -1.0)
    k = int(f1.argmax())
    return float((p[k] + (p[k + 1] if k + 1 < len(p) else 0.0)) / 2)


def fit_chain(
    docs: DataFrame,
    labels: DataFrame,
    categories: list[str],
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    text_col: str = "text",
    chars: int = SAMPLE_CHARS,
) -> list[Model]:
    """The model of each category."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, terms, marks, fold = TermFeatures(), [], [], []
        for b in batches:
            terms += [features(t) for t in texts_of(b, 1)]
            fold += b.column(2).to_pylist()
            marks += list(zip(*[b.column(3 + k).to_pylist() for k in range(len(categories))]))
        folds = np.array(fold)
        earlier: list[list[float]] = [[] for _ in terms]
        for k in range(len(categories)):
            rows, y = [_linked(*t, e) for t, e in zip(terms, earlier)], [m[k] for m in marks]
            for f in range(FOLDS):
                rest = np.flatnonzero(folds != f)
                fitted = _fit([rows[i] for i in rest], [y[i] for i in rest], k).weights()
                for i in np.flatnonzero(folds == f):
                    earlier[i] = [*earlier[i], probability(dot(fitted, *rows[i]))]
            flagged = best_threshold(np.array([e[k] for e in earlier]), np.array(y))
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([_fit(rows, y, k).weights().tobytes()], pa.binary()), pa.array([flagged])], ["k", "w", "threshold"])

    learned = labelled_sample(docs, labels, sample, chars, id_col, text_col, categories)
    folded = learned.select("id", "text", F.pmod(F.xxhash64(F.lit("fold"), "id"), F.lit(FOLDS)), *categories)
    rows = folded.mapInArrow(train, "k int, w binary, threshold double").collect()
    return [Model(np.frombuffer(r["w"], np.float32), r["threshold"]) for r in sorted(rows, key=lambda r: r["k"])]


def score_chain(
    docs: DataFrame, chain: list[Model], categories: list[str], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, p_<category>...) for every row."""
    shared, names = docs.sparkSession.sparkContext.broadcast([m.weights for m in chain]), [f"p_{c}" for c in categories]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, features = shared.value, TermFeatures()
        for b in batches:
            found: list[list[float]] = []
            for t in texts_of(b, 1):
                terms, p = features(t), []
                for w in models:
                    p.append(probability(dot(w, *_linked(*terms, p))))
                found.append(p or [0.0] * len(categories))
            columns = [pa.array(c, pa.float64()) for c in zip(*found)] or [pa.array([], pa.float64())] * len(categories)
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], ["id", *names])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    schema = f"id {kind}, " + ", ".join(f"`{n}` double" for n in names)
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    categories: list[str],
    sample: int = SAMPLE,
    threshold: float | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, p_<category>..., <category>...) for every row: probabilities, and 1 where one reaches its model's threshold, or the given one."""
    chain = fit_chain(docs, labels, categories, sample, id_col, text_col)
    reached = [threshold if threshold is not None else m.threshold for m in chain] or [0.5] * len(categories)
    flags = [(F.col(f"p_{c}") >= t).cast("int").alias(c) for c, t in zip(categories, reached)]
    return score_chain(docs, chain, categories, id_col, text_col).select("*", *flags)
