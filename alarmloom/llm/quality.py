"""Quality by ordinal cumulative-link regression on graded ratings.

P(grade <= k) = sigmoid(threshold k - weights . features): the weights on hashed words
and token shapes are shared by all grades, and the thresholds are ordered. The expected
grade and the probability of a grade from KEEP_FROM on follow for each document, and a
document is kept where that tail probability is at least KEEP_AT.

The training texts are a sample by a hash of doc_id of about SAMPLE_RATED rated
documents, whatever the size of the corpus.

Defined results: a null or empty text has no features and is rated by the thresholds
alone; without ratings, or with one grade only, every document has that grade (or 0) and
is kept; null ratings and ids train nothing; repeated rows stay, one result each. Of a
doc_id with several ratings the lowest counts. Columns of the input under the names of
the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alarmloom.llm.features import (
    BUCKETS,
    Adam,
    Sample,
    collect_sample,
    graded_features,
    sigmoid,
)
from alarmloom.llm.shared import held_out, sample_number

SAMPLE_RATED = 8_000
LEAST_DOCUMENTS = 5
STEPS = 300
RATE = 0.1
DECAY = 1e-5
KEEP_FROM = 1
KEEP_AT = 0.5

RATED = "expected_grade double, tail double"


class Model:
    """Weights by bucket, and the thresholds between consecutive grades."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray, lowest: int) -> None:
        self.weights, self.thresholds, self.lowest = weights, thresholds, lowest

    def rate(self, text: str | None) -> tuple[float, float]:
        """Expected grade, and probability of KEEP_FROM or more."""
        ids, values = graded_features(text)
        margin = float(self.weights[ids] @ values) if len(self.weights) else 0.0
        above = sigmoid(margin - self.thresholds)
        expected = self.lowest + float(above.sum())
        place = KEEP_FROM - self.lowest - 1
        tail = float(above[place]) if 0 <= place < len(above) else float(place < 0)
        return expected, tail


def fit_cumulative(sample: Sample) -> Model:
    """Maximum likelihood with ordered thresholds (a first one and positive steps)."""
    grades = sample.labels["grade"].astype(int) if sample.n else np.zeros(0, int)
    lowest = int(grades.min()) if sample.n else KEEP_FROM
    y = grades - lowest
    top = int(y.max()) if sample.n else 0
    if not top:
        return Model(np.zeros(0, np.float32), np.zeros(0), max(lowest, KEEP_FROM))
    sample.keep(
        np.flatnonzero(np.bincount(sample.ids, minlength=BUCKETS) >= LEAST_DOCUMENTS)
    )
    w = np.zeros(len(sample.buckets))
    shares = np.clip([(y <= k).mean() for k in range(top)], 1e-3, 1 - 1e-3)
    start = np.log(shares / (1 - shares))
    steps = np.log(np.maximum(np.diff(start, prepend=start[0] - 1), 1e-2))
    first, raw = np.array([start[0]]), steps[1:].copy()
    adam = Adam([w, first, raw], RATE)
    each = np.arange(sample.n)
    for _ in range(STEPS):
        thresholds = first + np.concatenate([[0.0], np.cumsum(np.exp(raw))])
        below = sigmoid(thresholds[None, :] - sample.dot(w)[:, None])
        edges = np.hstack([np.zeros((sample.n, 1)), below, np.ones((sample.n, 1))])
        chance = np.maximum(edges[each, y + 1] - edges[each, y], 1e-9)
        slope = edges * (1 - edges)  # of each edge by (threshold - margin)
        upper, under = slope[each, y + 1] / chance, slope[each, y] / chance
        by_threshold = np.zeros((sample.n, top + 2))
        by_threshold[each, y + 1] -= upper
        by_threshold[each, y] += under
        by_threshold = by_threshold[:, 1:-1].mean(axis=0)
        by_margin = (upper - under) / sample.n
        tail_sums = np.cumsum(by_threshold[::-1])[::-1]
        adam.step(
            [
                sample.dot_back(by_margin) + DECAY * w,
                np.array([by_threshold.sum()]),
                tail_sums[1:] * np.exp(raw),
            ]
        )
    weights = np.zeros(BUCKETS, dtype=np.float32)
    weights[sample.buckets] = w
    thresholds = first + np.concatenate([[0.0], np.cumsum(np.exp(raw))])
    return Model(weights, thresholds, lowest)


def train(docs: DataFrame, ratings: DataFrame) -> Model:
    """ratings: doc_id, grade. Rows whose held_out(5, 2) is true train nothing."""
    known = (
        ratings.where(~held_out(5, 2) & F.col("grade").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("grade").alias("grade"))
    )
    share = min(1.0, SAMPLE_RATED / max(1, known.count()))
    chosen = known.where(sample_number("grade") < share)
    # about SAMPLE_RATED ids, so texts need no shuffle
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return fit_cumulative(collect_sample(rows, ["grade"], True))


def graded(labels: DataFrame) -> DataFrame:
    """Ratings from two labels: 0 poor, 1 well formed but toxic, 2 well formed."""
    well = F.col("quality").cast("int")
    return labels.select(
        "doc_id", (well * (2 - F.coalesce("toxic", F.lit(0)))).alias("grade")
    )


def rate(docs: DataFrame, ratings: DataFrame) -> DataFrame:
    """Every row of docs with expected_grade, tail and kept, learned from docs."""
    return rate_with(train(docs, ratings), docs)


def rate_with(model: Model, docs: DataFrame) -> DataFrame:
    """Every row of docs with expected_grade, tail and kept."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(RATED)
    def rated(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame(
                [shipped.value.rate(text) for text in texts],
                columns=["expected_grade", "tail"],
            )

    kept = docs.drop("expected_grade", "tail", "kept")
    return kept.withColumn("__rated", rated("text")).select(
        *kept.columns,
        "__rated.expected_grade",
        "__rated.tail",
        (F.col("__rated.tail") >= KEEP_AT).alias("kept"),
    )
