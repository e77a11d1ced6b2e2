"""Toxicity by non-negative positive-unlabelled learning.

The classifier sees confirmed toxic documents and unlabelled text only. With the class
prior p, the risk of calling unlabelled text clean holds p times the risk of calling
toxic text clean; that share is taken off, and where a step would push what is left
below zero, it is taken back instead (the non-negative estimator). The prior is the
toxic share of all training labels.

The training texts are samples by a hash of doc_id: about SAMPLE_TOXIC toxic documents
and about SAMPLE_UNLABELLED of all documents (their labels unread), whatever the size of
the corpus. Everything else (the prior, the scores) covers all rows.

Features are words and beginnings of words by hash, present or not. Only those stay that
toxic documents hold more often than the rest by more than chance explains; they are
counted on the executors, and the driver gets the sample less all other features.

Defined results: a null or empty text has no words and scores as the bias alone; without
toxic labels every score is next to 0 (below 1e-17); a label or doc_id that is null trains nothing, and a null
doc_id counts as held out; repeated rows stay, one result each; other columns are not
read. Of a doc_id with several labels, toxic wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alarmloom.llm.features import (
    BUCKETS,
    Adam,
    Sample,
    sigmoid,
    word_buckets,
    word_presence,
)
from alarmloom.llm.shared import held_out, sample_number, written

SAMPLE_TOXIC = 4_000
SAMPLE_UNLABELLED = 16_000
LEAST_TOXIC = 3
BY_CHANCE = 1
STEPS = 400
RATE = 0.05
DECAY = 3e-4
TOXIC_FROM = 0.7


class Model:
    """Weights by bucket, and the bias."""

    def __init__(self, weights: dict[int, float], bias: float) -> None:
        self.weights, self.bias = weights, bias

    def score(self, text: str | None) -> float:
        weight = self.weights.__getitem__
        found = self.weights.keys() & word_buckets(text)
        margin = self.bias + sum(weight(bucket) for bucket in sorted(found))
        return float(sigmoid(np.float64(margin)))


def telling(
    in_toxic: np.ndarray, in_other: np.ndarray, n_toxic: int, n_other: int
) -> np.ndarray:
    """Places of the counts that are higher in toxic documents than chance makes them.

    Of those tried, about BY_CHANCE pass without a reason; the fewer labels there are,
    the fewer are tried and the lower is the bar.
    """
    share = (in_toxic + in_other) / (n_toxic + n_other)
    error = (share * (1 - share) * (1 / n_toxic + 1 / n_other)) ** 0.5
    lift = in_toxic / n_toxic - in_other / n_other
    tried = in_toxic >= LEAST_TOXIC
    bar = NormalDist().inv_cdf(1 - min(0.5, BY_CHANCE / max(1, int(tried.sum()))))
    return np.flatnonzero(tried & (lift > bar * error))


def fit_non_negative(sample: Sample, prior: float) -> Model:
    """Minimise the class-prior-corrected risk of a linear margin."""
    toxic = sample.labels["toxic"] == 1
    n_toxic, n_other = int(toxic.sum()), int((~toxic).sum())
    if not n_toxic or not n_other or not prior:
        return Model({}, -40.0)
    of_toxic = toxic[sample.row]
    in_toxic = np.bincount(sample.ids[of_toxic], minlength=BUCKETS)
    in_other = np.bincount(sample.ids[~of_toxic], minlength=BUCKETS)
    sample.keep(telling(in_toxic, in_other, n_toxic, n_other))

    w = np.zeros(len(sample.buckets))
    bias = np.array([np.log(prior / (1 - prior))])
    adam = Adam([w, bias], RATE)
    for _ in range(STEPS):
        margin = sample.dot(w) + bias
        p = sigmoid(margin)
        # slopes of log(1 + exp(-m)) for toxic, log(1 + exp(m)) for clean
        as_toxic = np.where(toxic, -prior * (1 - p) / n_toxic, 0.0)
        as_clean = np.where(toxic, -prior * p / n_toxic, p / n_other)
        clean_loss = np.logaddexp(0, margin)
        clean_risk = clean_loss[~toxic].mean() - prior * clean_loss[toxic].mean()
        slope = as_toxic + as_clean if clean_risk >= 0 else -as_clean
        adam.step([sample.dot_back(slope) + DECAY * w, np.array([slope.sum()])])
    weights = dict(zip(sample.buckets.tolist(), w.tolist()))
    return Model(weights, float(bias[0]))


def screened(rows: DataFrame) -> Sample:
    """The sample with telling buckets only; rows (doc_id, text, toxic) must be bounded.

    Buckets are counted where the rows are, so the driver gets a count for each of
    BUCKETS at most, and of the rows the few buckets that pass.
    """

    @F.pandas_udf("binary")
    def presence(texts: pd.Series) -> pd.Series:
        return pd.Series([word_presence(text).tobytes() for text in texts], dtype=object)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for toxic, ids in zip(batch.column("toxic"), batch.column("ids")):
                n[toxic.as_py(), np.frombuffer(ids.as_py(), np.int32)] += 1
        some = np.flatnonzero(n.any(axis=0))
        columns = [pa.array(some), pa.array(n[1, some]), pa.array(n[0, some])]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", "in_toxic", "in_other"])

    held = written(rows.select("doc_id", F.col("toxic").cast("int"), presence("text").alias("ids")))
    sizes = {row.toxic: row["count"] for row in held.groupBy("toxic").count().collect()}
    counts = (
        held.select("toxic", "ids")
        .mapInArrow(counted, "bucket long, in_toxic long, in_other long")
        .groupBy("bucket")
        .agg(F.sum("in_toxic").alias("in_toxic"), F.sum("in_other").alias("in_other"))
        .toPandas()
        .sort_values("bucket")
    )
    in_toxic, in_other = (counts[c].to_numpy(np.int64) for c in ("in_toxic", "in_other"))
    n_toxic, n_other = sizes.get(1, 0), sizes.get(0, 0)
    buckets = np.zeros(0, np.int32)
    if n_toxic and n_other:
        passing = telling(in_toxic, in_other, n_toxic, n_other)
        buckets = counts["bucket"].to_numpy(np.int32)[passing]
    shipped = rows.sparkSession.sparkContext.broadcast(buckets)

    @F.pandas_udf("binary")
    def of_these(ids: pd.Series) -> pd.Series:
        found = [np.frombuffer(x, np.int32) for x in ids]
        kept = [np.intersect1d(x, shipped.value, assume_unique=True) for x in found]
        return pd.Series([x.astype(np.int32).tobytes() for x in kept], dtype=object)

    got = held.select("doc_id", "toxic", of_these("ids").alias("ids")).collect()
    got.sort(key=lambda row: (row.doc_id, row.ids, row.toxic))
    return Sample(
        [np.frombuffer(row.ids, np.int32) for row in got],
        None,
        {"toxic": np.array([row.toxic for row in got])},
    )


def train(docs: DataFrame, labels: DataFrame) -> Model:
    known = (
        labels.where(~held_out(3, 1) & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    counts = known.agg(
        F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")
    ).first()
    if not counts.toxic:
        return Model({}, -40.0)
    training = docs.where(~held_out(3, 1)).select("doc_id", "text")
    share = min(1.0, SAMPLE_TOXIC / counts.toxic)
    toxic = known.where((F.col("toxic") == 1) & (sample_number("toxic") < share))
    # about SAMPLE_TOXIC ids, so texts need no shuffle
    confirmed = training.join(F.broadcast(toxic), "doc_id")
    share = min(1.0, SAMPLE_UNLABELLED / max(1, training.count()))
    unlabelled = training.where(sample_number("unlabelled") < share)
    sample = screened(confirmed.unionByName(unlabelled.withColumn("toxic", F.lit(0))))
    return fit_non_negative(sample, counts.toxic / counts.n)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([model.value.score(text) for text in texts], dtype="float64")

    scored = docs.select(
        "doc_id", held_out(3, 1).alias("held_out"), score("text").alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))
