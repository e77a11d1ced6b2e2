"""Hashed text features and the bounded training samples of the numpy classifiers."""

from __future__ import annotations

import zlib
from collections import Counter
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 20
PREFIXES = 4, 8  # bytes of the shortest and longest beginning of a word
PREFIX_SEED = 77

WORD_BYTES = bytes(
    byte if 48 <= byte <= 57 or 97 <= byte <= 122 or byte >= 128 else 32
    for byte in range(256)
)
SHAPE_BYTES = bytes(
    97
    if 97 <= byte <= 122 or byte >= 128
    else 65
    if 65 <= byte <= 90
    else 48
    if 48 <= byte <= 57
    else byte
    for byte in range(256)
)


def lower_words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(WORD_BYTES).split()


def word_buckets(text: str | None) -> set[int]:
    """Buckets of a text's words and of their beginnings.

    Words of one stem with many endings are each rare; their common beginning is not.
    """
    crc, found = zlib.crc32, set()
    add = found.add
    for word in set(lower_words(text)):
        add(crc(word) % BUCKETS)
        if len(word) > PREFIXES[0]:
            begun = crc(word[: PREFIXES[0]], PREFIX_SEED)
            add(begun % BUCKETS)
            for end in range(PREFIXES[0] + 1, min(PREFIXES[1] + 1, len(word))):
                begun = crc(word[end - 1 : end], begun)
                add(begun % BUCKETS)
    return found


def word_presence(text: str | None) -> np.ndarray:
    """Sorted distinct buckets of a text's words and their beginnings."""
    return np.array(sorted(word_buckets(text)), dtype=np.int32)


def shape_counts(data: bytes) -> Counter:
    """Tokens reduced to their shape (Aa. for "Then."), each run of a class to one."""
    shaped = data.translate(SHAPE_BYTES)
    for run in (b"aa", b"AA", b"00", b"##", b"**", b"!!", b"%%", b"&&", b"$$"):
        while run in shaped:
            shaped = shaped.replace(run, run[:1])
    return Counter(shaped.split())


def graded_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and weights of words and token shapes, each set of unit length.

    The square root of a relative frequency keeps long and short texts comparable.
    """
    data = (text or "").encode()
    tokens = data.split()
    shapes = shape_counts(data)
    shapes[b"same as before"] = sum(map(eq, tokens, tokens[1:]))
    words = Counter(lower_words(text))
    weights: dict[int, float] = {}
    for prefix, counts in ((b"s ", shapes), (b"w ", words)):
        total = sum(counts.values())
        seed = zlib.crc32(prefix)
        for token, n in counts.items():
            if n:
                bucket = zlib.crc32(token, seed) % BUCKETS
                weights[bucket] = weights.get(bucket, 0.0) + (n / total) ** 0.5
    ids = np.fromiter(weights.keys(), dtype=np.int32, count=len(weights))
    return ids, np.fromiter(weights.values(), dtype=np.float32, count=len(weights))


def collect_sample(rows: DataFrame, labels: list[str], weighted: bool) -> "Sample":
    """The features of rows on the driver, in doc_id order; rows must be bounded."""

    @F.pandas_udf("ids binary, weights binary")
    def featured(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            if weighted:
                ids, weights = graded_features(text)
            else:
                ids, weights = word_presence(text), np.zeros(0, np.float32)
            out.append((ids.tobytes(), weights.tobytes()))
        return pd.DataFrame(out, columns=["ids", "weights"])

    kept = rows.select("doc_id", *labels, featured("text").alias("f"))
    got = kept.select("doc_id", *labels, "f.ids", "f.weights").collect()
    got.sort(key=lambda row: (row.doc_id, row.ids, [row[c] for c in labels]))
    return Sample(
        [np.frombuffer(row.ids, dtype=np.int32) for row in got],
        [np.frombuffer(row.weights, dtype=np.float32) for row in got] if weighted else None,
        {c: np.array([row[c] for row in got]) for c in labels},
    )


class Sample:
    """A sparse matrix of documents by buckets, kept as rows laid end to end."""

    def __init__(
        self, ids: list, weights: list | None, labels: dict[str, np.ndarray]
    ) -> None:
        """weights: None where every entry is 1."""
        self.n = len(ids)
        self.labels = labels
        self.row = np.repeat(np.arange(self.n, dtype=np.int32), [len(x) for x in ids])
        self.ids = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        self.weights = np.concatenate(weights) if weights else None

    def keep(self, buckets: np.ndarray) -> None:
        """Only these buckets (sorted) stay; ids become places in them."""
        self.buckets = buckets
        places = np.full(BUCKETS, -1, np.int32)
        places[buckets] = np.arange(len(buckets))
        at = places[self.ids]
        held = at >= 0
        self.row, self.ids = self.row[held], at[held]
        if self.weights is None:
            self.weights = np.ones(len(self.ids), np.float32)
        else:
            self.weights = self.weights[held]

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.ids] * self.weights, minlength=self.n)

    def dot_back(self, g: np.ndarray) -> np.ndarray:
        size = len(self.buckets)
        return np.bincount(self.ids, g[self.row] * self.weights, minlength=size)


class Adam:
    """Full-batch steps on a list of arrays, changed in place."""

    def __init__(self, arrays: list[np.ndarray], rate: float) -> None:
        self.arrays, self.rate, self.t = arrays, rate, 0
        self.m = [np.zeros_like(a) for a in arrays]
        self.v = [np.zeros_like(a) for a in arrays]

    def step(self, gradients: list[np.ndarray]) -> None:
        self.t += 1
        for a, g, m, v in zip(self.arrays, gradients, self.m, self.v):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            scale = (v / (1 - 0.99**self.t)) ** 0.5 + 1e-8
            a -= self.rate * m / (1 - 0.9**self.t) / scale


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))
