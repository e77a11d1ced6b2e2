"""Quality rules: an isolation forest on rule statistics.

Statistics of a text (word lengths, symbols, capitals, repeats) are put into shares that do
not depend on its length. TREES trees split a bounded sample of labelled documents at
random: an attribute, then a value in the part of its range that is the node's. A tree's
ranges are those of its rows, wider by up to one standard deviation of all labelled rows,
so that a value that none of its rows comes near is soon alone too. An odd document is
alone after few splits, so its mean path is short; the score is 2 ** (-mean path /
expected path), near 1 for odd ones.

The sample is of about SAMPLE labelled documents of good quality, by a hash of doc_id.
The threshold comes from all labelled documents: the score at which the share of good
ones kept and that of poor ones dropped are most together, of those scores that keep
LEAST_KEPT of the good ones. Statistics that vary much among good documents (digits,
punctuation, repeated lines) are told but split no tree.

Statistics are computed once, written as a narrow table, and joined to labels from there.

Defined results: a null or empty text has no words and fails the base rules; rows without
a usable label train nothing, and of a doc_id with several labels the lowest counts;
without good labels every document that passes the base rules is kept, without poor ones
the threshold keeps all good ones; repeated rows stay, one result each. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alarmloom.llm.shared import sample_number, written

TREES = 128
PER_TREE = 256
SAMPLE = 16_384
SEED = 17
BINS = 4096
LEAST_KEPT = 0.995
WINDOW = 8
GROUP_BYTES = 2 << 20
FINE = 20  # shares below one in FINE are told apart linearly, larger ones by ratio

# The base rules.
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent of words
SYMBOLS = b"#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_lines", "n_upper", "n_digits", "n_marks", "n_same", "n_distinct"]

UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
MARKS = b"!?.,;:'\"()[]{}/\\_=+-@^~`"


# -- statistics --------------------------------------------------------------------


def dup_lines(text: str) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(lines), len(lines) - len(set(lines))


def repeated_words(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """For each text: words in windows of WINDOW that occur twice or more in it, and words
    equal to the one before.

    Windows are numbered exactly by doubling: a pair of equal halves is an equal whole.
    """
    sizes = np.array([len(w) for w in words])
    number: dict[bytes, int] = {}
    known = number.setdefault
    ids = np.array([known(x, len(number)) for w in words for x in w], np.int64)
    text = np.repeat(np.arange(len(words)), sizes)
    same = np.append(False, (ids[1:] == ids[:-1]) & (text[1:] == text[:-1]))
    n_same = np.bincount(text, same[: len(ids)], minlength=len(words)).astype(np.int64)
    # a window is in one text: its number starts with that of the text
    level = np.unique(text * max(len(number), 1) + ids, return_inverse=True)[1]
    width, at = 1, np.arange(len(ids))
    while width < WINDOW and len(at):
        ends = at[at + width < len(ids)]
        ends = ends[text[ends] == text[ends + width]]
        # only windows whose halves both occur twice can
        often = np.bincount(level[at], minlength=len(ids) + 1) > 1
        ends = ends[often[level[ends]]]
        other = np.full(len(ids) + 1, -1)
        other[at] = level[at]
        ends = ends[other[ends + width] >= 0]
        pair = level[ends] * (len(ids) + 1) + level[ends + width]
        merged = np.full(len(ids) + 1, -1)
        merged[ends] = np.unique(pair, return_inverse=True)[1]
        level, at, width = merged, ends, 2 * width
    covered = np.zeros(len(ids) + 1, np.int64)
    if len(at):
        starts = at[np.bincount(level[at])[level[at]] > 1]
        np.add.at(covered, starts, 1)
        np.add.at(covered, starts + WINDOW, -1)
    inside = np.cumsum(covered)[: len(ids)] > 0
    n_repeat = np.bincount(text, inside, minlength=len(words)).astype(np.int64)
    return n_repeat, n_same


def statistics_of(texts: list[str | None]) -> np.ndarray:
    """The columns COUNTS and MORE for each text."""
    out = np.zeros((len(texts), len(COUNTS) + len(MORE)), np.int64)
    split = []
    for n, text in enumerate(texts):
        text = text or ""
        data = text.encode()
        words = data.split()
        split.append(words)
        lines, dups = dup_lines(text)

        def held(kind: bytes) -> int:
            return len(data) - len(data.translate(None, kind))

        chars = len(text) - sum(map(text.count, SPACES))
        out[n] = (
            len(words), chars, held(SYMBOLS), dups, 0,
            lines, held(UPPER), held(DIGITS), held(MARKS), 0, len(set(words)),
        )
    repeat, same = repeated_words(split)
    out[:, COUNTS.index("n_repeat_words")] = repeat
    out[:, len(COUNTS) + MORE.index("n_same")] = same
    return out


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id with the columns COUNTS and MORE, for every row."""
    names = COUNTS + MORE

    @F.pandas_udf(", ".join(f"{c} bigint" for c in names))
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            parts = [statistics_of(group) for group in grouped(list(texts))]
            table = np.vstack(parts) if parts else np.zeros((0, len(names)), np.int64)
            yield pd.DataFrame(table, columns=names)

    return docs.select("doc_id", counted("text").alias("s")).select("doc_id", "s.*")


def grouped(texts: list[str | None]) -> Iterator[list[str | None]]:
    """The texts in order, in groups of some GROUP_BYTES, a longer one alone."""
    group, size = [], 0
    for text in texts:
        more = len(text) if text else 0
        if group and size + more > GROUP_BYTES:
            yield group
            group, size = [], 0
        group.append(text)
        size += more
    if group:
        yield group


def base_failed() -> Column:
    few = F.col("n_words") < LEAST_WORDS
    return few | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def shares(table: np.ndarray) -> np.ndarray:
    """Attributes of the forest, from the columns COUNTS and MORE."""
    c = dict(zip(COUNTS + MORE, table.T.astype(float)))
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)

    def rate(count: str, of: np.ndarray) -> np.ndarray:
        return np.log1p(FINE * c[count] / of)

    return np.stack(
        [
            chars / words,
            rate("n_symbols", words),
            rate("n_upper", chars),
            rate("n_same", words),
            # distinct words fall with length: against a power of it
            np.log(np.maximum(c["n_distinct"], 1)) / np.log(np.maximum(words, 2)),
        ],
        axis=1,
    )


# -- forest ------------------------------------------------------------------------


def expected_path(n: np.ndarray) -> np.ndarray:
    """Mean path of a failed search in a random binary tree of n rows."""
    n = np.asarray(n, float)
    many = np.maximum(n, 2)
    path = 2 * (np.log(many - 1) + 0.5772156649) - 2 * (many - 1) / many
    return np.where(n > 2, path, np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """All trees in one table of nodes; a leaf points to itself and holds its path."""

    attribute: np.ndarray
    value: np.ndarray
    left: np.ndarray
    right: np.ndarray
    path: np.ndarray
    roots: np.ndarray
    height: int
    norm: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Anomaly scores of rows, 0 to 1."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.height):
                goes_left = x[rows, self.attribute[node]] < self.value[node]
                node = np.where(goes_left, self.left[node], self.right[node])
            total += self.path[node]
        return 2.0 ** (-total / (len(self.roots) * self.norm))


def fit(x: np.ndarray, spread: np.ndarray) -> Forest | None:
    """Trees over random parts of the rows; the same rows give the same trees.

    spread: how far beyond its rows the ranges of a tree may reach, by attribute.
    """
    if len(x) < 2:
        return None
    rng = np.random.default_rng(SEED)
    size = min(PER_TREE, len(x))
    height = int(np.ceil(np.log2(size)))
    nodes: list[list[float]] = []

    def grow(rows: np.ndarray, depth: int, low: np.ndarray, high: np.ndarray) -> int:
        at = len(nodes)
        nodes.append([0, 0.0, at, at, depth + float(expected_path(len(rows)))])
        varied = np.flatnonzero(high > low)
        if depth < height and len(rows) > 1 and len(varied):
            k = rng.choice(varied)
            cut = rng.uniform(low[k], high[k])
            left, below, above = rows[:, k] < cut, high.copy(), low.copy()
            below[k] = above[k] = cut
            first = grow(rows[left], depth + 1, low, below)
            nodes[at][:4] = k, cut, first, grow(rows[~left], depth + 1, above, high)
        return at

    def tree() -> int:
        rows = x[rng.choice(len(x), size, replace=False)]
        wider = spread * rng.uniform(size=(2, len(spread)))
        return grow(rows, 0, rows.min(axis=0) - wider[0], rows.max(axis=0) + wider[1])

    roots = [tree() for _ in range(TREES)]
    attribute, value, left, right, path = zip(*nodes)
    return Forest(
        np.array(attribute, int), np.array(value), np.array(left, int),
        np.array(right, int), np.array(path), np.array(roots), height,
        float(expected_path(size)),
    )


def threshold(good: np.ndarray, poor: np.ndarray) -> float:
    """The bin from which scores are odd, from counts of labelled rows by bin."""
    kept = np.append(0, np.cumsum(good)) / max(good.sum(), 1)
    caught = 1 - np.append(0, np.cumsum(poor)) / max(poor.sum(), 1)
    if not poor.sum():
        caught[:] = 0
    fit_for = kept >= LEAST_KEPT if good.sum() else kept >= 0
    gain = np.where(fit_for, kept + caught, -1)
    # the highest of equal bins: what no labelled row speaks against is kept
    return int(len(gain) - 1 - np.argmax(gain[::-1])) / BINS


@dataclass
class Model:
    forest: Forest | None
    threshold: float


def calibrated(stats: DataFrame, labels: DataFrame) -> Model:
    """labels: doc_id, quality (1 good, 0 poor)."""
    known = (
        labels.where(F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg((F.min("quality") > 0).alias("good"))
    )
    passing = written(stats.join(known, "doc_id").where(~base_failed()))
    good = passing.where("good")
    share = min(1.0, SAMPLE / max(1, good.count()))
    x = attributes(good.where(sample_number("forest") < share), SAMPLE)
    everything = attributes(passing.where(sample_number("spread") < share), 2 * SAMPLE)
    forest = fit(x, everything.std(axis=0) if len(everything) else np.zeros(x.shape[1]))
    if forest is None:
        return Model(None, 1.0)
    place = F.least(F.floor(scored(forest, passing) * BINS), F.lit(BINS - 1))
    counts = np.zeros((2, BINS), np.int64)
    for row in passing.groupBy("good", place.alias("bin")).count().collect():
        counts[int(row.good), row.bin] = row["count"]
    return Model(forest, threshold(counts[1], counts[0]))


def attributes(rows: DataFrame, most: int) -> np.ndarray:
    """Attributes of some rows on the driver; a doc_id held by many rows adds few."""
    told = rows.select("doc_id", *COUNTS, *MORE).distinct()
    got = told.orderBy("doc_id", *COUNTS, *MORE).limit(2 * most).collect()
    return shares(np.array([r[1:] for r in got], np.int64).reshape(-1, len(COUNTS + MORE)))


def scored(forest: Forest, stats: DataFrame) -> Column:
    """The anomaly score of a row of statistics."""
    shipped = stats.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            table = np.stack([c.to_numpy(np.int64) for c in columns], axis=1)
            yield pd.Series(shipped.value.scores(shares(table)))

    return score(*COUNTS, *MORE)


def rule_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row's doc_id, statistics, base_failed, anomaly (0 to 1) and kept."""
    stats = written(statistics(docs))
    model = calibrated(stats, labels)
    anomaly = scored(model.forest, stats) if model.forest else F.lit(0.0)
    return stats.withColumn("anomaly", anomaly).select(
        "doc_id",
        *COUNTS,
        *MORE,
        base_failed().alias("base_failed"),
        "anomaly",
        (~base_failed() & (F.col("anomaly") < model.threshold)).alias("kept"),
    )


def rule_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return rule_quality(docs, labels).select(
        "doc_id", *COUNTS, "base_failed", "kept", "anomaly"
    )
