"""Target-distribution importance resampling: scores from arrays, then quickselect.

Hashed counts of word runs of the raw and of the target texts give each bucket a gain,
the thousandfold logarithm of how much likelier it is in the target. A document's weight
is its mean gain; Gumbel noise from its id turns the highest scores into a sample drawn
by weight without replacement.

The k highest are found by quickselect over composite keys (score, doc_id, ...): every
round counts, in one pass, the rows below, at and above each of PIVOTS pivot keys drawn
at random from the range that is left, and keeps the range that holds the k-th; the same
pass draws the next pivots. Only the winners are sorted, by ranges, and ranked by their
place within a range and the counts of the ranges before it.

What passes through the driver is bounded by parameters: BUCKETS gains, PIVOTS keys a
round, one count for each range.

Defined results: a null or empty text has no features and weight 0, and is drawn only if
least_words is 0; without target or raw features all gains come from the counts of 0; a
null doc_id hashes as an empty one and goes before others of its score; rows alike in
score and doc_id go by n_features, then in any order; no rows, no winners. Other columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alarmloom.llm.shared import written
from alarmloom.llm.sql_text import CRC_TABLE, crc32_sql

BUCKETS = 10_000
LONGEST_RUN = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
PIVOTS = 16
BATCH_BYTES = 4 << 20

# A-Z as a-z; digits, letters and bytes of longer characters stay; others part words.
FOLDED = bytes(
    byte + 32
    if 65 <= byte <= 90
    else byte
    if 48 <= byte <= 57 or 97 <= byte <= 122 or byte >= 128
    else 32
    for byte in range(256)
)

# -- features --------------------------------------------------------------------


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(FOLDED).split() if text else []


def buckets_of(words: list[bytes], longest: int) -> np.ndarray:
    """Buckets of all runs of 1 to longest words, repeats included."""
    crc = zlib.crc32
    found = [crc(word) for word in words]
    for n in range(2, longest + 1):
        found += [crc(b" ".join(words[i : i + n])) for i in range(len(words) - n + 1)]
    return np.array(found, np.int64) % BUCKETS


def bounded(texts: list[bytes | None]) -> Iterator[list[bytes | None]]:
    """The texts in order, in groups of some BATCH_BYTES, a longer one alone."""
    group, size = [], 0
    for text in texts:
        more = len(text) if text else 0
        if group and size + more > BATCH_BYTES:
            yield group
            group, size = [], 0
        group.append(text)
        size += more
    if group:
        yield group


def bucket_counts(texts: DataFrame, longest: int) -> np.ndarray:
    """How many features each bucket has, as an array on the driver (BUCKETS long)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for group in bounded(batch.column("text").to_pylist()):
                found = [buckets_of(words_of(text), longest) for text in group]
                total += np.bincount(np.concatenate(found), minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held), pa.array(total[held])], names=["bucket", "n"]
        )

    parts = as_bytes(texts).select("text").mapInArrow(count, "bucket bigint, n bigint")
    found = np.zeros(BUCKETS, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        found[row.bucket] = row.n
    return found


def as_bytes(rows: DataFrame) -> DataFrame:
    return rows.withColumn("text", F.col("text").cast("binary"))


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandfold logarithms of target share over raw share, smoothed, floored."""
    s, t = raw.astype(float), target.astype(float)
    ratio = (t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


# -- scores ----------------------------------------------------------------------


def scored(docs: DataFrame, gain: np.ndarray, longest: int, seed: int) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(gain)

    @F.pandas_udf("n_words bigint, n_features bigint, weight bigint")
    def weighed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        gain = shipped.value
        for texts in batches:
            rows = []
            for group in bounded(list(texts)):
                words = [words_of(text) for text in group]
                features = [buckets_of(w, longest) for w in words]
                sizes = np.array([len(f) for f in features], np.int64)
                # sums of gains of consecutive stretches of one array
                run = np.append(0, np.cumsum(gain[np.concatenate(features)]))
                ends = np.cumsum(sizes)
                total = run[ends] - run[ends - sizes]
                weight = total // np.maximum(sizes, 1)
                rows.append(np.array([[len(w) for w in words], sizes, weight]))
            table = np.hstack(rows) if rows else np.zeros((3, 0), np.int64)
            yield pd.DataFrame(dict(zip(["n_words", "n_features", "weight"], table)))

    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    rows = as_bytes(docs.select("doc_id", "text")).withColumn("w", weighed("text"))
    return rows.select(
        "doc_id",
        "w.n_words",
        "w.n_features",
        "w.weight",
        (F.col("w.weight") + noise).cast("long").alias("score"),
    )


# -- selection -------------------------------------------------------------------

KEY = ["k_score", "k_known", "k_doc", "k_features", "k_row"]


def with_key(rows: DataFrame) -> DataFrame:
    """rows with the columns of a composite key, no two alike, lowest first."""
    return rows.withColumns(
        {
            "k_score": -F.col("score"),
            "k_known": F.col("doc_id").isNotNull().cast("long"),
            "k_doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)),
            "k_features": F.col("n_features"),
            "k_row": F.monotonically_increasing_id(),
        }
    )


def key_of(pivot: tuple) -> Column:
    return F.struct(*[F.lit(value).cast("long").alias(c) for c, value in zip(KEY, pivot)])


def below(pivot: tuple) -> Column:
    """Whether a row's key is lower than the pivot's."""
    return F.struct(*KEY) < key_of(pivot)


def same(pivot: tuple) -> Column:
    return F.struct(*KEY) == key_of(pivot)


def kth_key(rows: DataFrame, k: int) -> tuple | None:
    """The key of the k-th lowest row (from 1), None if there are fewer."""
    pivots, low, high, skipped, number = [], None, None, 0, 0
    while True:
        found = counted(rows, pivots, low, high, number)
        # place 2i holds what lies below pivot i, place 2i + 1 the pivot itself
        ahead = skipped
        for place in range(2 * len(pivots) + 1):
            n, drawn = found.get(place, (0, []))
            if ahead + n >= k:
                break
            ahead += n
        else:
            return None
        at, is_pivot = divmod(place, 2)
        if is_pivot:
            return pivots[at]
        skipped, number = ahead, number + 1
        low = pivots[at - 1] if at else low
        high = pivots[at] if at < len(pivots) else high
        pivots = drawn


def counted(
    rows: DataFrame, pivots: list[tuple], low: tuple | None, high: tuple | None, number: int
) -> dict[int, tuple[int, list[tuple]]]:
    """Rows and random keys for each stretch between the pivots, of keys within bounds."""
    if low:
        rows = rows.where(~below(low) & ~same(low))
    if high:
        rows = rows.where(below(high))
    place = F.lit(0)
    for pivot in pivots:
        place = place + F.when(below(pivot), 0).when(same(pivot), 1).otherwise(2)
    key = F.struct(*KEY)
    draws = [
        F.min_by(key, F.xxhash64("k_row", F.lit(number * PIVOTS + j))).alias(f"p{j}")
        for j in range(PIVOTS)
    ]
    groups = rows.groupBy(place.alias("place")).agg(F.count(F.lit(1)).alias("n"), *draws)
    return {
        r.place: (r.n, sorted({tuple(r[f"p{j}"]) for j in range(PIVOTS)}))
        for r in groups.collect()
    }


def ranked(winners: DataFrame) -> DataFrame:
    """winners with rank, from 1, in the order of their keys."""
    spark = winners.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = written(
        winners.repartitionByRange(ranges, *KEY)
        .sortWithinPartitions(*KEY)
        # range, and place within it
        .withColumn("at", F.monotonically_increasing_id())
        .withColumns({"range": F.shiftright("at", 33), "at": F.col("at") % (1 << 33)})
    )
    ahead, total = [], 0
    for row in sorted(placed.groupBy("range").count().collect()):
        ahead.append((row["range"], total))
        total += row["count"]
    offsets = spark.createDataFrame(ahead, "range bigint, ahead bigint")
    return placed.join(F.broadcast(offsets), "range").withColumn(
        "rank", F.col("ahead") + F.col("at") + 1
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    longest_run: int = LONGEST_RUN,
    seed: int = SEED,
) -> DataFrame:
    """Every row's doc_id, n_words, n_features, weight, score and rank (null: not drawn)."""
    raw = bucket_counts(docs, longest_run)
    gain = gains(raw, bucket_counts(target, longest_run))
    rows = written(with_key(scored(docs, gain, longest_run, seed)))
    eligible = rows.where(F.col("n_words") >= least_words)
    last = kth_key(eligible, k) if (k := percent * eligible.count() // 100) else None
    drawn = (F.col("n_words") >= least_words) & (below(last) | same(last)) if last else F.lit(False)
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    rest = rows.where(~drawn).select(*columns, F.lit(None).cast("long").alias("rank"))
    if not last:
        return rest
    return rest.unionByName(ranked(rows.where(drawn)).select(*columns, "rank"))


def resampling_report(docs: DataFrame, target: DataFrame) -> DataFrame:
    return resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


def _features_sql(table: str, name: str) -> str:
    return f"""{name} AS (
  SELECT {name}_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word
  FROM (SELECT {'doc_id' if name == 'raw' else 'item_id'} AS {name}_id, text FROM {table})
)"""


ORACLE = f"""
WITH {CRC_TABLE}, {_features_sql('documents', 'raw')},
{_features_sql('benchmark', 'target')},
vocabulary AS (
  SELECT word, {crc32_sql('word')} % {BUCKETS} AS bucket
  FROM (SELECT word FROM raw UNION SELECT word FROM target), crc_table
), counts AS (
  SELECT bucket, sum(s)::DOUBLE AS s, sum(t)::DOUBLE AS t
  FROM (SELECT word, count(*) AS s, 0 AS t FROM raw GROUP BY word
        UNION ALL SELECT word, 0, count(*) FROM target GROUP BY word)
  JOIN vocabulary USING (word) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM counts) + {BUCKETS})
    / ((s + 1) * ((SELECT sum(t) FROM counts) + {BUCKETS}))))::BIGINT AS gain
  FROM counts
), weights AS (
  SELECT raw_id AS doc_id, count(*) AS n_features,
         floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM raw JOIN vocabulary USING (word) JOIN gains USING (bucket) GROUP BY raw_id
), scores AS (
  SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln(
      (('0x' || sha256('{SEED}:' || d.doc_id)[:8])::BIGINT + 0.5::DOUBLE)
      / 4294967296::DOUBLE)))::BIGINT AS score
  FROM documents d LEFT JOIN weights USING (doc_id)
), eligible AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank,
         count(*) OVER () AS n
  FROM scores WHERE n_features >= {LEAST_WORDS}
)
SELECT s.*, e.rank FROM scores s LEFT JOIN eligible e
  ON e.doc_id = s.doc_id AND e.rank <= {PERCENT} * e.n // 100
"""
