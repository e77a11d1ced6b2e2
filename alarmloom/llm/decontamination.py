"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Every window of an item (so many consecutive words, or the whole item if it is shorter)
is a pattern. A block of two words at the end of the search window is looked up in a
shift table: where no pattern has the block near its end, positions that cannot match
are skipped, up to nine words at a time. Where the shift is zero, the block's bucket
gives the patterns that end in it; those that also begin with the words in place are
compared word by word.

Words are runs of a-z, 0-9 and every character beyond ASCII, after lower-casing A-Z.

Windows are cut and made distinct on the executors, written to the shared folder and
dealt into blocks of bounded size by a hash. One block is fetched and broadcast at a time;
a benchmark with more windows is searched block after block, with a checkpoint between,
so neither a worker nor the driver ever holds all of a large benchmark.

Defined results: a null, empty or wordless text has no words and no hits; an item
without id, text or words is no pattern; repeated items count once by their id; repeated
documents stay, one result each; other columns are not read. A long text is split into
words piece by piece, pieces overlapping by one window.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alarmloom.llm.shared import cut_lineage, written

LETTERS = bytes(
    byte + 32
    if 65 <= byte <= 90
    else byte
    if 48 <= byte <= 57 or 97 <= byte <= 122 or byte >= 128
    else 32
    for byte in range(256)
)
PIECE_BYTES = 4 << 20
BLOCK_WINDOWS = 100_000
CUT_AT_ONCE = 10_000

FOUND = "n_words long, spans array<long>, items array<string>"


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(LETTERS).split()


def pieces(text: str, overlap: int) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first word, words) of each piece of a text."""
    data = text.encode().translate(LETTERS)
    first, tail, at = 0, [], 0
    while at < len(data):
        end = data.find(b" ", at + PIECE_BYTES)
        end = len(data) if end < 0 else end
        words = tail + data[at:end].split()
        yield first, words
        tail = words[-overlap:] if overlap else []
        first += len(words) - len(tail)
        at = end


class Patterns:
    """The patterns of one length with their shift table and buckets."""

    def __init__(self, length: int) -> None:
        self.length = length
        self.block = min(2, length)
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, list]] = {}

    def add(self, window: list[bytes], item: str) -> None:
        length, block = self.length, self.block
        for end in range(block, length + 1):
            key = tuple(window[end - block : end])
            self.shift[key] = min(self.shift.get(key, length), length - end)
        heads = self.buckets.setdefault(tuple(window[-block:]), {})
        listed = heads.setdefault(tuple(window[:block]), [])
        for known, items in listed:
            if known == window:
                items.add(item)
                return
        listed.append((window, {item}))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, set[str]]]:
        """(first word, items) of each occurrence, from left to right."""
        length, block, shift = self.length, self.block, self.shift.get
        skip, n, at = length - block + 1, len(words), length
        while at <= n:
            key = tuple(words[at - block : at])
            step = shift(key, skip)
            if step:
                at += step
                continue
            start = at - length
            head = tuple(words[start : start + block])
            for window, items in self.buckets[key].get(head, ()):
                if words[start:at] == window:
                    yield start, items
            at += 1


class Searcher:
    def __init__(self, windows: list[tuple[list[bytes], str]]) -> None:
        self.by_length: dict[int, Patterns] = {}
        for window, item in windows:
            length = len(window)
            if length not in self.by_length:
                self.by_length[length] = Patterns(length)
            self.by_length[length].add(window, item)
        self.overlap = max(self.by_length, default=1) - 1

    def find(self, text: str | None) -> tuple[int, list[int], list[str]]:
        """Words, hit words as merged (start << 32 | end) spans, items found."""
        total, items, found = 0, set(), []
        for first, words in pieces(text or "", self.overlap):
            total = first + len(words)
            for patterns in self.by_length.values():
                for start, ids in patterns.search(words):
                    items |= ids
                    found.append((first + start, first + start + patterns.length))
        return total, [a << 32 | b for a, b in merged(found)], list(items)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def windows_of(benchmark: DataFrame, window: int) -> DataFrame:
    """words (a window, joined by spaces) and id of its item, each pair once."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for item, text in zip(batch.id, batch.text):
                words = words_of(text)
                starts = range(max(1, len(words) - window + 1) if words else 0)
                for at in range(0, len(starts), CUT_AT_ONCE):
                    some = starts[at : at + CUT_AT_ONCE]
                    joined = [b" ".join(words[s : s + window]) for s in some]
                    yield pd.DataFrame({"words": joined, "id": item})

    items = benchmark.select(F.col("item_id").cast("string").alias("id"), "text")
    return items.dropna().mapInPandas(cut, "words binary, id string").distinct()


def window_blocks(
    benchmark: DataFrame, window: int, block_windows: int
) -> Iterator[list[tuple[list[bytes], str]]]:
    """The windows of all items, about block_windows at a time; one empty block if none."""
    windows = written(windows_of(benchmark, window))
    n = max(1, -(-windows.count() // block_windows))
    dealt = F.pmod(F.xxhash64("words", "id"), F.lit(n))
    for k in range(n):
        rows = windows.where(dealt == k).collect()
        if rows or n == 1:
            yield [(bytes(row.words).split(b" "), row.id) for row in rows]


def searched(spark: SparkSession, docs: DataFrame, windows: list) -> DataFrame:
    """docs with the column __found: what the windows hit in text."""
    shipped = spark.sparkContext.broadcast(windows)
    ready: list[Searcher] = []

    @F.pandas_udf(FOUND)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if not ready:
            ready.append(Searcher(shipped.value))
        for texts in batches:
            yield pd.DataFrame(
                [ready[0].find(text) for text in texts],
                columns=["n_words", "spans", "items"],
            )

    return docs.withColumn("__found", find("text"))


def union_length(spans: str) -> F.Column:
    """Words covered by the sorted spans of an array column."""
    return F.aggregate(
        F.array_sort(spans),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
        lambda acc, span: F.struct(
            (
                acc.n
                + F.greatest(
                    F.lit(0),
                    span.bitwiseAND(0xFFFFFFFF)
                    - F.greatest(F.shiftright(span, 32), acc.to),
                )
            ).alias("n"),
            F.greatest(acc.to, span.bitwiseAND(0xFFFFFFFF)).alias("to"),
        ),
        lambda acc: acc.n,
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Every row of docs with n_words, n_hit, spans, items (sorted) and contaminated.

    docs has the column text; columns of docs under the new names are replaced.
    """
    spark = docs.sparkSession
    new = ["n_words", "n_hit", "spans", "items", "contaminated"]
    docs = docs.drop(*new)
    docs = docs.select(
        "*",
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<long>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    for k, block in enumerate(window_blocks(benchmark, window, block_windows)):
        if k:
            docs = cut_lineage(docs)
        docs = searched(spark, docs, block).select(
            *[c for c in docs.columns if c not in ("n_words", "spans", "items")],
            "__found.n_words",
            F.concat("spans", "__found.spans").alias("spans"),
            F.array_union("items", "__found.items").alias("items"),
        )
    hit = docs.withColumn("n_hit", union_length("spans"))
    return hit.select(
        *[c for c in docs.columns if c not in ("n_words", "spans", "items")],
        "n_words",
        "n_hit",
        F.array_sort("spans").alias("spans"),
        F.array_sort("items").alias("items"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def decontamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    return decontaminate(docs.select("doc_id", "text"), benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


ORACLE = r"""
WITH cut AS (
  SELECT 'i' AS side, item_id AS id, text FROM benchmark
  UNION ALL SELECT 'd', doc_id, text FROM documents
), listed AS (
  SELECT side, id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM cut
), windows AS (
  SELECT DISTINCT id AS item_id, words[s:s + 9] AS w
  FROM (SELECT id, words, unnest(range(1, greatest(1, len(words) - 9) + 1)) AS s
        FROM listed WHERE side = 'i' AND len(words) > 0)
), lengths AS (SELECT DISTINCT len(w) AS n FROM windows),
hits AS (
  SELECT p.id, p.s, p.n, windows.item_id
  FROM (SELECT id, n, words, unnest(range(1, len(words) - n + 2)) AS s
        FROM listed, lengths WHERE side = 'd' AND len(words) >= n) p
  JOIN windows ON windows.w = p.words[p.s:p.s + p.n - 1]
), covered AS (
  SELECT id, count(DISTINCT p) AS n_hit
  FROM (SELECT id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY id
), items AS (
  SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined
  FROM (SELECT DISTINCT id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY id
)
SELECT l.id AS doc_id, CAST(len(l.words) AS BIGINT) AS n_words,
       CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(joined, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM listed l LEFT JOIN covered USING (id) LEFT JOIN items USING (id)
WHERE l.side = 'd'
"""
