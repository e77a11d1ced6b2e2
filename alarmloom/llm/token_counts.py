"""Token counts by heap-and-linked-list byte-pair merging.

A text is cut where no piece of the vocabulary can reach across, and each segment is
merged on its own: a heap holds the adjacent pairs by rank and position, a linked list
holds the symbols, and the lowest pair is merged until none is left. The count is the
number of initial symbols less the merges; no identifier is made. A character that is
no piece counts as many symbols as it has UTF-8 bytes, and never merges.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows and rows
with a null id stay, one result each; other columns of the input are not read. A text
of any length is counted whole; its memory is a small multiple of its longest segment.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
KEPT_SEGMENTS = 1 << 20
KEPT_LENGTH = 64


class SegmentCounts(dict):
    """Token counts of segments, each merged when first asked for."""

    def __init__(self, ranks: dict[str, float]) -> None:
        super().__init__()
        self.ranks = ranks

    def __missing__(self, segment: str) -> int:
        count = merged_count(segment, self.ranks)
        if len(segment) <= KEPT_LENGTH:
            if len(self) >= KEPT_SEGMENTS:
                self.clear()
            self[segment] = count
        return count


def merged_count(segment: str, ranks: dict[str, float]) -> int:
    """Symbols left of a segment when its lowest-rank pairs have been merged."""
    n = len(segment)
    symbols = list(segment)
    count = n if segment.isascii() and all(c in ranks for c in symbols) else 0
    if not count:
        count = sum(1 if c in ranks else len(c.encode()) for c in symbols)
    if segment in ranks and n <= 2:
        return 1
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    rank_of = ranks.get
    heap = []
    for i in range(n - 1):
        pair = symbols[i] + symbols[i + 1]
        rank = rank_of(pair)
        if rank is not None:
            heap.append((rank, i, pair))
    heapq.heapify(heap)
    while heap:
        _, i, piece = heapq.heappop(heap)
        j = after[i]
        # an entry is stale once either side has been merged into something else
        if j >= n or not symbols[i] or symbols[i] + symbols[j] != piece:
            continue
        symbols[i], symbols[j] = piece, ""
        count -= 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            pair = piece + symbols[k]
            rank = rank_of(pair)
            if rank is not None:
                heapq.heappush(heap, (rank, i, pair))
        h = before[i]
        if h >= 0:
            pair = symbols[h] + piece
            rank = rank_of(pair)
            if rank is not None:
                heapq.heappush(heap, (rank, h, pair))
    return count


class PieceCounter:
    """Counts the pieces of a text; reads only pieces and ranks of the model file."""

    def __init__(self, model_path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_path)
        self.ranks = {
            model.id_to_piece(i): -model.get_score(i)
            for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        }
        for piece in self.ranks:
            if SPACE in piece.lstrip(SPACE) or (len(piece) > 1 and "\n" in piece):
                raise ValueError(f"piece {piece!r} reaches across a segment end")
        self.segments = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n").findall
        self.counts = SegmentCounts(self.ranks)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        marked = SPACE + text.replace(" ", SPACE)
        return sum(map(self.counts.__getitem__, self.segments(marked)))


@lru_cache(maxsize=1)
def counter(model_path: str) -> PieceCounter:
    return PieceCounter(model_path)


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of every document."""

    @F.pandas_udf("long")
    def n_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = counter(model_path).count
        for texts in batches:
            yield pd.Series([count(text) for text in texts], dtype="int64")

    counted = docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text").cast("long"), F.lit(0)).alias("n_bytes"),
        n_tokens("text").alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
