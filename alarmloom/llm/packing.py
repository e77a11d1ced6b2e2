"""Best-fit packing in bulk-synchronous steps.

Documents are tokenized and cut into pieces of at most one sequence. Pieces are sorted
by length, longest first, and packed a whole length at a time: one step takes all pieces
of a length, sweeps the gaps that can hold them from the smallest up (each piece goes to
the successor of its length among the gaps), settles which piece gets which gap by the
piece's rank within its length, updates the gaps, and goes on with the next length. What
fits nowhere opens new sequences. The result is that of best-fit decreasing.

Equal gaps stay together as runs of consecutive sequence numbers, so a step costs as
many operations as there are runs it touches, not pieces. A length makes at most two new
runs, and each use more than halves the gap of a run: with sequences of 2048 tokens the
plan of all steps has at most about 11 * 3 * 2048 rows whatever the number of documents.
That bound is what makes it safe to make the plan from the 2048 counts on the driver and
to broadcast it. The pieces themselves never leave the executors: their ranks come from
two counted levels (chunks of a length, rows of a chunk), so no length, however common,
is ranked by one task, and each finds its run in the sorted plan.

Defined results: a null or empty text is the end token alone; repeated rows are packed
each; a null doc_id is packed as any other; an empty table gives no rows; other columns
are not read. Pieces of the same length are ranked by a hash of (doc_id, piece).
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from bisect import insort
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alarmloom.llm.shared import bounded_batches, cut_lineage

KEPT_WORDS = 1 << 18
KEPT_LENGTH = 64
WORDS_AT_ONCE = 1 << 12
LEAST_CHUNK = 200
MOST_CHUNKS = 100_000

PIECES = "piece int, start long, length long, ids_crc32 long"


def views(array: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Where each element begins and, at last, ends, and the bytes they begin in."""
    if not len(array):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    return at - at[0], np.frombuffer(data or b"", np.uint8)[at[0] : at[-1]]


def binaries(offsets: np.ndarray, data: np.ndarray) -> pa.LargeBinaryArray:
    """The inverse of views."""
    buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, buffers)


# Fixed rule: the bytes that stand for themselves in byte-level vocabularies; the others
# are the characters from 256 on, in order.
SHOWN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]


class PartIds:
    """Merges many parts of words at once, in arrays.

    Parts of one length are the rows of a matrix of symbols.  A step merges the pair of
    lowest rank, the first of equals, in every row, so all rows lose one symbol and the
    matrix one column; rows without a pair that merges are done.
    """

    LONGEST = 32
    NO_PAIR = np.iinfo(np.int32).max

    def __init__(self, model: dict) -> None:
        vocabulary, ending = model["vocab"], model["end_of_word_suffix"] or ""
        others = iter(range(256, 512))
        signs = [chr(b if b in SHOWN_BYTES else next(others)) for b in range(256)]
        self.inner = np.array([vocabulary[c] for c in signs], np.int32)
        self.last = np.array([vocabulary[c + ending] for c in signs], np.int32)
        self.size = len(vocabulary)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocabulary[a] * self.size + vocabulary[b] for a, b in pairs], np.int64)
        self.merged = np.array([vocabulary[a + b] for a, b in pairs], np.int32)
        self.rank = np.argsort(keys).astype(np.int32)
        self.keys = keys[self.rank]
        # the ranks that parts begin with: of two bytes, the second within or at the end
        one = np.repeat(self.inner, 256)
        self.first = self.ranks(one, np.tile(self.inner, 256))
        self.ending = self.ranks(one, np.tile(self.last, 256))

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, NO_PAIR where it does not merge."""
        wanted = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == wanted, self.rank[at], self.NO_PAIR)

    def ids_of(
        self, offsets: np.ndarray, data: np.ndarray
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Numbers of parts and their ids, a row each, of parts of 1 to LONGEST bytes."""
        lengths = np.diff(offsets)
        for length in range(1, self.LONGEST + 1):
            some = np.flatnonzero(lengths == length)
            if not len(some):
                continue
            codes = data[offsets[some][:, None] + np.arange(length)]
            symbols = self.inner[codes]
            symbols[:, -1] = self.last[codes[:, -1]]
            pairs = codes[:, :-1].astype(np.int32) << 8 | codes[:, 1:]
            ranks = self.first[pairs]
            ranks[:, -1:] = self.ending[pairs[:, -1:]]
            for rows, ids in self.steps(symbols, ranks):
                yield some[rows], ids

    def steps(
        self, symbols: np.ndarray, ranks: np.ndarray
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Numbers of rows that are done and their symbols; ranks are those of the pairs."""
        rows = np.arange(len(symbols))
        while ranks.shape[1] and len(rows):
            at = ranks.argmin(1)
            best = ranks[np.arange(len(rows)), at]
            done = best == self.NO_PAIR
            if done.any():
                yield rows[done], symbols[done]
                rows, symbols, ranks, at, best = (
                    a[~done] for a in (rows, symbols, ranks, at, best)
                )
            n, width = symbols.shape
            here = np.arange(n)
            symbols[here, at + 1] = self.merged[best]
            columns = np.arange(width)
            # the merged symbol takes the place of its right one
            symbols = symbols[columns != at[:, None]].reshape(n, width - 1)
            ranks = ranks[columns[:-1] != at[:, None]].reshape(n, width - 2)
            for side, near in ((at - 1, at > 0), (at, at < width - 2)):
                i, j = here[near], side[near]
                ranks[i, j] = self.ranks(symbols[i, j], symbols[i, j + 1])
        if len(rows):
            yield rows, symbols


class WordIds:
    """The ids of texts, each distinct word of them at a time, in arrays.

    The vocabulary's white space only parts words, so the ids of a text are those of its
    words, which recur. Within a word letters, digits and other signs are tokenized apart:
    distinct words are cut into parts, and the distinct parts that are not known are
    merged. That holds for the characters that lower-casing and normal form change one by
    one; other words, and those with the vocabulary's special strings, go to the library.

    What was met of late is kept: at most KEPT_WORDS parts of at most KEPT_LENGTH bytes.
    """

    LETTER, DIGIT, SIGN = 1, 2, 3

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        plain = "\t\n\r -~¡-¬®-įı-ſ"
        # lower-casing may make a special string out of another
        special = "|".join(map(re.escape, specials))
        self.other = f"[^{plain}]|(?i:{special})"
        self.parts = PartIds(json.loads(self.tokenizer.to_str())["model"])
        self.known = self.known_ids = pa.array([], pa.large_binary())
        # by a character's first two bytes; those of one byte count with any second
        self.kinds = np.zeros((256, 256), np.uint8)
        for char in map(chr, range(0x180)):
            kind = {"L": self.LETTER, "N": self.DIGIT}.get(unicodedata.category(char)[0], self.SIGN)
            code = char.encode()
            self.kinds[code[0], slice(None) if len(code) == 1 else code[1]] = kind

    def part_starts(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Where the parts of words begin, by the vocabulary's own pattern:

        's|'t|'re|'ve|'m|'ll|'d, else letters, one digit, or other signs.
        """
        n = len(data)
        data = np.concatenate([data, np.zeros(3, np.uint8)])
        word = np.zeros(n + 3, bool)
        word[offsets] = True
        kinds = self.kinds[data[:-1], data[1:]]
        second = np.flatnonzero(data & 0xC0 == 0x80)
        kinds[second] = kinds[second - 1]
        start = word.copy()
        start[1:-1] |= (kinds[1:] != kinds[:-1]) | (kinds[1:] == self.DIGIT)
        start[second] = False
        quote = np.flatnonzero((data[:n] == ord("'")) & start[:n])
        quote = quote[~word[quote + 1]]
        one, two = data[quote + 1], data[quote + 2]
        short = np.isin(one, [*b"stmd"])
        long = ((one == ord("l")) & (two == ord("l"))) | (
            np.isin(one, [*b"rv"]) & (two == ord("e"))
        )
        long &= ~word[quote + 2]
        start[quote[short | long] + 1] = False
        start[quote[short] + 2] = True
        start[quote[long] + 3] = True
        return np.flatnonzero(start[:n])

    def merged(self, parts: pa.LargeBinaryArray) -> pa.LargeBinaryArray:
        """Ids of parts; the library is asked for long ones only."""
        offsets, data = views(parts)
        found = list(self.parts.ids_of(offsets, data))
        for row in np.flatnonzero(np.diff(offsets) > PartIds.LONGEST):
            _, ids = views(self.library_ids([parts[row].as_py().decode()]))
            found.append((np.array([row]), ids.view("<u4")[None]))
        ends = np.zeros(len(parts) + 1, np.int64)
        for rows, ids in found:
            ends[rows + 1] = ids.shape[1]
        ends = ends.cumsum()
        flat = np.empty(ends[-1], "<u4")
        for rows, ids in found:
            flat[ends[rows][:, None] + np.arange(ids.shape[1])] = ids
        return binaries(4 * ends, flat)

    def part_ids(self, parts: pa.LargeBinaryArray) -> pa.LargeBinaryArray:
        """The same, by those known; parts are distinct."""
        at = pc.index_in(parts, value_set=self.known)
        new = parts.filter(at.is_null())
        known = pa.concat_arrays([self.known, new])
        ids = pa.concat_arrays([self.known_ids, self.merged(new)])
        places = at.fill_null(-1).to_numpy().copy()
        places[places < 0] = np.arange(len(self.known), len(known))
        found = ids.take(pa.array(places))
        if len(known) > KEPT_WORDS:
            known, ids = parts.slice(0, KEPT_WORDS), found.slice(0, KEPT_WORDS)
        short = pc.less_equal(pc.binary_length(known), KEPT_LENGTH)
        self.known, self.known_ids = known.filter(short), ids.filter(short)
        return found

    def library_ids(self, words: list[str]) -> pa.LargeBinaryArray:
        """Ids of words as the library gives them."""
        ids, counts = [], np.zeros(len(words) + 1, np.int64)
        for at in range(0, len(words), WORDS_AT_ONCE):
            coded = self.tokenizer.encode(
                words[at : at + WORDS_AT_ONCE], is_pretokenized=True, add_special_tokens=False
            )
            ids.append(np.array(coded.ids, "<u4"))
            np.add.at(counts, np.array(coded.word_ids, np.int64) + at + 1, 1)
        return binaries(4 * counts.cumsum(), np.concatenate(ids or [np.zeros(0, "<u4")]))

    def plain_ids(self, words: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """Ids of lower-case words of the characters that are not left to the library."""
        offsets, data = views(words)
        starts = self.part_starts(offsets, data)
        parts = binaries(np.append(starts, len(data)), data).dictionary_encode()
        ends, ids = views(self.part_ids(parts.dictionary).take(parts.indices))
        # a word has the ids from its first part on, up to the next word's
        return binaries(ends[np.searchsorted(starts, offsets)], ids)

    def word_ids(self, words: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """Ids of distinct words."""
        other = pc.match_substring_regex(words, self.other)
        plain = self.plain_ids(pc.utf8_lower(words.filter(pc.invert(other))))
        others = self.library_ids(words.filter(other).to_pylist())
        # back to their order: sorting is stable
        places = np.argsort(other.to_numpy(zero_copy_only=False), kind="stable").argsort()
        return pa.concat_arrays([plain, others]).take(pa.array(places))

    def ids_of(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian ids of each text."""
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        words = split.flatten().dictionary_encode()
        ends, ids = views(self.word_ids(words.dictionary).take(words.indices))
        lengths = pc.list_value_length(split).to_numpy()
        bounds = ends[np.append(0, lengths.cumsum(dtype=np.int64))]
        for start, end in pairwise(bounds.tolist()):
            yield ids[start:end].tobytes()


def cut(ids: bytes, capacity: int) -> list[dict]:
    """Pieces of a document's ids, the end token included."""
    ids += b"\0\0\0\0"
    step = 4 * capacity
    return [
        {
            "piece": i,
            "start": at // 4,
            "length": len(ids[at : at + step]) // 4,
            "ids_crc32": zlib.crc32(ids[at : at + step]),
        }
        for i, at in enumerate(range(0, len(ids), step))
    ]


def tokenized(docs: DataFrame, vocabulary: str, capacity: int) -> DataFrame:
    """doc_id and its pieces."""

    @F.pandas_udf(f"array<struct<{PIECES.replace(' ', ':')}>>".replace(",:", ","))
    def pieces(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        # goes with the task: a worker that waits for the next holds neither words nor file
        words = WordIds(vocabulary)
        for texts in batches:
            ids_of = words.ids_of([text or "" for text in texts])
            yield pd.Series([cut(ids, capacity) for ids in ids_of])
        del words
        pa.default_memory_pool().release_unused()

    found = docs.select("doc_id", pieces("text").alias("pieces"))
    return found.select("doc_id", F.inline("pieces"))


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Where pieces go: (length, first rank, first sequence, slots, offset).

    From its first rank on, up to the next row of the length, a row's pieces fill the
    sequences from its first one, so many slots each, from the offset on.
    """
    rows = []
    runs: list[tuple[int, int, int]] = []  # (gap, first sequence, sequences), sorted
    opened = 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        changed: list[tuple[int, int, int]] = []
        at = next((i for i, run in enumerate(runs) if run[0] >= length), len(runs))
        end = at
        while left:
            if end < len(runs):
                gap, first, n = runs[end]
                end += 1
            else:
                gap, first = capacity, opened
                n = -(-left // (capacity // length))
                opened += n
            slots = gap // length
            taken = min(left, n * slots)
            rows.append((length, rank, first, slots, capacity - gap))
            full, rest = divmod(taken, slots)
            if full:
                changed.append((gap - slots * length, first, full))
            if rest:
                changed.append((gap - rest * length, first + full, 1))
            untouched = n - full - bool(rest)
            if untouched:
                changed.append((gap, first + n - untouched, untouched))
            rank, left = rank + taken, left - taken
        del runs[at:end]
        for run in changed:
            if run[0]:
                insort(runs, run)
    return rows


def ranked(pieces: DataFrame, counts: dict[int, int]) -> DataFrame:
    """pieces with rank, from 0, within their length."""
    spark = pieces.sparkSession
    rows = max(LEAST_CHUNK, -(-sum(counts.values()) // MOST_CHUNKS))
    sizes = spark.createDataFrame(
        [(k, -(-n // rows)) for k, n in counts.items()], "length long, chunks long"
    )
    # as many rows as there are lengths, at most the capacity
    chunked = pieces.join(F.broadcast(sizes), "length").withColumn(
        "chunk", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("chunks"))
    )
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        chunked.groupBy("length", "chunk")
        .count()
        .select(
            "length",
            "chunk",
            F.coalesce(F.sum("count").over(before), F.lit(0)).alias("ahead"),
        )
    )
    within = Window.partitionBy("length", "chunk").orderBy(
        "doc_id", "piece", "ids_crc32"
    )
    placed = chunked.withColumn("place", F.row_number().over(within) - 1)
    return placed.join(offsets, ["length", "chunk"]).select(
        *pieces.columns, (F.col("ahead") + F.col("place")).alias("rank")
    )


def best_fit_packing(
    docs: DataFrame, vocabulary: str, capacity: int = 2048
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset."""
    spark = docs.sparkSession
    bounded_batches(spark)
    pieces = cut_lineage(tokenized(docs.select("doc_id", "text"), vocabulary, capacity))
    counts = {row.length: row["count"] for row in pieces.groupBy("length").count().collect()}
    # the plan's size is bounded by the capacity (see above)
    shipped = spark.sparkContext.broadcast(plan_arrays(plan(counts, capacity)))

    @F.pandas_udf("sequence_id long, offset long")
    def located(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        starts, by_length = shipped.value
        length, rank = lengths.to_numpy(np.int64), ranks.to_numpy(np.int64)
        # runs are sorted by (length, first rank): places in both at once
        at = np.searchsorted(starts, run_key(length, rank), side="right") - 1
        first, sequence, slots, offset = by_length[at].T
        place = rank - first
        return pd.DataFrame(
            {
                "sequence_id": sequence + place // slots,
                "offset": offset + place % slots * length,
            }
        )

    found = ranked(pieces, counts).withColumn("at", located("length", "rank"))
    return found.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        "at.sequence_id",
        "at.offset",
    )


RANK_BITS = 48


def run_key(length: np.ndarray, rank: np.ndarray) -> np.ndarray:
    return length << RANK_BITS | rank


def plan_arrays(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """The plan sorted by length and first rank, and the keys to search it by."""
    table = np.array(rows, np.int64).reshape(-1, 5)
    keys = run_key(table[:, 0], table[:, 1])
    order = np.argsort(keys)
    return keys[order], table[order, 1:]
