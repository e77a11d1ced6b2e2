"""N-gram Jaccard join by a blocked sparse product of documents by n-grams.

A document is a row of a sparse incidence matrix with a column per word n-gram. The
overlap of two documents is an entry of the matrix times its transpose; only entries
that reach the threshold matter, so only part of the product is formed:

* Columns are ordered, rare n-grams first. Two linked documents overlap so much that
  they share a column among the first n - ceil(t * n) + 1 of either (n its size); the
  product is taken over those leading columns only.
* The product accumulates the overlap of a pair over the leading columns. What the
  trailing columns can add is bounded by the sizes; pairs that cannot reach the needed
  overlap, or whose sizes differ too much, are discarded. The rest are compared whole.
* A column is first multiplied with one document only, the most central one: that whose
  rarest column is the most frequent. In a group of near copies that is the text with
  the fewest edits, which is closest to all others. Documents that prove linked to the
  same one need no further comparison with each other, so a group of copies costs as
  many comparisons as it has members.
* Columns that still hold documents of several groups make a sparse matrix, which is
  multiplied in blocks: the columns of one central document, whose overlaps mostly meet
  there, by halves of some BLOCK entries. A task gets the entries of whole blocks, adds up
  overlaps in arrays, and only pairs that the bounds leave go on: what other blocks can
  add is bounded by the entries that the documents have there. So no link between groups
  is lost, and pairs that fall short never become rows.

Which columns count as frequent is estimated, and only orders them: any order gives the
same links. At most FREQUENT columns can reach the least count for the list, so that
what is broadcast is bounded. Documents reach workers as sorted arrays of 57-bit hashes.

Defined results: a null or empty text, or one without words, has no shingles and is
linked with nothing; fewer words than n are one shingle. Rows that repeat a doc_id are
one document with several texts, linked where any text is; each row has its own size. A
null doc_id has a null component. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alarmloom.llm.shared import bounded_batches, cut_lineage, written

WORDS = 5
PERCENT = 80
HASH_BITS = 57
FREQUENT = 1 << 20
LEAST_FREQUENT = 6
COUNTED_TOGETHER = 2_000_000
BLOCK = 100_000
AT_ONCE = 200_000
BITMAP_BITS = 1 << 25
BITMAP_ROW_BITS = 1 << 15

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of a text's word n-grams."""
    import xxhash

    found = (text or "").encode().translate(LOWER).split()
    if not found:
        return np.zeros(0, np.int64)
    if len(found) < words:
        digest = xxhash.xxh3_64_intdigest(b" ".join(found), seed=len(found))
        return np.array([digest >> (64 - HASH_BITS)], np.int64)
    hashed = np.fromiter(
        map(xxhash.xxh3_64_intdigest, found), np.uint64, count=len(found)
    )
    n = len(found) - words + 1
    mixed = np.zeros(n, np.uint64)
    for k in range(words):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed += hashed[k : k + n]
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    mixed ^= mixed >> np.uint64(30)
    return np.unique(mixed >> np.uint64(64 - HASH_BITS)).view(np.int64)


def needed(n: Column, other: Column, percent: int) -> Column:
    """Overlap from which two sets of these sizes are linked."""
    return F.ceil((n + other) * percent / (100 + percent) - 1e-9)


def leading(n: int, percent: int) -> int:
    return n + percent * n // -100 + 1


def batches_of_sets(
    batches: Iterator[pa.RecordBatch], words: int
) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Batches with their texts' sets, few texts at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            yield part, [shingles(t.as_py(), words) for t in part.column("text")]


def whole_sets(docs: DataFrame, words: int) -> DataFrame:
    """doc and the sorted hashes (as bytes) of every row with an id and a word."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in batches_of_sets(batches, words):
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc").cast(pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                ["doc", "hashes"],
            )

    found = docs.select("doc", "text").mapInArrow(rows, "doc long, hashes binary")
    return found.where(F.octet_length("hashes") > 0)


def frequent_columns(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) of frequent n-grams, and the level (log2 count) of each.

    Counts are summed over what is repeated within a part of a task, so they are
    estimates from below.  The list starts at the lowest level from which on there are
    no more than FREQUENT of them.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def repeated() -> pa.RecordBatch:
            values, n = np.unique(np.concatenate(held), return_counts=True)
            many = n > 1
            columns = [pa.array(values[many]), pa.array(n[many])]
            return pa.RecordBatch.from_arrays(columns, ["hash", "n"])

        for _, sets in batches_of_sets(batches, words):
            held += sets
            size += sum(map(len, sets))
            if size >= COUNTED_TOGETHER:
                yield repeated()
                held, size = [], 0
        if held:
            yield repeated()

    found = cut_lineage(
        docs.select("text")
        .mapInArrow(counted, "hash long, n long")
        .groupBy("hash")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= LEAST_FREQUENT)
        .select("hash", F.floor(F.log2("n")).cast("int").alias("level"))
    )
    levels = {r.level: r["count"] for r in found.groupBy("level").count().collect()}
    least, room = 64, FREQUENT
    for level in sorted(levels, reverse=True):
        room -= levels[level]
        if room < 0:
            break
        least = level
    listed = found.where(F.col("level") >= least).toPandas().sort_values("hash")
    return listed["hash"].to_numpy(np.int64), listed["level"].to_numpy(np.int64)


def leading_columns(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc, n, last, cols: the leading columns of every row, in order.

    A column is its place in the order: its level, then its hash.  last is the last
    leading one.
    """
    frequent_ones = frequent_columns(docs, words)
    shipped = docs.sparkSession.sparkContext.broadcast(frequent_ones)

    def ordered(hashes: np.ndarray) -> np.ndarray:
        frequent, levels = shipped.value
        if not len(frequent):
            return hashes
        at = np.searchsorted(frequent, hashes)
        at[at == len(frequent)] = 0
        level = np.where(frequent[at] == hashes, levels[at], 0)
        return np.sort(hashes | level << HASH_BITS)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in batches_of_sets(batches, words):
            sizes = [len(s) for s in sets]
            cols = [
                ordered(s)[: leading(n, percent)] if n else s
                for s, n in zip(sets, sizes)
            ]
            ends = np.cumsum([0] + [len(c) for c in cols])
            flat = np.concatenate(cols) if cols else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc").cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array([int(c[-1]) if len(c) else None for c in cols], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                ],
                ["doc", "n", "last", "cols"],
            )

    return docs.mapInArrow(rows, "doc long, n long, last long, cols array<long>")


def shared_columns(leading_sets: DataFrame) -> DataFrame:
    """col, doc, n, last, top: entries of the columns that several documents hold.

    top is the first column of the column's most central document.
    """
    known = leading_sets.where("doc IS NOT NULL AND n > 0")
    head = F.element_at("cols", 1).alias("head")
    shared = (
        known.select("doc", head, F.explode("cols").alias("col"))
        .groupBy("col")
        .agg(
            F.min("doc").alias("least"),
            F.max("doc").alias("most"),
            F.max("head").alias("top"),
        )
        .where("least < most")
        .select("col", "top")
    )
    # as a table of its own, so that a column with very many entries can be split
    shared = written(shared)
    entries = known.select("doc", "n", "last", F.explode("cols").alias("col"))
    return entries.join(shared, "col")


def centers(leading_sets: DataFrame) -> DataFrame:
    """top, a, n_a, last_a: the document that a first column stands for.

    Of several (copies, mostly) that with the smallest id.
    """
    known = leading_sets.where("doc IS NOT NULL AND n > 0")
    facts = known.select(
        F.element_at("cols", 1).alias("top"),
        F.col("doc").alias("a"),
        F.col("n").alias("n_a"),
        F.col("last").alias("last_a"),
    )
    smallest = facts.groupBy("top").agg(F.min("a").alias("a"))
    return facts.distinct().join(smallest, ["top", "a"])


def promising(summed: DataFrame, percent: int) -> DataFrame:
    """(a, b) of pairs whose accumulated overlap can still reach what is needed.

    summed: a, b, their n and last, and the overlap over leading columns. Beyond the
    lower of the two last places, the overlap is at most what that document has left.
    """
    n_a, n_b = F.col("n_a"), F.col("n_b")
    n = F.when(F.col("last_a") <= F.col("last_b"), n_a).otherwise(n_b)
    rest = F.ceil(n * percent / 100 - 1e-9) - 1
    enough = F.col("overlap") + rest >= needed(n_a, n_b, percent)
    return summed.where(enough).select("a", "b").distinct()


def similar_sizes(n: Column, other: Column, percent: int) -> Column:
    return (n * 100 >= other * percent) & (other * 100 >= n * percent)


def bitmap_of(ids: DataFrame) -> np.ndarray:
    """Which of BITMAP_BITS hash places the ids take; its size does not depend on them."""
    place = F.pmod(F.xxhash64("id"), F.lit(BITMAP_BITS))
    rows = (
        ids.select(place.alias("p"))
        .groupBy(F.floor(F.col("p") / BITMAP_ROW_BITS).alias("row"))
        .agg(F.expr(f"bitmap_construct_agg(p % {BITMAP_ROW_BITS})").alias("bits"))
        .collect()
    )
    out = np.zeros(BITMAP_BITS // 8, np.uint8)
    step = BITMAP_ROW_BITS // 8
    for row in rows:
        out[row.row * step : (row.row + 1) * step] = np.frombuffer(row.bits, np.uint8)
    return out


def linked(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough.

    Only documents that some pair may need are cut into n-grams again and shuffled; a
    bitmap of fixed size tells which.
    """
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b"))
    shipped = docs.sparkSession.sparkContext.broadcast(bitmap_of(ids))
    place = F.pmod(F.xxhash64("doc"), F.lit(BITMAP_BITS))

    @F.pandas_udf("boolean")
    def met(places: pd.Series) -> pd.Series:
        p = places.to_numpy(np.int64)
        return pd.Series((shipped.value[p >> 3] >> (p & 7) & 1).astype(bool))

    some = whole_sets(docs.where("doc IS NOT NULL").where(met(place)), words)

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                left = np.frombuffer(x.as_py(), np.int64)
                right = np.frombuffer(y.as_py(), np.int64)
                if len(left) > len(right):
                    left, right = right, left
                at = np.searchsorted(right, left)
                at[at == len(right)] = 0
                both = int((right[at] == left).sum())
                union = len(left) + len(right) - both
                keep.append(100 * both >= percent * union)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    of_a = some.select(F.col("doc").alias("a"), F.col("hashes").alias("x"))
    of_b = some.select(F.col("doc").alias("b"), F.col("hashes").alias("y"))
    return (
        pairs.join(of_b, "b")
        .join(of_a, "a")
        .select("a", "b", "x", "y")
        .mapInArrow(verified, "a long, b long")
        .distinct()
    )


def pairs_with_centers(
    entries: DataFrame, centers_: DataFrame, percent: int
) -> DataFrame:
    """Pairs worth comparing of documents and the central documents of their columns."""
    counted = entries.groupBy("top", "doc", "n", "last").agg(
        F.count("*").alias("overlap")
    )
    # a document whose id has several texts meets each of them
    pairs = counted.join(centers_, "top").where(
        (F.col("doc") != F.col("a"))
        & similar_sizes(F.col("n"), F.col("n_a"), percent)
    )
    rows = pairs.select(
        "a",
        F.col("doc").alias("b"),
        "n_a",
        F.col("n").alias("n_b"),
        "last_a",
        F.col("last").alias("last_b"),
        "overlap",
    )
    return promising(rows, percent)


def open_entries(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """Entries of columns that documents of several groups (doc, label) hold."""
    labelled = entries.join(groups, "doc", "left").withColumn(
        "label", F.coalesce("label", "doc")
    )
    mixed = (
        labelled.groupBy("col")
        .agg(F.min("label").alias("least"), F.max("label").alias("most"))
        .where("least < most")
        .select("col")
    )
    # a table of its own, so that a column with very many entries can be split
    return written(labelled.join(written(mixed), "col"))


def blocks_of(entries: DataFrame, room: int) -> DataFrame:
    """Entries dealt to the blocks of the product: (top, low, high), and their own block.

    The columns of one top are a block, its documents halves of about room entries; each
    half meets itself and the others. open is the number of a document's entries.
    """
    # a table of its own, so that the entries of one top can be split
    halves = written(
        entries.groupBy("top").agg(F.ceil(F.count("*") / room).cast("int").alias("halves"))
    )
    sizes = entries.groupBy("doc", "n", "last").agg(F.count("*").alias("open"))
    mine, other = F.col("half"), F.col("other")
    return (
        entries.join(sizes, ["doc", "n", "last"])
        .join(halves, "top")
        .withColumn("half", F.pmod(F.xxhash64("doc"), F.col("halves")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("halves") - 1)))
        .select(
            "top",
            F.least(mine, other).alias("low"),
            F.greatest(mine, other).alias("high"),
            "half",
            "col",
            "label",
            "doc",
            "n",
            "last",
            "open",
        )
    )


def codes(*columns: np.ndarray) -> np.ndarray:
    """Numbers from 0 of the distinct rows that the columns make, in their order."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    for column in columns:
        new[1:] |= column[order[1:]] != column[order[:-1]]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def summed_up(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(at, n, len(distinct)).astype(np.int64)


def overlaps(
    rows: np.ndarray, begin: np.ndarray, end: np.ndarray, others: np.ndarray, room: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The sparse product: (row, other row, overlap), few rows at a time.

    rows are the rows of entries, in order; an entry's column holds others[begin:end].
    No more than room entries (or one column's) are multiplied out at once.
    """
    width = int(others.max(initial=-1)) + 1
    ends = np.cumsum(end - begin)
    last_of_row = np.append(rows[1:] != rows[:-1], True) if len(rows) else rows
    at, kept, counts = 0, np.zeros(0, np.int64), np.zeros(0, np.int64)
    while at < len(rows):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + room, "right")))
        n = (end - begin)[at:to]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        other = others[np.repeat(begin[at:to], n) + place]
        keys, sums = np.unique(np.repeat(rows[at:to], n) * width + other, return_counts=True)
        kept, counts = summed_up(np.append(kept, keys), np.append(counts, sums))
        # overlaps of a row whose entries go on are not complete
        done = len(kept)
        if not last_of_row[to - 1]:
            done = int(np.searchsorted(kept, rows[to - 1] * width))
        yield kept[:done] // width, kept[:done] % width, counts[:done]
        kept, counts, at = kept[done:], counts[done:], to


def product(blocks: dict[str, np.ndarray], percent: int, room: int) -> Iterator[pa.RecordBatch]:
    """Pairs of documents of different labels that the blocks do not rule out.

    What the columns of other blocks can add to a pair is bounded by the fewer entries
    that either document has there, what the trailing columns can add as in promising.
    """
    task = codes(blocks["top"], blocks["low"], blocks["high"])
    label = codes(blocks["label"])
    row = codes(task, blocks["doc"], blocks["n"], blocks["last"])
    # a column of a block, then the label: entries to multiply with are ranges
    labels = int(label.max()) + 1
    column = codes(task, blocks["col"])
    place = column * labels + label

    _, first, inside = np.unique(row, return_index=True, return_counts=True)
    doc, n, last = (blocks[name][first] for name in ("doc", "n", "last"))
    outside = blocks["open"][first] - inside
    alone = blocks["low"] == blocks["high"]
    right = np.flatnonzero(blocks["half"] == blocks["high"])
    right = right[np.argsort(place[right], kind="stable")]
    left = np.flatnonzero(blocks["half"] == blocks["low"])
    left = left[np.argsort(row[left], kind="stable")]
    others, sorted_place = row[right], place[right]

    after = np.searchsorted(sorted_place, place[left], "right")
    end = np.searchsorted(sorted_place, (column[left] + 1) * labels)
    begin = np.searchsorted(sorted_place, column[left] * labels)
    before = np.searchsorted(sorted_place, place[left])
    # within a half, each two labels meet once
    before = np.where(alone[left], begin, before)

    # both ranges of an entry, one after the other
    both = np.stack([begin, after], 1).ravel(), np.stack([before, end], 1).ravel()
    some = both[0] < both[1]
    rows_of = np.repeat(row[left], 2)[some]
    for x, y, overlap in overlaps(rows_of, both[0][some], both[1][some], others, room):
        n_x, n_y = n[x], n[y]
        least = -(-(n_x + n_y) * percent // (100 + percent))
        rest = -(-np.where(last[x] <= last[y], n_x, n_y) * percent // 100) - 1
        most = overlap + np.minimum(outside[x], outside[y]) + rest
        keep = (most >= least) & (n_x * 100 >= n_y * percent) & (n_y * 100 >= n_x * percent)
        x, y, overlap = x[keep], y[keep], overlap[keep]
        swap = doc[x] > doc[y]
        x, y = np.where(swap, y, x), np.where(swap, x, y)
        found = [doc[x], doc[y], n[x], n[y], last[x], last[y], overlap]
        yield pa.RecordBatch.from_arrays([pa.array(f) for f in found], PAIRS)


PAIRS = ["a", "b", "n_a", "n_b", "last_a", "last_b", "overlap"]


def pairs_between_groups(
    entries: DataFrame, groups: DataFrame, percent: int, room: int
) -> DataFrame:
    """Pairs worth comparing of documents of different groups (doc, label).

    A linked pair is ruled out by none of the blocks in which it meets, so its overlap
    is whole when summed over them.
    """
    blocks = blocks_of(open_entries(entries, groups), room)
    keys = ["top", "low", "high"]
    spread = blocks.repartition(*keys).sortWithinPartitions(*keys)

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in whole_blocks(batches, keys, room):
            yield from product(whole, percent, AT_ONCE)

    pairs = spread.mapInArrow(multiplied, ", ".join(f"{name} long" for name in PAIRS))
    summed = pairs.groupBy(*PAIRS[:-1]).agg(F.sum("overlap").alias("overlap"))
    return promising(summed, percent)


def whole_blocks(
    batches: Iterator[pa.RecordBatch], keys: list[str], room: int
) -> Iterator[dict[str, np.ndarray]]:
    """Sorted rows as arrays by column, room of them or more, never part of a block."""
    held: list[pa.RecordBatch] = []

    def arrays() -> dict[str, np.ndarray]:
        table = pa.Table.from_batches(held)
        return {name: table.column(name).to_numpy() for name in table.column_names}

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < room:
            continue
        rows = arrays()
        block = codes(*[rows[key] for key in keys])
        cut = int(np.searchsorted(block, block[-1]))
        if cut:
            yield {name: values[:cut] for name, values in rows.items()}
            held = pa.Table.from_batches(held).slice(cut).to_batches()
    if sum(b.num_rows for b in held):
        yield arrays()


def components(edges: DataFrame) -> DataFrame:
    """doc, component (smallest id reachable) of every document that has a link."""
    both = cut_lineage(
        edges.select("a", "b").union(edges.select("b", "a")).distinct()
    )
    labels = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label"))
    labels = cut_lineage(labels.withColumnRenamed("a", "doc"))
    while True:
        near = (
            both.join(labels.withColumnRenamed("doc", "b"), "b")
            .groupBy("a")
            .agg(F.min("label").alias("met"))
            .withColumnRenamed("a", "doc")
        )
        lower = labels.join(near, "doc").select(
            "doc", F.col("label").alias("old"), F.least("label", "met").alias("label")
        )
        # the label's own label is reachable too: halves the steps along a chain
        further = labels.select(
            F.col("doc").alias("label"), F.col("label").alias("beyond")
        )
        moved = cut_lineage(
            lower.join(further, "label", "left").select(
                "doc", "old", F.least("label", F.coalesce("beyond", "label")).alias("label")
            )
        )
        labels = moved.select("doc", "label")
        if not moved.where("old <> label").limit(1).count():
            return labels.withColumnRenamed("label", "component")


def ngram_join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of docs (doc_id, text)."""
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), "text")
    leading_sets = written(leading_columns(texts, words, percent))
    entries = written(shared_columns(leading_sets))
    pairs = cut_lineage(pairs_with_centers(entries, centers(leading_sets), percent))
    first_links = cut_lineage(linked(pairs, texts, words, percent))
    groups = components(first_links).withColumnRenamed("component", "label")
    pairs = cut_lineage(pairs_between_groups(entries, groups, percent, BLOCK))
    more_links = linked(pairs, texts, words, percent)
    found = components(first_links.union(more_links))
    return (
        leading_sets.select("doc", "n")
        .join(found, "doc", "left")
        .select(
            F.col("doc").alias("doc_id"),
            F.col("n").alias("n_shingles"),
            F.coalesce("component", "doc").alias("component_id"),
        )
    )


def join_sql(words: int, percent: int) -> str:
    """The same result as DuckDB SQL over documents."""
    return rf"""
WITH listed AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT DISTINCT doc_id, w[s:s + {words - 1}] AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - {words - 1}) + 1)) AS s
        FROM listed WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM sets x JOIN sets y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common o JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * o.n >= {percent} * (p.n + q.n - o.n)
), reached AS (
  WITH RECURSIVE r(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT r.doc_id, e.b FROM r JOIN
      (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) e ON e.a = r.other
  ) SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN reached USING (doc_id)
"""
