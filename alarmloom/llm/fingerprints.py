"""Document fingerprints by one-permutation MinHash, in SQL functions only.

Every five-word shingle of a lower-cased text is hashed once. The hash's upper bits name
one of 256 bins, and each bin keeps its smallest hash. A bin that no shingle fell into
takes the value of another bin, found by optimal densification: the bin's own fixed
sequence of random bins is probed until one has a value, the same way in every document.
Of each bin the lowest eight bits are kept and packed; as two different values agree in
eight bits once in 256 times, the share of agreeing bins is corrected by that chance.

Densification probes PROBES bins one after the other; the few bins that are still empty
take the value whose bin comes first in a random order of their own, which is what
further probing would find.

Defined results: a null text counts as empty; a text without words has the fingerprint
"" and is like another wordless text only (1, else 0); fewer than five words are one
shingle. Repeated rows stay and are ordered by id, then text; a null id is the smallest.
After the last document comes the first; a single document is followed by itself.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE = 5
BINS = 256
PROBES = 12
PAYLOAD = 48
FULL = (1 << PAYLOAD) - 1
PER_LONG = 8
BUCKET_BYTES = 4 << 20
MOST_BUCKETS = 10_000
SEARCH_STEP = 64
LONG_MIN = -(1 << 63)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def at(array: Column, index: Column | int) -> Column:
    return F.get(array, F.lit(index) if isinstance(index, int) else index)


def shingle_hashes(words: Column) -> Column:
    def of(hashed: Column) -> Column:
        last = F.size(hashed) - SHINGLE
        return F.when(
            last >= 0,
            F.transform(
                F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                lambda i: F.xxhash64(*[at(hashed, i + k) for k in range(SHINGLE)]),
            ),
        ).otherwise(F.array(F.xxhash64(hashed)))

    return let(F.transform(words, lambda word: F.xxhash64(word)), of)


def bin_minima(hashes: Column) -> Column:
    """The smallest hash of each bin in bin order, null for an empty bin."""
    placed = F.transform(hashes, lambda h: F.shiftrightunsigned(h, 64 - PAYLOAD - 8))
    ends = F.array(*[F.lit((j << PAYLOAD) | FULL) for j in range(BINS)])

    def firsts(ordered: Column) -> Column:
        # the end of each bin keeps the bin in the list even if nothing fell into it
        kept = F.filter(
            ordered,
            lambda x, i: (i == 0)
            | (F.shiftright(x, PAYLOAD) != F.shiftright(at(ordered, i - 1), PAYLOAD)),
        )
        return F.transform(
            kept, lambda x: F.when(x.bitwiseAND(FULL) != FULL, x.bitwiseAND(FULL))
        )

    return let(F.sort_array(F.concat(placed, ends)), firsts)


def densified(minima: Column) -> Column:
    """Empty bins filled from others; an array without null."""

    def of(bins: Column) -> Column:
        def order(j: Column) -> Column:
            held = F.filter(
                F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: at(bins, i).isNotNull()
            )
            ranked = F.transform(
                held, lambda i: F.struct(F.xxhash64(i, j, F.lit("rest")), at(bins, i))
            )
            return F.array_min(ranked)["col2"]

        return F.transform(
            bins,
            lambda x, j: F.coalesce(
                x,
                *[
                    at(bins, F.pmod(F.xxhash64(j, F.lit(t)), F.lit(BINS)).cast("int"))
                    for t in range(PROBES)
                ],
                order(j),
            ),
        )

    return let(minima, of)


def packed(values: Column) -> Column:
    """The lowest eight bits of all values, eight values to a long."""

    def of(bins: Column) -> Column:
        def group(g: Column) -> Column:
            out = F.lit(0).cast("long")
            for k in range(PER_LONG):
                low = at(bins, g * PER_LONG + k).bitwiseAND(255)
                out = out.bitwiseOR(F.shiftleft(low, 8 * k))
            return out

        return F.transform(
            F.sequence(F.lit(0), F.lit(BINS // PER_LONG - 1)), group
        )

    return let(values, of)


def fingerprint(text: Column) -> Column:
    """Packed fingerprint as an array of longs, empty for a text without words."""

    def of(words: Column) -> Column:
        some = F.filter(words, lambda w: w != "")
        return let(
            some,
            lambda kept: F.when(
                F.size(kept) > 0, packed(densified(bin_minima(shingle_hashes(kept))))
            ).otherwise(F.array().cast("array<long>")),
        )

    return let(F.split(F.lower(text), r"\s+"), of)


def as_text(fp: Column) -> Column:
    return F.array_join(
        F.transform(fp, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), ""
    )


def likeness(a: Column, b: Column) -> Column:
    """Jaccard estimate from two packed fingerprints, corrected for chance."""

    def differing_bytes(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        # fold the bits of each byte into its lowest one
        for shift, kept in ((4, 0x0F), (2, 0x03), (1, 0x01)):
            mask = int.from_bytes(bytes([kept]) * 8, "big")
            d = d.bitwiseOR(F.shiftrightunsigned(d, shift)).bitwiseAND(mask)
        return F.bit_count(d)

    differing = F.aggregate(
        F.zip_with(a, b, differing_bytes), F.lit(0), lambda acc, n: acc + n
    )
    share = 1 - differing / F.lit(float(BINS))
    chance = 1.0 / 256
    corrected = F.greatest(F.lit(0.0), (share - chance) / (1 - chance))
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0)
        .when((F.size(a) == 0) | (F.size(b) == 0), 0.0)
        .otherwise(corrected)
    )


def bucket_of(key: Column, bounds: list[int]) -> Column:
    """How many bounds are at most the key, found in two steps."""
    all_bounds = F.array(*[F.lit(b) for b in bounds]) if bounds else None
    if all_bounds is None:
        return F.lit(0)
    coarse = F.array(*[F.lit(b) for b in bounds[::SEARCH_STEP]])
    group = F.size(F.filter(coarse, lambda b: b <= key))

    def within(g: Column) -> Column:
        part = F.slice(all_bounds, (g - 1) * SEARCH_STEP + 1, SEARCH_STEP)
        return F.when(g == 0, 0).otherwise(
            (g - 1) * SEARCH_STEP + F.size(F.filter(part, lambda b: b <= key))
        )

    return let(group, within)


def with_next(docs: DataFrame, carried: dict[str, Column]) -> DataFrame:
    """docs (doc_id, text, ...) with columns c and next_<c>, those of the next document.

    carried: expressions over a document, computed once each, before any shuffle.

    Documents are dealt into buckets of consecutive ids; a bucket also gets the first
    row of the bucket after it. The bounds and first ids of the buckets, at most
    MOST_BUCKETS numbers, are all that reaches the driver.
    """
    keyed = docs.withColumn("key", F.coalesce(F.col("doc_id"), F.lit(LONG_MIN)))
    total = keyed.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = min(MOST_BUCKETS, 1 + total // BUCKET_BYTES)
    bounds: list[int] = []
    if n > 1:
        shares = [i / n for i in range(1, n)]
        cuts = keyed.agg(F.percentile_approx("key", shares, 10 * n)).first()[0]
        bounds = sorted(set(cuts or []))
    dealt = keyed.withColumn("bucket", bucket_of(F.col("key"), bounds))
    firsts = sorted(
        tuple(row) for row in dealt.groupBy("bucket").agg(F.min("key")).collect()
    )
    ring = [
        (key, firsts[i - 1][0] if i else firsts[-1][0])
        for i, (_, key) in enumerate(firsts)
    ]
    spark = docs.sparkSession
    ghosts = dealt.drop("bucket").join(
        F.broadcast(spark.createDataFrame(ring, "key long, bucket int")), "key"
    )
    rows = dealt.select("*", F.lit(0).alias("ghost"), F.lit(0).alias("turn")).unionByName(
        ghosts.select(
            "*",
            F.lit(1).alias("ghost"),
            # the first bucket's row follows the last bucket, whatever its id
            (F.col("key") == (firsts[0][1] if firsts else 0)).cast("int").alias("turn"),
        )
    )
    ordered = Window.partitionBy("bucket").orderBy("turn", "ghost", "key", "text")
    # the rows of bucket ends are few: what is costly comes after they are picked
    found = rows.withColumns(carried).select(
        "*", *[F.lead(c).over(ordered).alias(f"next_{c}") for c in carried]
    )
    new = [c for c in carried if c not in docs.columns]
    return found.where("ghost = 0").select(
        *docs.columns, *new, *[f"next_{c}" for c in carried]
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of texts and of their edited forms, with likenesses.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and
    near_next. The edited form has the last quarter of a text replaced by the first
    characters of the next document.
    """
    read = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    text = F.col("text")
    pairs = with_next(read, {"text": text, "fp": fingerprint(text)})
    n_chars = F.char_length("text")
    quarter = F.floor(n_chars / 4).cast("int")
    edited = pairs.select(
        "doc_id",
        n_chars.cast("long").alias("n_chars"),
        "fp",
        "next_fp",
        F.concat(
            F.left(F.col("text"), n_chars - quarter), F.left(F.col("next_text"), quarter)
        ).alias("edited"),
    ).withColumn("edited_fp", fingerprint(F.col("edited")))
    return edited.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
