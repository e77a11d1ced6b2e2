"""Secret scans with multipart credential linking, in SQL functions only.

Three patterns are reported wherever they occur: assignments of long values to
secret-like names, access identifiers and long hexadecimal runs. Two weak patterns say
little alone: a bare run of exactly 40 key characters, and an endpoint with a scheme. A
weak candidate is reported only if a part that complements it lies within REACH code
points in the same document: an identifier or an endpoint for a bare key; an identifier,
a key or another secret for an endpoint. Parts are rows, and are linked by an interval
join on (document, cell of REACH code points), so that a document with very many parts
is spread over tasks, and each weak part is kept or dropped without making pairs.

Spans are found by cutting the text at its matches: the lengths of what lies between and
of the matches give the places, in code points. Patterns run only on texts that hold a
string without which they cannot match.

Defined results: a null text is empty; repeated rows stay, one result each (equal rows
are scanned as one document); a null doc_id is a document of its own text; other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alarmloom.llm.shared import cut_lineage

# fixed values: kinds in the order in which equal starts are listed
KINDS = ["assign", "access", "hex", "key", "endpoint"]
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
    r"([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_VALUE = 12
# the runs of the kinds below are greedy, so a least length can be part of the pattern
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
KEY = "[A-Za-z0-9+/]{40,}"
KEY_LENGTH = 40
ENDPOINT = r"""[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\s"'<>]+"""
REACH = 200
LONG_MIN = -(1 << 63)

SPAN = "struct<start:bigint,rank:int,end:bigint>"


def contains_any(text: Column, needles: list[str]) -> Column:
    out = F.lit(False)
    for needle in needles:
        out = out | F.contains(text, F.lit(needle))
    return out


def spans(text: Column, kind: str, pattern: str, keep: Column | None = None) -> Column:
    """Spans of a pattern's matches from left to right; keep: flags by match."""
    rank = KINDS.index(kind)
    parts = F.arrays_zip(
        F.transform(F.split(text, pattern), lambda x: F.char_length(x)).alias("gap"),
        F.transform(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
            lambda x: F.char_length(x),
        ).alias("size"),
        (F.array() if keep is None else keep).alias("keep"),
    )

    def step(acc: Column, part: Column) -> Column:
        start = acc["at"] + part["gap"]
        end = start + part["size"]
        span = F.struct(
            start.alias("start"), F.lit(rank).alias("rank"), end.alias("end")
        )
        wanted = part["size"].isNotNull()
        if keep is not None:
            wanted = wanted & part["keep"]
        return F.struct(
            F.coalesce(end, start).alias("at"),
            F.when(wanted, F.concat(acc["found"], F.array(span)))
            .otherwise(acc["found"])
            .alias("found"),
        )

    zero = F.struct(
        F.lit(0).cast("long").alias("at"),
        F.array().cast(f"array<{SPAN}>").alias("found"),
    )
    return F.aggregate(parts, zero, step, lambda acc: acc["found"])


def gated(text: Column, gate: Column, found: Column) -> Column:
    return F.when(gate, found).otherwise(F.array().cast(f"array<{SPAN}>"))


def scanned(docs: DataFrame) -> DataFrame:
    """key, digest, doc_id and the spans of every kind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    value_sizes = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    long_value = F.transform(value_sizes, lambda x: F.char_length(x) >= ASSIGN_VALUE)
    sizes = F.transform(
        F.regexp_extract_all(text, F.lit(KEY), F.lit(0)),
        lambda x: F.char_length(x) == KEY_LENGTH,
    )
    names = contains_any(F.lower(text), ["passw", "secret", "token", "api"])
    return docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id"), F.lit(LONG_MIN)).alias("key"),
        F.xxhash64(text).alias("digest"),
        gated(text, names, spans(text, "assign", ASSIGN, long_value)).alias("assign"),
        gated(text, F.contains(text, F.lit("AKIA")), spans(text, "access", ACCESS)).alias(
            "access"
        ),
        gated(text, text.rlike(HEX), spans(text, "hex", HEX)).alias("hex"),
        gated(text, text.rlike(KEY), spans(text, "key", KEY, sizes)).alias("key_like"),
        gated(
            text, F.contains(text, F.lit("://")), spans(text, "endpoint", ENDPOINT)
        ).alias("endpoint"),
    )


def linked(found: DataFrame) -> DataFrame:
    """key, digest and the weak spans that a complementary part lies near to."""
    columns = {"assign": "secret", "access": "identifier", "hex": "secret"}
    columns |= {"key_like": "key", "endpoint": "endpoint"}
    roles = F.create_map(
        *[x for i, k in enumerate(columns.values()) for x in (F.lit(i), F.lit(k))]
    )
    parts = (
        found.select("key", "digest", *columns)
        .where(F.size("key_like") + F.size("endpoint") > 0)
        .distinct()
        .select("key", "digest", F.explode(F.concat(*columns)).alias("span"))
        .select(
            "key",
            "digest",
            "span",
            F.col("span.start").alias("start"),
            F.col("span.end").alias("end"),
            roles[F.col("span.rank")].alias("role"),
        )
    )
    weak = parts.where(F.col("role").isin("key", "endpoint")).withColumn(
        "cell",
        F.explode(
            F.sequence(
                F.floor((F.col("start") - REACH) / REACH),
                F.floor((F.col("end") + REACH) / REACH),
            )
        ),
    )
    near = parts.select(
        "key",
        "digest",
        F.col("role").alias("other"),
        F.col("start").alias("from"),
        F.col("end").alias("to"),
        F.explode(
            F.sequence(F.floor(F.col("start") / REACH), F.floor(F.col("end") / REACH))
        ).alias("cell"),
    )
    complements = F.when(
        F.col("role") == "key", F.col("other").isin("identifier", "endpoint")
    ).otherwise(F.col("other") != "endpoint")
    apart = F.greatest("start", "from") - F.least("end", "to")
    a, b = weak.alias("a"), near.alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("key", "digest", "cell")]
    condition = same[0] & same[1] & same[2] & complements & (apart <= REACH)
    return (
        a.join(b, condition, "left_semi")
        .select("key", "digest", "span")
        .distinct()
        .groupBy("key", "digest")
        .agg(F.collect_list("span").alias("weak"))
    )


def joined(all_spans: Column) -> Column:
    kinds = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(
            F.array_sort(all_spans),
            lambda s: F.concat_ws(
                ":",
                F.get(kinds, s["rank"]),
                s["start"].cast("string"),
                s["end"].cast("string"),
            ),
        ),
        ",",
    )


def secret_scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_linked, base_sha256 and spans."""
    found = cut_lineage(scanned(docs.select("doc_id", "text")))
    met = found.join(linked(found), ["key", "digest"], "left")
    base = F.concat("assign", "access", "hex")
    weak = F.coalesce("weak", F.array().cast(f"array<{SPAN}>"))
    return met.select(
        "doc_id",
        F.size("assign").cast("long").alias("n_assign"),
        F.size("access").cast("long").alias("n_access"),
        F.size("hex").cast("long").alias("n_hex"),
        F.size(weak).cast("long").alias("n_linked"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.concat(base, weak)).alias("spans"),
    )
