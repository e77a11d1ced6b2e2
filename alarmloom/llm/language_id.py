"""Language identification by prediction by partial matching.

Each language has a context tree over bytes of lower-cased text: a node is a context of
up to three bytes and holds what followed it in training. A byte's chance in a context
is its count over (all counts + distinct bytes); the distinct bytes are the count of the
escape, whose chance goes to the bytes not seen there, shared by their chances in the
context one byte shorter (so a byte's chances add up to one in every context). The
statistics are frozen after training, hence a byte's code length depends on its three
predecessors alone and is kept in a table by node, byte and language. A text's code
length in a language is the sum over all its bytes; the shortest wins.

LANGS_AT_ONCE languages, those with about equally many documents, share the shape of a
tree: contexts of two and three bytes that training met at least LEAST_SEEN times, the
most frequent first, up to TABLE_ENTRIES table entries. More languages make more such
tables, never smaller ones. Each is trained and broadcast on its own, and a worker scores
a batch by one after the other and holds one of several at a time. All tables know the
same bytes, so that code lengths compare. Training texts are a sample by a hash of doc_id
of about SAMPLE_DOCUMENTS per language, whatever the size of the corpus.

Defined results: a null or empty text, or one without a letter, is "und" with score 0;
so is every text when there is nothing to learn from. Ties go to the language first in
order. A null lang or doc_id trains nothing; repeated rows stay, one result each; other
columns are not read. Long texts are scored whole, a piece of bytes at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alarmloom.llm.shared import held_out, sample_number, written

SAMPLE_DOCUMENTS = 1_000
LEAST_SEEN = 20
LANGS_AT_ONCE = 4
TABLE_ENTRIES = 6_000_000
PIECE_BYTES = 1 << 20
START = b"\n\n\n"
UNKNOWN = "und"

a_letter = re.compile(r"[^\W\d_]").search


def gram_counts(rows: DataFrame) -> DataFrame:
    """lang, gram (a byte and its three predecessors as one number), n."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang").text:
                found = []
                for text in texts:
                    b = np.frombuffer(START + text.lower().encode(), np.uint8)
                    b = b.astype(np.uint32)
                    found.append(b[:-3] << 24 | b[1:-2] << 16 | b[2:-1] << 8 | b[3:])
                grams, n = np.unique(np.concatenate(found), return_counts=True)
                yield pd.DataFrame({"lang": lang, "gram": grams.astype("int64"), "n": n})

    counted = rows.mapInPandas(count, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Trees:
    """Code lengths of some languages over one tree shape.

    seen: the bytes that training met in any language; those in counts unless given.
    """

    def __init__(
        self, langs: list[str], counts: pd.DataFrame, seen: list[int] | None = None
    ) -> None:
        self.langs = langs
        grams = counts.gram.to_numpy(np.int64)
        n = counts.n.to_numpy(np.float64)
        lang = np.searchsorted(np.array(langs), counts.lang.to_numpy(str))
        if seen is None:
            seen = np.unique([grams >> s & 255 for s in (0, 8, 16, 24)])
        self.classes = np.zeros(256, np.int64)  # 0: bytes that training never met
        self.classes[seen] = np.arange(1, len(seen) + 1)
        size, n_langs = len(seen) + 1, len(langs)
        self.size = size
        before = [self.classes[grams >> s & 255] for s in (8, 16, 24)]
        symbol = self.classes[grams & 255]

        def table(node: np.ndarray, nodes: int) -> np.ndarray:
            at = (node * size + symbol) * n_langs + lang
            held = node >= 0
            flat = np.bincount(at[held], n[held], minlength=nodes * size * n_langs)
            return flat.reshape(nodes, size, n_langs)

        # contexts of no byte and of one byte are all kept
        flat = np.full((1, size, n_langs), 1.0 / size)
        root = blended(table(np.zeros_like(symbol), 1), flat)
        one = blended(table(before[0], size), np.repeat(root, size, axis=0))

        room = max(0, TABLE_ENTRIES // (size * n_langs) - size)
        pair = before[0] * size + before[1]
        triple = pair * size + before[2]
        pairs = frequent(pair, n, room // 4)
        two = blended(table(place(pairs, pair), len(pairs)), one[pairs // size])
        triples = frequent(triple, n, room - len(pairs))
        triples = triples[place(pairs, triples // size) >= 0]
        parents = place(pairs, triples // size)
        three = blended(table(place(triples, triple), len(triples)), two[parents])

        chances = np.concatenate([one, two, three])
        bits = -np.log2(chances).astype(np.float32)
        bits[:, 0, :] += np.log2(max(1, 256 - len(seen)))
        self.bits = bits.reshape(-1, n_langs)
        # node of (last byte, byte before), then of (that node, third byte)
        self.by_two = np.repeat(np.arange(size), size)
        self.by_two[pairs] = size + np.arange(len(pairs))
        self.by_three = np.repeat(np.arange(size + len(pairs)), size)
        at = (size + parents) * size + triples % size
        self.by_three[at] = size + len(pairs) + np.arange(len(triples))

    def code_lengths(self, text: str) -> np.ndarray:
        """Bits of the whole text by language."""
        data = START + text.lower().encode()
        total = np.zeros(len(self.langs))
        for at in range(3, len(data), PIECE_BYTES):
            piece = np.frombuffer(data[at - 3 : at + PIECE_BYTES], np.uint8)
            b = self.classes[piece]
            node = self.by_two[b[2:-1] * self.size + b[1:-2]]
            node = self.by_three[node * self.size + b[:-3]]
            rows = self.bits.take(node * self.size + b[3:], axis=0)
            total += rows.sum(axis=0, dtype=np.float64)
        return total


def loaded(part: Broadcast, keep: bool) -> Trees:
    trees = part.value
    # where Spark encrypts files, a worker is given the value itself, only once
    if not keep and getattr(part, "_path", None):
        del part._value
    return trees


def predicted(parts: list[Broadcast], texts: list[str | None]) -> list[tuple[str, float]]:
    """Language and score of each text."""
    told = [i for i, text in enumerate(texts) if parts and text and a_letter(text)]
    out = [(UNKNOWN, 0.0)] * len(texts)
    if not told:
        return out
    langs: list[str] = []
    columns = []
    for part in parts:
        trees = loaded(part, keep=len(parts) == 1)
        langs += trees.langs
        columns.append(np.array([trees.code_lengths(texts[i]) for i in told]))
        del trees
    order = sorted(range(len(langs)), key=langs.__getitem__)
    for i, bits in zip(told, np.hstack(columns)[:, order]):
        best = int(bits.argmin())
        odds = np.exp2(np.maximum(bits[best] - bits, -1000.0))
        out[i] = langs[order[best]], float(1.0 / odds.sum())
    return out


def blended(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Chances by (node, byte, language) from counts and the next shorter context's."""
    total = counts.sum(axis=1, keepdims=True)
    distinct = (counts > 0).sum(axis=1, keepdims=True)
    unseen = np.where(counts > 0, 0.0, shorter)
    left = unseen.sum(axis=1, keepdims=True)
    some = np.maximum(total, 1.0)
    with_escape = np.where(
        counts > 0,
        counts / (some + distinct),
        distinct / (some + distinct) * unseen / np.where(left > 0, left, 1.0),
    )
    all_seen = counts / some
    return np.where(total == 0, shorter, np.where(left > 0, with_escape, all_seen))


def frequent(contexts: np.ndarray, n: np.ndarray, room: int) -> np.ndarray:
    """The most frequent contexts, sorted by value."""
    values, at = np.unique(contexts, return_inverse=True)
    totals = np.bincount(at, n)
    order = np.lexsort((values, -totals))[: max(0, room)]
    return np.sort(values[order[totals[order] >= LEAST_SEEN]])


def place(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Index of x in sorted values, -1 where it is not there."""
    if not len(sorted_values):
        return np.full(len(x), -1)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return np.where(sorted_values[at] == x, at, -1)


def train(docs: DataFrame) -> list[Broadcast]:
    """The broadcast trees of all languages, LANGS_AT_ONCE in each."""
    spark = docs.sparkSession
    known = docs.where(
        ~held_out(5, 0) & F.col("lang").isNotNull() & (F.octet_length("text") > 0)
    ).select("doc_id", "lang", "text")
    sizes = {row.lang: row["count"] for row in known.groupBy("lang").count().collect()}
    if not sizes:
        return []
    shares = spark.createDataFrame(
        [(lang, min(1.0, SAMPLE_DOCUMENTS / n)) for lang, n in sizes.items()],
        "lang string, share double",
    )
    sampled = known.join(F.broadcast(shares), "lang")
    chosen = sampled.where(sample_number("lang") < F.col("share"))
    counts = written(gram_counts(chosen.select("lang", "text")))
    bytes_of = [F.shiftright("gram", s).bitwiseAND(255) for s in (0, 8, 16, 24)]
    met = counts.select(F.explode(F.array(*bytes_of)).alias("byte")).distinct()
    seen = sorted(row.byte for row in met.collect())
    by_size = sorted(sizes, key=lambda lang: (-sizes[lang], lang))
    parts = []
    for at in range(0, len(by_size), LANGS_AT_ONCE):
        langs = sorted(by_size[at : at + LANGS_AT_ONCE])
        own = counts.where(F.col("lang").isin(langs)).toPandas()
        trees = Trees(langs, own.sort_values(["lang", "gram"]), seen)
        parts.append(spark.sparkContext.broadcast(trees))
    return parts


def language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    parts = train(docs)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame(
                predicted(parts, texts.tolist()), columns=["lang_pred", "score"]
            )

    return docs.select(
        "doc_id", held_out(5, 0).alias("held_out"), predict("text").alias("p")
    ).select("doc_id", "held_out", "p.lang_pred", "p.score")
