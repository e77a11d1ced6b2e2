"""Importance resampling and the forest on rule statistics against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from alarmloom.llm import resampling as RS
from alarmloom.llm import rule_forest as RF

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SPACED = re.compile("[^\x20\x09-\x0d]+")


# -- resampling ------------------------------------------------------------------


def folded(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_features(text, longest=1):
    words = folded(text)
    return [
        zlib.crc32(" ".join(words[i:i + n]).encode()) % RS.BUCKETS
        for n in range(1, longest + 1) for i in range(len(words) - n + 1)
    ]


def plain_resample(rows, items, percent=10, least=20, longest=1, seed=2024):
    s = Counter(b for r in rows for b in plain_features(r[1], longest))
    t = Counter(b for x in items for b in plain_features(x, longest))
    S, T = s.total(), t.total()

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (S + RS.BUCKETS) / ((s[b] + 1) * (T + RS.BUCKETS))))

    out = []
    for doc_id, text, *_ in rows:
        f = plain_features(text, longest)
        weight = sum(map(gain, f)) // len(f) if f else 0
        name = f"{seed}:{'' if doc_id is None else doc_id}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(f), weight, weight + noise, None, len(folded(text))])
    drawn = [r for r in out if r[5] >= least]
    drawn.sort(key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    for rank, r in enumerate(drawn[: percent * len(drawn) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=repr)


def found(frame):
    cols = ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted((tuple(r) for r in frame.select(cols).collect()), key=repr)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(f"b{i}", t) for i, t in enumerate(["the token of naïve endly", None, "", "über worthless ing ing"])]
    return spark.createDataFrame(rows, "item_id string, text string")


@pytest.mark.parametrize("percent,least,longest", [(10, 20, 1), (100, 0, 1), (35, 3, 3), (0, 0, 1)])
def test_resampling_equals_plain(spark, edge_docs, edge_rows, items, percent, least, longest):
    got = RS.resample(edge_docs, items, percent, least, longest)
    texts = [r.text for r in items.collect()]
    assert found(got) == plain_resample(edge_rows, texts, percent, least, longest)


def test_resampling_of_odd_tables(spark, edge_docs, no_docs, clashing, items):
    assert found(RS.resample(no_docs, items)) == []
    plain = found(RS.resample(edge_docs, items))
    assert found(RS.resample(clashing.withColumn("k_row", F.lit("x")), items)) == plain
    assert len(found(RS.resample(edge_docs, items.limit(0)))) == len(plain)


def test_many_equal_keys_are_ranked_without_gaps(spark, items):
    """A third of all rows is one row; others have no id."""
    text = "the same words of one text that is here many times over and over again so that keys tie at all places"
    rows = [(1, text)] * 400 + [(None, text)] * 400 + [(i, f"{text} {i}") for i in range(2, 402)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = RS.resample(docs, items, percent=50)
    assert found(got) == plain_resample(rows, [r.text for r in items.collect()], percent=50)


@pytest.mark.parametrize("k", [1, 2, 17, 500, 999, 1000, 1001])
def test_kth_key(spark, k):
    rng = random.Random(k)
    rows = [(rng.randrange(40), rng.randrange(9), rng.randrange(2)) for _ in range(1000)]
    frame = spark.createDataFrame(rows, "score long, doc_id long, n_features long").repartition(6)
    keyed = RS.written(RS.with_key(frame))
    want = sorted((-a, 1, b, c) for a, b, c in rows)
    got = RS.kth_key(keyed, k)
    assert got is None if k > 1000 else got[:4] == want[k - 1]


# -- rule statistics ---------------------------------------------------------------


def plain_counts(text):
    text = text or ""
    words = SPACED.findall(text)
    seen, dups = set(), 0
    for line in text.split("\n"):
        if SPACED.search(line):
            dups += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often, hit = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            hit.update(range(i, i + 8))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(hit))


def odd_texts():
    rng = random.Random(3)
    texts = [None, "", " \n ", "a", "a " * 7, "a " * 8, "a " * 9, "x y\x0bz\x1cq", "l 1\nl 1\nl 1 \n\nl 1", "# $ ## <>|&"]
    for _ in range(80):
        some = [rng.choice("ab c\n d") + rng.choice(["", "e", "é😀"]) for _ in range(rng.randrange(200))]
        texts.append(" ".join(some))
    block = " ".join(f"w{i}" for i in range(30))
    return texts + [f"{block} gap {block}", f"{block}\n{block}\n{block}", block, "k " * 50_000]


def test_statistics_equal_plain(spark, edge_docs, edge_rows):
    texts = odd_texts() + [r[1] for r in edge_rows]
    want = [plain_counts(t) for t in texts]
    # all at once, and each alone: groups of texts do not meet
    assert [tuple(r[:5]) for r in RF.statistics_of(texts)] == want
    assert [tuple(RF.statistics_of([t])[0][:5]) for t in texts] == want
    got = RF.statistics(edge_docs).select("doc_id", *RF.COUNTS).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((r[0], *plain_counts(r[1]))) for r in edge_rows)


# -- forest ------------------------------------------------------------------------


def plain_path(forest, root, x):
    node, steps = root, 0
    while forest.left[node] != node:
        side = forest.left if x[forest.attribute[node]] < forest.value[node] else forest.right
        node, steps = side[node], steps + 1
    return steps, node


def test_scores_equal_plain_paths():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(500, 5))
    forest = RF.fit(x, np.full(5, 0.5))
    rows = np.vstack([x[:20], rng.normal(size=(20, 5)) * 8])
    for row, score in zip(rows, forest.scores(rows)):
        total = 0.0
        for root in forest.roots:
            steps, leaf = plain_path(forest, root, row)
            assert steps <= forest.height and forest.path[leaf] >= steps
            total += forest.path[leaf]
        assert score == pytest.approx(2 ** (-total / len(forest.roots) / forest.norm))
    assert forest.scores(rows[20:]).mean() > forest.scores(rows[:20]).mean() + 0.1


def test_leaf_paths_add_what_a_tree_of_the_rest_would_have():
    forest = RF.fit(np.zeros((300, 2)), np.zeros(2))  # nothing to split
    assert set(forest.path) == {float(RF.expected_path(256))}
    harmonic = sum(1 / i for i in range(1, 256))
    assert float(RF.expected_path(256)) == pytest.approx(2 * harmonic - 2 * 255 / 256, abs=0.01)


def plain_threshold(good, poor):
    best = (-1, 0)
    for b in range(RF.BINS + 1):
        kept = sum(good[:b]) / max(1, sum(good))
        caught = 1 - sum(poor[:b]) / sum(poor) if sum(poor) else 0
        if kept >= RF.LEAST_KEPT or not sum(good):
            best = max(best, (kept + caught, b))
    return best[1] / RF.BINS


def test_threshold_equals_plain():
    rng = np.random.default_rng(2)
    for _ in range(20):
        good, poor = (np.bincount(rng.integers(a, a + 900, 50), minlength=RF.BINS) for a in (0, 400))
        assert RF.threshold(good, poor) == pytest.approx(plain_threshold(good.tolist(), poor.tolist()))
    none = np.zeros(RF.BINS, np.int64)
    assert RF.threshold(good, none) == 1.0 and RF.threshold(none, none) == 1.0


def test_verdicts_on_given_tables(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    # labels of every other document are kept from calibration
    known = labels.where("doc_id % 2 = 0")
    got = RF.rule_report(docs, known).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    good = [r for r in got if r.quality == 1 and not r.base_failed]
    poor = [r for r in got if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(r.kept for r in poor) <= 0.1 * len(poor)
    for r in got:
        want = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        assert r.base_failed == want and not (want and r.kept)


def test_forest_of_odd_tables(spark, edge_docs, no_docs, clashing, edge_rows):
    rows = [(i, i % 4 != 1 and 1 or 0) for i in range(60)] + [(None, 1), (3, None), (3, 0), (3, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    columns = ["doc_id", *RF.COUNTS, "base_failed", "kept", "anomaly"]
    first = sorted(map(repr, RF.rule_report(edge_docs, labels).select(columns).collect()))
    assert len(first) == len(edge_rows)
    assert sorted(map(repr, RF.rule_report(clashing, labels).select(columns).collect())) == first
    assert RF.rule_report(no_docs, labels).count() == 0
    for some in (labels.limit(0), labels.where("quality = 0")):
        assert all(r.kept != r.base_failed for r in RF.rule_report(edge_docs, some).collect())
