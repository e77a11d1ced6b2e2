"""Classifiers by held-out accuracy, and by their formulas on small cases."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from alarmloom.llm import features, language_id, quality, toxicity
from alarmloom.llm.shared import held_out

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


# ---- toxicity


def test_toxicity_on_held_out_rows(docs, labels):
    got = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    order = got.score.rank()
    toxic = got.toxic == 1
    auc = (order[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum())
    assert auc > 0.85
    assert got[~toxic].predicted.mean() < 0.03
    assert got[toxic].predicted.mean() > 0.6


def test_toxicity_ignores_labels_of_held_out_rows(docs, labels):
    turned = labels.withColumn(
        "toxic", F.when(held_out(3, 1), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    a = {r.doc_id: r.score for r in toxicity.toxicity(docs, labels).collect()}
    b = {r.doc_id: r.score for r in toxicity.toxicity(docs, turned).collect()}
    assert a == b


def test_non_negative_risk_does_not_call_toxic_text_clean():
    # half of the unlabelled rows are like the toxic ones
    rng = random.Random(1)
    ids, labels = [], []
    for i in range(400):
        toxic_like = i < 100 or i % 4 == 0
        ids.append(np.array(sorted({7 if toxic_like else 9, rng.randrange(20, 60)}), np.int32))
        labels.append(1 if i < 100 else 0)
    sample = features.Sample(ids, [np.ones(len(x), np.float32) for x in ids], {"toxic": np.array(labels)})
    model = toxicity.fit_non_negative(sample, 0.25)
    assert model.weights[7] + model.bias > 0 > model.bias


def risk(model, texts, toxic, prior):
    """The corrected risk of a model, document by document in plain Python."""
    margins = []
    for text in texts:
        words = set(re.findall(rb"[0-9a-z\x80-\xff]+", text.lower().encode()))
        buckets = {zlib.crc32(w) % features.BUCKETS for w in words}
        buckets |= {zlib.crc32(w[:k], 77) % features.BUCKETS for w in words for k in range(4, 9) if k < len(w)}
        margins.append(model.bias + sum(model.weights.get(b, 0.0) for b in buckets))
    as_toxic = [math.log1p(math.exp(-m)) for m, t in zip(margins, toxic) if t]
    as_clean = [[math.log1p(math.exp(m)) for m, t in zip(margins, toxic) if t == side] for side in (0, 1)]
    clean = sum(as_clean[0]) / len(as_clean[0]) - prior * sum(as_clean[1]) / len(as_clean[1])
    decay = toxicity.DECAY / 2 * sum(w * w for w in model.weights.values())
    return prior * sum(as_toxic) / len(as_toxic) + max(0.0, clean) + decay, margins


def test_toxicity_is_of_least_risk(spark, monkeypatch):
    """Against the risk by plain Python: scores are its margins, and no step lowers it."""
    monkeypatch.setattr(toxicity, "STEPS", 3000)
    monkeypatch.setattr(toxicity, "RATE", 0.01)
    rng = random.Random(5)
    words = ["bread", "garden", "Table", "windowpane", "sky", "été"]
    texts, toxic = [], []
    for i in range(700):
        # of the unlabelled, as many are toxic as the prior says
        bad = i < 200 or i % 10 < 3
        some = [rng.choice(words) for _ in range(6)]
        # clean text holds the telling words now and then, toxic text not always
        some += ["vilename"] * (rng.random() < (0.7 if bad else 0.1)) + ["slur"] * (rng.random() < (0.5 if bad else 0.05))
        texts.append(" ".join(some))
        toxic.append(int(i < 200))
    rows = [(i, t, y) for i, (t, y) in enumerate(zip(texts, toxic))]
    sample = toxicity.screened(spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(3))
    told = {zlib.crc32(w) % features.BUCKETS for w in (b"vilename", b"slur")}
    told |= {zlib.crc32(b"vilename"[:k], 77) % features.BUCKETS for k in range(4, 8)}
    assert sample.n == 700 and told <= set(sample.ids.tolist())
    assert not {zlib.crc32(w.lower().encode()) % features.BUCKETS for w in words} & set(sample.ids.tolist())
    model = toxicity.fit_non_negative(sample, 0.3)
    least, margins = risk(model, texts, toxic, 0.3)
    assert [model.score(t) for t in texts] == pytest.approx([1 / (1 + math.exp(-m)) for m in margins])
    for bucket in [None, *model.weights]:
        for by in (-0.05, 0.05):
            moved = toxicity.Model(dict(model.weights), model.bias)
            if bucket is None:
                moved.bias += by
            else:
                moved.weights[bucket] += by
            assert risk(moved, texts, toxic, 0.3)[0] > least - 1e-5


def test_toxicity_edges(edge_docs, no_docs, clashing, labels, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score < 1e-9 for r in toxicity.toxicity(edge_docs, none).collect()} == {True}
    some = spark.createDataFrame(
        [(i, 1, int(i % 2)) for i in range(60)] + [(None, 1, 1), (3, None, None), (4, 0, 1), (4, 0, 0)],
        "doc_id long, quality int, toxic int",
    )
    got = toxicity.toxicity(edge_docs, some).collect()
    assert len(got) == edge_docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert sorted(toxicity.toxicity(clashing, some).collect(), key=str) == sorted(got, key=str)
    assert toxicity.toxicity(no_docs, some).count() == 0


# ---- quality


def test_quality_on_held_out_rows(docs, labels):
    rated = quality.rate(docs, quality.graded(labels)).join(labels, "doc_id")
    got = rated.where(held_out(5, 2)).select("quality", "toxic", "kept", "tail", "expected_grade").toPandas()
    assert got[got.quality == 1].kept.mean() > 0.97
    assert got[got.quality == 0].kept.mean() < 0.15
    good = got[got.quality == 1]
    assert good[good.toxic == 0].expected_grade.mean() > good[good.toxic == 1].expected_grade.mean()


def test_cumulative_link_learns_ordered_thresholds():
    rng = np.random.default_rng(2)
    n = 3000
    x = rng.integers(0, 6, n)
    margin = x - 2.5 + rng.logistic(size=n)
    grade = (margin > -1.5).astype(int) + (margin > 0) + (margin > 1.5)
    sample = features.Sample(
        [np.array([i], np.int32) for i in x], [np.ones(1, np.float32)] * n, {"grade": grade + 2}
    )
    model = quality.fit_cumulative(sample)
    assert model.lowest == 2
    assert list(model.thresholds) == sorted(model.thresholds)
    shifted = model.thresholds - model.thresholds.mean()
    assert np.allclose(shifted, [-1.5, 0, 1.5], atol=0.2)
    assert np.allclose(np.diff(model.weights[:6]), 1, atol=0.3)


def test_gradient_of_cumulative_link():
    """The fit is no worse than nearby weights and thresholds."""
    rng = np.random.default_rng(5)
    x, grade = rng.integers(0, 4, 500), rng.integers(0, 3, 500)
    rows = [np.array([i], np.int32) for i in x]
    model = quality.fit_cumulative(
        features.Sample(rows, [np.ones(1, np.float32)] * 500, {"grade": grade})
    )

    def loss(weights, thresholds):
        edges = np.concatenate([[-50], thresholds, [50]])
        p = features.sigmoid(edges[grade + 1] - weights[x]) - features.sigmoid(edges[grade] - weights[x])
        return -np.log(p).mean()

    best = loss(model.weights[:4].astype(float), model.thresholds)
    for _ in range(20):
        w = model.weights[:4] + rng.normal(0, 0.1, 4)
        t = np.sort(model.thresholds + rng.normal(0, 0.1, 2))
        assert loss(w, t) > best - 1e-4


def test_quality_edges(edge_docs, no_docs, clashing, spark):
    none = spark.createDataFrame([], "doc_id long, grade int")
    assert quality.rate(edge_docs, none).where("kept").count() == edge_docs.count()
    one = spark.createDataFrame([(i, 1) for i in range(50)], "doc_id long, grade int")
    assert quality.rate(edge_docs, one).where("kept").count() == edge_docs.count()
    some = spark.createDataFrame(
        [(i, i % 3) for i in range(60)] + [(None, 0), (7, None), (8, 0)], "doc_id long, grade int"
    )
    got = quality.rate(clashing, some)
    assert got.count() == edge_docs.count()
    assert got.first()["digest"] == "extra digest"
    assert got.where("tail < 0 or tail > 1 or expected_grade < 0 or expected_grade > 2").count() == 0
    assert quality.rate(no_docs, some).count() == 0


# ---- language


def test_language_on_held_out_rows(docs):
    got = language_id.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id")
    got = got.where("held_out").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.98


def small_trees(monkeypatch, texts, least=1):
    monkeypatch.setattr(language_id, "LEAST_SEEN", least)
    rows = []
    for lang, text in texts.items():
        data = language_id.START + text.encode()
        grams = Counter(int.from_bytes(data[i - 3 : i + 1], "big") for i in range(3, len(data)))
        rows += [(lang, g, n) for g, n in grams.items()]
    counts = pd.DataFrame(rows, columns=["lang", "gram", "n"]).sort_values(["lang", "gram"])
    return language_id.Trees(sorted(texts), counts)


TEXTS = {"x": "abracadabra abba cab", "y": "zab yabz zzyb bay"}


def brute_bits(texts, lang, text):
    """Code length by recursion over contexts, with counts straight from the text."""
    alphabet = set(b"".join(t.encode() for t in texts.values())) | {10}

    def counts(context):
        data = language_id.START + texts[lang].encode()
        return Counter(
            data[i] for i in range(3, len(data)) if data[i - len(context) : i] == context
        )

    everything = {0} | alphabet  # 0 stands for all bytes never met

    def chance(symbol, context):
        shorter = (lambda s: chance(s, context[1:])) if context else (lambda s: 1 / len(everything))
        seen = counts(context)
        if not seen:
            return shorter(symbol)
        total, distinct = sum(seen.values()), len(seen)
        left = sum(shorter(s) for s in everything if s not in seen)
        if symbol in seen:
            return seen[symbol] / (total + distinct) if left else seen[symbol] / total
        return distinct / (total + distinct) * shorter(symbol) / left

    data, bits = language_id.START + text.encode(), 0.0
    for i in range(3, len(data)):
        symbol = data[i] if data[i] in alphabet else 0
        context = data[i - 3 : i]
        kept = context
        while kept and not any(  # contexts that no language met are not in the tree
            (language_id.START + t.encode()).find(kept, 0, -1) >= 0 for t in texts.values()
        ):
            kept = kept[1:]
        bits -= math.log2(chance(symbol, kept))
        if symbol == 0:
            bits += math.log2(256 - len(alphabet))
    return bits


def test_code_lengths_equal_recursion(monkeypatch):
    trees = small_trees(monkeypatch, TEXTS)
    for text in ("abra", "zab", "cab bay", "b", "azazaz dab", "qab", "abracadabra abba cab"):
        got = trees.code_lengths(text)
        for k, lang in enumerate(sorted(TEXTS)):
            assert got[k] == pytest.approx(brute_bits(TEXTS, lang, text), rel=1e-5)


def test_chances_add_up_in_every_context(monkeypatch):
    trees = small_trees(monkeypatch, TEXTS, least=2)
    bits = trees.bits.reshape(-1, trees.size, 2).astype(float)
    bits[:, 0, :] -= math.log2(256 - (trees.size - 1))
    assert np.allclose(np.exp2(-bits).sum(axis=1), 1, atol=1e-5)


def test_long_texts_are_scored_in_pieces(monkeypatch):
    trees = small_trees(monkeypatch, TEXTS)
    whole = trees.code_lengths("abra cadabra zab " * 50)
    monkeypatch.setattr(language_id, "PIECE_BYTES", 7)
    assert np.allclose(trees.code_lengths("abra cadabra zab " * 50), whole)


def test_many_languages_keep_contexts_of_three_bytes(spark, monkeypatch):
    # every language has its own order of the same letters and the same pairs of ends
    monkeypatch.setattr(language_id, "TABLE_ENTRIES", 20_000)
    rng = random.Random(5)
    words = {f"l{k:02}": ["".join(rng.sample("abcdef", 6)) for _ in range(3)] for k in range(30)}
    made = [(lang, " ".join(rng.choices(own, k=30))) for lang, own in words.items() for _ in range(40)]
    docs = spark.createDataFrame([(i, text, lang) for i, (lang, text) in enumerate(made)], "doc_id long, text string, lang string")
    parts = language_id.train(docs)
    assert sorted(lang for part in parts for lang in part.value.langs) == sorted(words)
    for part in parts:
        trees = part.value
        assert len(trees.langs) <= language_id.LANGS_AT_ONCE
        assert trees.by_three.max() > trees.by_two.max() >= trees.size
    got = language_id.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.99


def test_languages_in_parts_are_scored_as_together(docs, monkeypatch):
    # with room for every context, the parts differ in contexts met in other parts only
    whole = language_id.language_id(docs).toPandas().set_index("doc_id").sort_index()
    monkeypatch.setattr(language_id, "LANGS_AT_ONCE", 1)
    parted = language_id.language_id(docs).toPandas().set_index("doc_id").sort_index()
    assert (whole.lang_pred == parted.lang_pred).mean() > 0.99


def test_language_edges(edge_docs, edge_rows, no_docs, clashing, spark):
    got = language_id.language_id(edge_docs).collect()
    assert len(got) == len(edge_rows)
    by_id = {r.doc_id: r for r in got}
    for doc_id in (100, 101, 102):
        assert (by_id[doc_id].lang_pred, by_id[doc_id].score) == ("und", 0.0)
    assert {r.lang_pred for r in got} <= {"en", "de", "zz", "und"}
    assert sorted(language_id.language_id(clashing).collect(), key=str) == sorted(got, key=str)
    assert language_id.language_id(no_docs).count() == 0
    unknown = edge_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.language_id(unknown).collect()} == {"und"}
