"""The corpus pipeline, each stage on what its predecessor kept; the registered SQL."""

from collections import defaultdict

import pytest

import corpus_pipeline
from alarmloom.llm import decontamination, line_dedup, ngram_join, quality
from alarmloom.llm.catalog import ORACLE, QUERIES, table
from tools.check_oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_oracle(spark, name, sf):
    ok, note, _ = compare(spark, connect(sf), QUERIES[name], ORACLE[name], sf)
    assert ok, note


def test_every_operator_is_registered_once():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))


def test_stages(spark, tmp_path):
    docs = table(spark, SF, "documents")
    columns, before = docs.columns, docs
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, SF).write.parquet(str(tmp_path / str(k)))
        kept[name] = after = spark.read.parquet(str(tmp_path / str(k)))
        if name != "best-fit packing":
            assert after.columns == columns
            before = after
    good, lines, single, clean, packed = kept.values()

    rated = quality.rate(docs, quality.graded(table(spark, SF, "labels")))
    assert ids(good) == ids(rated.where("kept"))

    cleaned = {r.doc_id: r for r in line_dedup.line_dedup(good).collect()}
    assert ids(lines) == ids(good)
    for r in lines.collect():
        assert r.text == cleaned[r.doc_id].text and r.n_chars == len(r.text)

    groups = defaultdict(set)
    for r in ngram_join.ngram_join(lines).collect():
        groups[r.component_id].add(r.doc_id)
    assert ids(single) == {min(group) for group in groups.values()}

    searched = decontamination.decontaminate(single, table(spark, SF, "benchmark"))
    assert ids(clean) == ids(searched.where("not contaminated"))
    assert ids(packed) == ids(clean)
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0
    run = corpus_pipeline.run(spark, SF)
    assert sorted(run.select(*packed.columns[:5]).collect()) == sorted(packed.select(*packed.columns[:5]).collect())


def ids(frame):
    return {r.doc_id for r in frame.select("doc_id").collect()}


def test_stages_on_odd_rows(spark, edge_docs, no_docs, clashing):
    """All stages but the last keep columns and, whatever their names, their values."""
    extra = [c for c in clashing.columns if c not in edge_docs.columns]
    for name, stage in corpus_pipeline.STAGES:
        plain = stage(spark, edge_docs, SF)
        with_extra = stage(spark, clashing, SF)
        assert stage(spark, no_docs, SF).count() == 0
        if name == "best-fit packing":
            told = ["doc_id", "piece", "start", "length", "ids_crc32"]
            assert rows(with_extra.select(told)) == rows(plain.select(told))
            assert ids(plain) == ids(edge_docs)
            continue
        assert plain.columns == edge_docs.columns and with_extra.columns == clashing.columns
        got = with_extra.collect()
        assert sorted(repr(tuple(r)[:5]) for r in got) == rows(plain)
        assert got and all(r[c] == f"extra {c}" for r in got for c in extra)


def rows(frame):
    return sorted(map(repr, map(tuple, frame.collect())))
