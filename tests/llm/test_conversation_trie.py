"""The prefix trie of conversations against plain recursion."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from alarmloom.llm import conversation_trie as CT

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_nodes(sequences):
    """sequences: conversation id -> list of (role, text)."""
    members, ends, below = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            node = tuple(turns[:d])
            members[node].append(c)
            if d:
                below[node[:-1]].add(node)
        ends[tuple(turns)].append(c)

    totals = {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        kids = [totals[k] for k in below[node]]
        totals[node] = (
            sum(k[0] for k in kids) or 1,
            (len(members[node]) - 1) * words + sum(k[1] for k in kids),
        )
    return sorted(
        (
            (
                min(members[n]), len(n), min(members[n[:-1]]) if n else None, len(members[n]),
                len(below[n]), *totals[n],
                hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest(),
            )
            for n in members
        ),
        key=repr,
    )


def as_sequences(rows):
    held = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            held[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in held.items()}


def plain_rebuilt(rows):
    own, out = as_sequences(rows), {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def found(frame):
    return sorted((tuple(r) for r in frame.select(COLUMNS).collect()), key=repr)


def made_rows(n, depth, seed, choices=2):
    """Conversations that share many beginnings, of up to depth turns."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, depth + 1)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"word {rng.randrange(choices)} of\tturn" * rng.choice([1, 1, 2])))
    return rows


def odd_rows():
    rows = made_rows(90, 6, 1)
    rows = [r for r in rows if r[0] != 40]  # no base for 41 to 59
    rows += [(200, None, None, None), (200, 0, "user", ""), (201, 5, None, "a b"), (202, -3, "", None)]
    rows += [(None, 0, "user", "belongs to none"), (203, 1, "x", "same"), (203, 1, "x", "same"), (203, 2, "x", "é 😀")]
    return rows + [(204, 0, "1", "1:x"), (205, 0, "11", ":x")]


@pytest.mark.parametrize("parts", [1, 7])
def test_report_equals_plain(spark, parts):
    rows = odd_rows()
    random.Random(2).shuffle(rows)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    frame = frame.select("*", *[F.lit("extra").alias(c) for c in ("node", "up", "depth", "words", "uid", "kind")])
    assert found(CT.trie_report(frame)) == plain_nodes(plain_rebuilt(rows))


def test_no_conversations(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert found(CT.trie_report(frame)) == []
    assert found(CT.trie_report(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA))) == []


def trie_of(frame, height):
    trie = CT.prefix_trie(*CT.as_given(CT.digested(frame)), height)
    told = trie.nodes.join(CT.ends_digest(trie.ends), "node", "left")
    return trie, told.withColumnRenamed("saved", "saved_tokens").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256))
    )


@pytest.mark.parametrize("height", [2, 3, 8])
def test_bands_of_any_height_give_the_same(spark, height):
    rows = made_rows(40, 30, 4) + [(1000 + c, *r) for c, *r in made_rows(3, 30, 9)]
    _, told = trie_of(spark.createDataFrame(rows, SCHEMA), height)
    assert found(told) == plain_nodes(as_sequences(rows))


def test_long_and_hot_conversations(spark):
    """One conversation over many partitions; one beginning shared by most others."""
    rows = [(7, t, "user", f"turn {t % 13}") for t in range(3_000)]
    rows += [(100 + c, t, "user", f"turn {t}" if t < 2 else f"own {c}") for c in range(700) for t in range(3)]
    rows += [(9, t, "user", f"turn {t % 13}") for t in range(2_500)]
    _, told = trie_of(spark.createDataFrame(rows, SCHEMA).repartition(9), 8)
    assert found(told) == plain_nodes(as_sequences(rows))


def test_explosion_stays_within_a_band(spark):
    rows = [(1, t, "user", str(t)) for t in range(200)]
    chain = CT.prefixes(CT.as_given(CT.digested(spark.createDataFrame(rows, SCHEMA)))[0])
    for step in (1, 4, 16):
        banded = CT.in_bands(chain, 4, step)
        assert banded.count() == 200 // step
        assert banded.agg(F.max(F.size("up"))).first()[0] <= 4


def test_children_of_hot_parents_meet_them(spark, monkeypatch):
    monkeypatch.setattr(CT, "HOT", 3)  # most parents with children count as hot
    rows = made_rows(60, 5, 8)
    _, told = trie_of(spark.createDataFrame(rows, SCHEMA), 8)
    assert found(told) == plain_nodes(as_sequences(rows))


def test_ids_that_end_in_many_pieces(spark):
    rows = [(c, 0, "user", "hello") for c in range(-700, 2_000, 3)]
    _, told = trie_of(spark.createDataFrame(rows, SCHEMA), 8)
    assert found(told) == plain_nodes(as_sequences(rows))


def test_last_turns_of_nodes(spark):
    frame = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "bot", "b"), (2, 0, "user", "a")], SCHEMA)
    trie, _ = trie_of(frame, 8)
    got = CT.node_turns(trie.nodes, frame).select("conv_id", "depth", "role", "text").collect()
    assert sorted(map(tuple, got)) == [(1, 0, None, None), (1, 1, "user", "a"), (1, 2, "bot", "b")]
