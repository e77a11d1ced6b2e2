"""The scan and window primitives against brute force, whole and split."""

import functools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from alarmloom.operators import timeline as TL
from alarmloom.operators.hotkeys import SplitPolicy, split_hot_keys
from alarmloom.operators.timeline import (
    OPEN,
    PASS,
    RESET,
    Timeline,
    last_seen,
    nxt,
    prev,
    running_max,
)

SPLIT = SplitPolicy(target_rows=20)


def make_rows(seed, n=900, reset_share=0.02, span=3000):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.5 else f"k{rng.randrange(12)}"
        roll = rng.random()
        kind = RESET if roll < reset_share else PASS if roll < reset_share + 0.2 else OPEN
        rows.append((key, rng.randrange(span), i, kind, rng.choice([0, 3, 40, 200])))
    return rows


def brute_windows(rows):
    out = {}
    by_key = {}
    for r in rows:
        by_key.setdefault(r[0], []).append(r)
    for key, group in by_key.items():
        group.sort(key=lambda r: (r[1], r[2]))
        due = opened = first = None
        pos = 0
        for n, (_, ts, i, kind, width) in enumerate(group):
            if due is not None and ts > due:
                due, opened, pos = None, None, 0
            if kind == OPEN:
                if due is None:
                    due, opened, pos = ts + width, ts, 0
                    first = due if first is None else first
                pos += 1
            follow = group[n + 1][1] if n + 1 < len(group) else None
            out[i] = (due, opened, pos if due is not None else None, first, follow)
            if kind == RESET:
                due = opened = first = None
                pos = 0
    return out


def frame(spark, rows):
    df = spark.createDataFrame(rows, "key string, t long, id long, kind int, width long")
    return df.withColumn("ts", F.timestamp_micros("t")).repartition(4)


@pytest.mark.parametrize("seed,reset_share", [(1, 0.02), (2, 0.0), (3, 0.3)])
@pytest.mark.parametrize("policy", [SplitPolicy(), SPLIT], ids=["whole", "split"])
def test_windows_match_brute_force(spark, seed, reset_share, policy):
    rows = make_rows(seed, reset_share=reset_share)
    df = frame(spark, rows)
    line = Timeline(df, ["key"], "ts", "id", policy)
    assert line.split == (policy is SPLIT)
    got = line.windows(F.col("kind"), F.col("t") + F.col("width")).collect()
    assert len(got) == len(rows)
    found = {r.id: (r.w_due, r.w_open, r.w_pos, r.w_first, r.w_next) for r in got}
    assert found == brute_windows(rows)


def test_windows_on_strictly_periodic_rows(spark):
    # Chains of windows started at different rows never merge here.
    rows = [("hot", 10 * i, i, OPEN, 50) for i in range(800)]
    line = Timeline(frame(spark, rows), ["key"], "ts", "id", SPLIT)
    assert line.split
    got = line.windows(F.col("kind"), F.col("t") + F.col("width")).collect()
    found = {r.id: (r.w_due, r.w_open, r.w_pos, r.w_first, r.w_next) for r in got}
    assert found == brute_windows(rows)


def test_window_wider_than_many_chunks(spark):
    rows = [("hot", i, i, OPEN, 300) for i in range(1000)]
    line = Timeline(frame(spark, rows), ["key"], "ts", "id", SPLIT)
    got = line.windows(F.col("kind"), F.col("t") + F.col("width")).collect()
    found = {r.id: (r.w_due, r.w_open, r.w_pos, r.w_first, r.w_next) for r in got}
    assert found == brute_windows(rows)


@pytest.mark.parametrize("keys", [["key"], []], ids=["keyed", "global"])
def test_scans_split_equals_whole(spark, keys):
    df = frame(spark, make_rows(5)).withColumn(
        "v", F.when(F.col("id") % 7 == 0, F.col("id"))
    )
    scans = dict(p=prev(F.col("v")), n=nxt(F.col("v")), s=last_seen(F.col("v")),
                 m=running_max(F.col("width")))
    whole = Timeline(df, keys, "ts", "id")
    split = Timeline(df, keys, "ts", "id", SPLIT)
    assert not whole.split and split.split
    cols = ["id", "p", "n", "s", "m"]
    a = sorted(whole.scan(**scans).select(cols).collect())
    b = sorted(split.scan(**scans).select(cols).collect(), key=lambda r: r.id)
    assert sorted(a, key=lambda r: r.id) == b


def test_chunks_are_bounded_and_ordered(spark):
    df = frame(spark, [("hot", 5, i, OPEN, 1) for i in range(1000)])  # one instant
    out, split = split_hot_keys(df, ["key"], "ts", "id", SPLIT)
    assert split
    sizes = out.groupBy("__chunk").agg(F.count("*").alias("n"), F.min("id"), F.max("id"))
    rows = sorted(sizes.collect())
    assert len(rows) > 20 and max(r.n for r in rows) < 120
    assert all(a["max(id)"] < b["min(id)"] for a, b in zip(rows, rows[1:]))


def split_equals_whole(df, keys, policy=SPLIT):
    whole, split = (Timeline(df, keys, "ts", "id", p) for p in (SplitPolicy(), policy))
    assert split.split and not whole.split
    kind, due = F.col("kind"), F.col("t") + F.col("width")
    cols = ["id", "w_due", "w_open", "w_pos", "w_first", "w_next", *keys]
    a, b = (line.windows(kind, due).select(cols).collect() for line in (whole, split))
    assert sorted(a, key=lambda r: r.id) == sorted(b, key=lambda r: r.id)
    return split.df


@pytest.mark.parametrize("kind", ["string", "long", "both"])
def test_null_hot_keys(spark, kind):
    """Rows without a key are one hot key like any other."""
    rng = random.Random(8)
    rows = [(None if i % 2 else f"k{i % 7}", rng.randrange(4000), i,
             rng.choice([OPEN, OPEN, PASS, RESET]), rng.choice([3, 90])) for i in range(600)]
    df = frame(spark, rows)
    number = F.substring("key", 2, 1).cast("long")
    if kind == "long":
        df = df.withColumn("key", number)
    keys = ["key"]
    if kind == "both":
        df, keys = df.withColumn("other", number), ["key", "other"]
    out = split_equals_whole(df, keys)
    assert out.filter("key is null and __chunk is null").count() == 0


def test_an_exploded_hot_key_is_seen(spark):
    """Rows are counted: the optimizer's estimate does not grow with an explode."""
    few = spark.createDataFrame([("hot", 10)], "key string, width long")
    df = few.select("*", F.explode(F.sequence(F.lit(0), F.lit(499))).alias("id")).select(
        "key", "width", F.col("id").cast("long"), F.col("id").cast("long").alias("t"),
        F.lit(OPEN).alias("kind"), F.timestamp_micros("id").alias("ts"))
    assert split_hot_keys(df, ["key"], "ts", "id", SPLIT)[1]


def test_every_hot_key_is_split(spark):
    rows = [(f"k{i % 300}", i, i, OPEN, 5) for i in range(300 * 50)]
    out, _ = split_hot_keys(frame(spark, rows), ["key"], "ts", "id", SPLIT)
    sizes = out.groupBy("key", "__chunk").count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] <= 20 and sizes[1] >= 300 * 3
    assert out.filter("__chunk is null").count() == 0


def test_bursts_are_cut_again(spark):
    """Nearly all rows of a key in one short burst, far from the others."""
    rng = random.Random(9)
    rows = [("hot", rng.choice([0, 10**12]), i, OPEN, 50) for i in range(20)]
    rows += [("hot", 5 * 10**11 + rng.randrange(400), 20 + i, rng.choice([OPEN, PASS]), 9)
             for i in range(1500)]
    out = split_equals_whole(frame(spark, rows), ["key"])
    assert out.groupBy("__chunk").count().agg(F.max("count")).first()[0] <= 20


def test_one_instant_with_text_ties(spark):
    rows = [("hot", 5, i, OPEN, 1) for i in range(400)]
    df = frame(spark, rows).withColumn("id", F.format_string("row %05d", "id"))
    out, split = split_hot_keys(df, ["key"], "ts", "id", SPLIT)
    parts = sorted(out.groupBy("__chunk").agg(F.min("id").alias("a"), F.max("id").alias("b"))
                   .collect())
    assert split and all(x.b < y.a for x, y in zip(parts, parts[1:]))
    assert out.groupBy("__chunk").count().agg(F.max("count")).first()[0] <= 20


def test_one_instant_with_ties_that_begin_alike(spark):
    """Long common beginnings, ties within others, equal ties, none and odd signs."""
    rng = random.Random(4)
    begin = "gateway/eu-central/é日本/"
    ties = [begin + "".join(rng.choice("ab\x00ü") for _ in range(rng.randrange(12))) for _ in range(500)]
    ties += [begin + "equal"] * 60 + ["", "a", begin[:9]]
    rows = [("hot", 5, i, OPEN, 1) for i in range(len(ties))]
    texts = spark.createDataFrame(list(enumerate(ties)), "n long, tie string")
    df = frame(spark, rows).withColumnRenamed("id", "n").join(texts, "n")
    out, split = split_hot_keys(df, ["key"], "ts", "tie", SPLIT)
    assert split and out.count() == len(ties)
    parts = {}
    for row in out.collect():
        parts.setdefault(row["__chunk"], []).append(row.tie.encode())
    ordered = [parts[label] for label in sorted(parts)]
    ends = [(min(x), max(x)) for x in ordered]
    # NUL bytes and ends of texts count alike, so only those may meet in one chunk
    plain = [(a.rstrip(b"\0"), b.rstrip(b"\0")) for a, b in ends]
    assert all(x[1] < y[0] for x, y in zip(plain, plain[1:]))
    assert all(len({t.rstrip(b"\0") for t in x}) == 1 for x in ordered if len(x) > 20)


def test_late_rows_by_buckets_of_windows(spark, monkeypatch):
    import random
    from datetime import datetime, timedelta, timezone

    from pyspark.sql import functions as F

    from alarmloom.operators import windows

    monkeypatch.setattr(windows, "WINDOWS_AT_ONCE", 3)
    rng = random.Random(3)
    # minutes around 1970, about one row a window of ten minutes, some far behind
    made = [(i, 10 * i - 1500 - rng.choice([0, 0, 5, 25, 60, 400]), i // 2) for i in range(300)]
    zero = datetime(1970, 1, 1, tzinfo=timezone.utc)
    rows = [(i, zero + timedelta(minutes=t), zero + timedelta(minutes=a)) for i, t, a in made]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp, arrival timestamp")
    got = windows.drop_late(windows.tumbling(df, "ts", "10 minutes"), "ts", "arrival", "event_id", 1_800_000)
    want, highest = set(), None
    for i, t, _ in made:  # made is in order of arrival
        if highest is None or highest < t // 10 * 10 + 10 + 30:
            want.add(i)
        highest = t if highest is None else max(highest, t)
    assert 0 < len(want) < 300
    assert {r.event_id for r in got.select("event_id").collect()} == want and got.count() == len(want)


# -- transfer tables of hot keys ---------------------------------------------------


def chunk_tables(rows, size, width):
    import pandas as pd

    reduce = TL._transfer(["key"])
    return [
        reduce(pd.DataFrame(
            [("k", t, i, kind, t + w, width) for _, t, i, kind, w in rows[at:at + size]],
            columns=["key", "__ts", "__tie", "__kind", "__due", "__width"],
        )).to_dict("records")[0]
        for at in range(0, len(rows), size)
    ]


def sorted_rows(seed, reset_share, widths):
    rng = random.Random(seed)
    times = sorted(rng.randrange(2000) for _ in range(300))
    return [
        ("k", t, i, RESET if rng.random() < reset_share else rng.choice([OPEN, PASS]), rng.choice(widths))
        for i, t in enumerate(times)
    ]


@pytest.mark.parametrize("reset_share", [0.0, 0.01, 0.2])
@pytest.mark.parametrize("size", [1, 2, 7, 50])
def test_tables_combine_in_any_grouping(size, reset_share):
    for seed in range(6):
        widths = [3, 40] if seed % 2 else [300]
        rows = sorted_rows(seed, reset_share, widths)
        tables = chunk_tables(rows, size, max(widths))
        start = (TL.NONE, TL.NONE, 0, TL.NONE)
        one_by_one = functools.reduce(lambda s, t: TL._through(t, s), tables, start)
        found = brute_windows(rows)[rows[-1][2]] if rows[-1][3] != RESET else None
        if found and found[0] is not None:
            assert one_by_one == found[:4]
        rng = random.Random(seed)
        while len(tables) > 1:  # neighbours in random order
            at = rng.randrange(len(tables) - 1)
            tables[at:at + 2] = [TL.combine(tables[at], tables[at + 1])]
        assert TL._through(tables[0], start) == one_by_one


def test_a_window_from_before_goes_through_tables_as_through_one():
    rows = sorted_rows(3, 0.0, [25])
    tables = chunk_tables(rows, 9, 25)
    whole = functools.reduce(TL.combine, tables)
    for due in range(rows[0][1], rows[0][1] + 26):
        start = (due, due - 25, 2, 7)
        assert TL._through(whole, start) == functools.reduce(
            lambda s, t: TL._through(t, s), tables, start)


def test_tables_of_periodic_rows_stay_small():
    """One entry per window that may be open, however many chunks are combined."""
    rows = [("k", 10 * i, i, OPEN, 50) for i in range(2000)]
    whole = functools.reduce(TL.combine, chunk_tables(rows, 20, 50))
    assert len(whole["until"]) <= 7


@pytest.mark.parametrize("fan", [2, 3])
def test_rounds_of_combined_tables_match_brute_force(spark, monkeypatch, fan):
    monkeypatch.setattr(TL, "FAN", fan)
    rows = make_rows(6, reset_share=0.02)
    rows += [(None, 10 * i, 10_000_000 + i, OPEN, 50) for i in range(300)]
    line = Timeline(frame(spark, rows), ["key"], "ts", "id", SPLIT)
    got = line.windows(F.col("kind"), F.col("t") + F.col("width")).collect()
    found = {r.id: (r.w_due, r.w_open, r.w_pos, r.w_first, r.w_next) for r in got}
    assert found == brute_windows(rows)


def many_chunks(seed, size, reset_share, widths):
    """Chunks of several keys one after the other, each key's times from zero on."""
    chunks = []
    for key in range(8):
        rows = sorted_rows(seed + key, reset_share, widths)
        chunks += [rows[at:at + size] for at in range(0, len(rows), size)]
    return chunks


@pytest.mark.parametrize("reset_share", [0.0, 0.01, 0.2])
@pytest.mark.parametrize("size,widths", [(1, [3]), (5, [3, 40]), (50, [300]), (300, [3, 40])])
def test_chunks_reduced_at_once_are_those_reduced_alone(size, reset_share, widths):
    chunks = many_chunks(11, size, reset_share, widths)
    flat = np.array([(t, kind, t + w, max(widths)) for c in chunks for _, t, _, kind, w in c])
    starts = np.cumsum([0] + [len(c) for c in chunks])[:-1]
    columns = TL._table_columns(TL.chunk_tables(starts, *flat.T))
    names = [f.name for f in TL._TRANSFER_FIELDS]
    got = [dict(zip(names, row)) for row in zip(*[c.to_pylist() for c in columns])]
    alone = [chunk_tables(c, size, max(widths))[0] for c in chunks]
    assert got == [{n: table[n] for n in names} for table in alone]


@pytest.mark.parametrize("batch", [1, 3, 64, 10_000])
def test_tables_do_not_depend_on_batches(batch):
    """Chunks and groups of tables that go on in the next batches."""
    chunks = many_chunks(5, 7, 0.01, [40])
    rows = pa.RecordBatch.from_pylist([
        {"key": "k", "__chunk": n, "__ts": t, "__kind": kind, "__due": t + w, "__width": 40,
         "__first": i == 0}
        for n, c in enumerate(chunks) for i, (_, t, _, kind, w) in enumerate(c)
    ])

    def table(batches):
        return pa.Table.from_batches(list(batches)).to_pylist()

    def cut(whole):
        return (whole.slice(at, batch) for at in range(0, len(whole), batch))

    got = table(TL._tables(["key", "__chunk"])(cut(rows)))
    alone = [chunk_tables(c, 7, 40)[0] for c in chunks]
    assert [r.pop("__chunk") for r in got] == list(range(len(chunks)))
    assert got == alone
    # 344 tables as one key: groups of three, and the states within each group
    last = len(alone) - 1
    numbered = [r | {"__i": i, "__last": last} for i, r in enumerate(alone)]
    fields = [pa.field("key", pa.string())] + [
        pa.field(f.name, TL.to_arrow_type(f.dataType)) for f in TL._TRANSFER_FIELDS
    ] + [pa.field(c, pa.int64()) for c in ("__i", "__last")]
    members = pa.RecordBatch.from_pylist(numbered, schema=pa.schema(fields))
    groups = [alone[at:at + 3] for at in range(0, len(alone), 3)]
    assert table(TL._combined(["key"], 3)(cut(members))) == [
        {"key": "k", "__i": g, "__last": last // 3, **{
            f.name: functools.reduce(TL.combine, group)[f.name] for f in TL._TRANSFER_FIELDS}}
        for g, group in enumerate(groups)
    ]
    begin = (500, 460, 2, 80)
    for c, value in zip(TL._CARRY, begin):
        members = members.append_column(c, pa.array([value] * len(members), pa.int64()))
    want = []
    for group in groups:
        state = begin
        for one in group:
            want.append(state)
            state = TL._through(one, state)
    found = table(TL._handed_down(["__i"], 3)(cut(members)))
    assert [tuple(r[c] for c in TL._CARRY) for r in found] == want


def test_small_chunks_are_not_python_groups(spark):
    """A call per chunk of a few rows took longer than all the rest of the work."""
    rows = [(f"k{i % 40}", i, i, OPEN, 5) for i in range(40 * 50)]
    line = Timeline(frame(spark, rows), ["key"], "ts", "id", SPLIT)
    found = line.windows(F.col("kind"), F.col("t") + F.col("width"))
    assert found.count() == len(rows)
    plans = found._jdf.queryExecution().toString()
    assert "FlatMapGroupsIn" not in plans and "MapInArrow" in plans
