"""Idle sources, windows of the wall clock, and the state of a job read as a table."""

import json
import os

import pytest
from pyspark.sql import functions as F

from alarmloom.operators import alarms as A
from alarmloom.streaming import jobs as J

STATUS = "sn string, status string, ts timestamp, event_id long"


@pytest.fixture(autouse=True)
def few_state_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def put(folder, n, rows):
    """One file, one micro-batch; rows: (sn, status, second, event_id)."""
    folder.mkdir(exist_ok=True)
    path = folder / f"{n}.json"
    path.write_text("".join(
        json.dumps({"sn": sn, "status": status, "event_id": i,
                    "ts": f"2024-01-01T00:{s // 60:02d}:{s % 60:02d}"}) + "\n"
        for sn, status, s, i in rows))
    os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))


def stream(spark, folder):
    return spark.readStream.schema(STATUS).option("maxFilesPerTrigger", 1).json(str(folder))


def alarms_of(spark, tmp_path, name, beat):
    """Offline alarms of a fast and another source, with or without ticks for both."""
    fast, other = (stream(spark, tmp_path / n) for n in ("fast", "other"))
    ticks = stream(spark, tmp_path / "ticks").select("ts")
    if beat:
        fast, other = (J.with_heartbeat(s, ticks, "30 seconds", "1 second") for s in (fast, other))
    else:
        fast, other = (s.withWatermark("ts", "1 second") for s in (fast, other))
    # a watermark of its own would be that of the union: each source keeps its own
    watched = J.offline_watch(fast.unionByName(other), F.lit(10), watermark="", bucket_delay="1 second")
    out = str(tmp_path / f"out-{name}")
    query = J.write_alarms(
        watched, str(tmp_path / f"cp-{name}"), {"alarm": J.batch_folder(out)}
    ).trigger(availableNow=True).start()
    assert query.awaitTermination(120)
    return sorted((r.sn, r.event_id) for r in spark.read.parquet(out).select("sn", "event_id").collect())


def test_a_silent_source_holds_no_alarm_back(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "min")
    put(tmp_path / "fast", 0, [("a", "0", 5, 1), ("b", "0", 6, 2)])
    put(tmp_path / "fast", 1, [("b", "1", 9, 3)])
    put(tmp_path / "other", 0, [("c", "1", 3, 4)])  # and then nothing more
    for n, second in enumerate((20, 90, 120)):
        put(tmp_path / "ticks", n, [(None, None, second, None)])
    assert alarms_of(spark, tmp_path, "idle", True) == [("a", 1)]
    assert alarms_of(spark, tmp_path, "stuck", False) == []


def test_an_active_slow_source_loses_no_row(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "min")
    for n in range(4):  # both sources go on; the other lags by 25 s
        put(tmp_path / "fast", n, [("a", "1", 30 + 30 * n, 10 + n)])
        put(tmp_path / "other", n, [(f"c{n}", "0", 5 + 30 * n, 20 + n)])
        put(tmp_path / "ticks", n, [(None, None, 30 + 30 * n, None)])
    put(tmp_path / "ticks", 4, [(None, None, 300, None)])
    put(tmp_path / "ticks", 5, [(None, None, 310, None)])
    assert alarms_of(spark, tmp_path, "slow", True) == [(f"c{n}", 20 + n) for n in range(4)]


def test_a_window_of_the_wall_clock_closes_without_a_new_row(spark, tmp_path):
    put(tmp_path / "in", 0, [("a", "0", 1, 1), ("a", "1", 2, 2), ("b", "0", 3, 3)])
    query = (
        J.arrival_windows(stream(spark, tmp_path / "in"), ["sn"], "2 seconds")
        .writeStream.format("memory").queryName("arrivals").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(processingTime="300 milliseconds").start()
    )
    try:
        for _ in range(60):
            if spark.table("arrivals").count() >= 3:
                break
            query.awaitTermination(1)
    finally:
        query.stop()
    got = spark.table("arrivals").select("*", F.unix_millis("start").alias("s"), F.unix_millis("end").alias("e")).collect()
    assert sorted(r.event_id for r in got) == [1, 2, 3]
    assert all(r.s % 2000 == 0 and r.e == r.s + 2000 for r in got)
    assert len({r.s for r in got if r.sn == "a"}) == 1


def test_keys_in_alarm_are_read_from_the_checkpoint(spark, tmp_path):
    rows = [("a", "0", 5, 1), ("b", "0", 6, 2), ("b", "1", 40, 3), ("c", "0", 7, 4), ("c", "1", 9, 5), ("d", "0", 50, 6)]
    put(tmp_path / "in", 0, rows)
    put(tmp_path / "in", 1, [("tick", "1", 100, 7)])
    put(tmp_path / "in", 2, [("tick", "1", 101, 8)])
    watched = J.offline_watch(stream(spark, tmp_path / "in"), F.lit(10))
    checkpoint = str(tmp_path / "cp")
    query = J.write_alarms(watched, checkpoint, {"alarm": J.batch_folder(str(tmp_path / "out"))})
    assert query.trigger(availableNow=True).start().awaitTermination(120)
    found = sorted(r.sn for r in J.keys_in_alarm(spark, checkpoint).collect())
    status = spark.read.schema(STATUS).json(str(tmp_path / "in"))
    held = A.offline_alarms(status, F.lit(10), horizon=F.lit(1_704_067_200_000_000 + 99_000_000))
    last = held.groupBy("sn").agg(F.max_by("status", "emit_us").alias("status"))
    assert found == sorted(r.sn for r in last.filter("status = '0'").collect()) == ["a", "d"]
