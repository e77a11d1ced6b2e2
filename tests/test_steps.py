"""Chained stateful steps, late rows routed, and streams that go on from a batch."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from alarmloom.operators import alarms as A
from alarmloom.operators import frequency as Q
from alarmloom.operators import windows as W
from alarmloom.operators.hotkeys import SplitPolicy
from alarmloom.plans import testbed as B
from alarmloom.streaming import handover as H
from alarmloom.streaming import jobs as J

HOUR = 3600
START_US = 1_704_067_200_000_000  # 2024-01-01
TICK, TICK_US = "-1", 1_709_251_200_000_000  # after all events
STATUS = "sn string, status string, ts timestamp, event_id long"
ROWS = (
    "sn string, ts timestamp, event_id long, holds boolean, delay long, "
    "push_interval long, push_once boolean"
)


@pytest.fixture(autouse=True)
def few_state_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def put(folder, batches):
    """One file per micro-batch, in order."""
    folder.mkdir(parents=True, exist_ok=True)
    for n, rows in enumerate(batches):
        path = folder / f"{n:03d}.json"
        path.write_text("".join(json.dumps(r, default=str) + "\n" for r in rows))
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))


def collect(df, folder, mode="append"):
    """All rows that a stream puts out until its source is used up."""
    out = str(folder / "out")
    query = (
        df.writeStream.foreachBatch(J.batch_folder(out)).outputMode(mode)
        .option("checkpointLocation", str(folder / "cp"))
        .trigger(availableNow=True).start()
    )
    assert query.awaitTermination(180)
    return df.sparkSession.read.schema(df.schema).parquet(f"{out}/batch=*")


def rows_of(frame, *columns):
    return sorted(map(tuple, frame.select(*columns).collect()), key=repr)


def parts(rows, n):
    share = -(-len(rows) // n)
    return [[r.asDict() for r in rows[i * share:(i + 1) * share]] for i in range(n)]


def by_gateway(even, odd):
    return F.when(F.col("sn").cast("bigint") % 2 == 0, even).otherwise(odd)


@pytest.mark.parametrize("watermark,mess", [("1 second", 0), ("12 hours", 10 * HOUR)])
def test_disconnects_and_their_frequency_as_two_steps(
    spark, small_dir, tmp_path, watermark, mess
):
    rng, status = random.Random(3), B.status(spark, small_dir)
    rows = sorted(
        status.collect(), key=lambda r: (r.ts.timestamp() + rng.uniform(0, mess), r.event_id)
    )
    tick = {"sn": TICK, "status": "1", "ts": "2024-03-01T00:00:00", "event_id": -1}
    put(tmp_path / "in", [*parts(rows, 4), [tick]])
    pairs = J.disconnect_pairs(stream(spark, tmp_path / "in", STATUS), watermark=watermark)
    width, limit = by_gateway(72 * HOUR, 168 * HOUR), by_gateway(1, 2)
    got = collect(J.frequency_watch(pairs, width, limit, watermark=watermark), tmp_path)
    end = TICK_US - (1_000_000 if not mess else 12 * HOUR * 1_000_000)
    want = Q.disconnect_frequency(Q.disconnects(status), width, limit, horizon=F.lit(end))
    kind = F.when(F.col("kind") == "alarm", "0").otherwise("1")
    found = rows_of(got, "sn", kind, "emit_us", "event_id")
    assert found == rows_of(want, "sn", "status", "emit_us", "event_id") and found


def test_late_rows_are_marked_and_none_is_lost(spark, tmp_path):
    rng, n = random.Random(5), 300
    batches, number = [], 0
    for b in range(6):
        rows = []
        for _ in range(n // 6):
            second = max(0, 60 * b + rng.randrange(-90, 60))
            rows.append({"sn": "a", "status": "1", "event_id": number,
                         "ts": f"2024-01-01T00:{second // 60:02d}:{second % 60:02d}"})
            number += 1
        # a repeated row, and one without columns but its time
        batches.append([*rows, rows[0], {"ts": rows[0]["ts"]}])
    put(tmp_path / "in", batches)
    windowed = W.tumbling(stream(spark, tmp_path / "in", STATUS), "ts", "10 seconds")
    got = collect(J.mark_late(windowed, delay="7 seconds", parts=8), tmp_path)
    told = ["sn", "status", "event_id", F.col("ts").cast("string"), F.col("end").cast("string")]
    seen = spark.read.schema(STATUS).json(str(tmp_path / "in")).withColumn(
        "batch", F.regexp_extract(F.input_file_name(), r"(\d+)\.json$", 1).cast("int")
    )
    timed = W.tumbling(seen.filter("ts IS NOT NULL"), "ts", "10 seconds")
    in_time = W.drop_late(
        timed.withColumn("one", F.lit(0)), "ts", "batch", "one", 7000
    )
    assert rows_of(got.filter("NOT late AND ts IS NOT NULL"), *told) == rows_of(in_time, *told)
    late = got.filter("late").count()
    assert 0 < late < n and got.count() == sum(map(len, batches))


@pytest.mark.parametrize("policy", [SplitPolicy(), SplitPolicy(target_rows=4)], ids=["whole", "split"])
def test_offline_alarms_go_on_from_a_batch(spark, small_dir, tmp_path, policy):
    status = B.status(spark, small_dir)
    cut = START_US + 12 * 24 * HOUR * 1_000_000 + 1
    delay, remind = by_gateway(6 * HOUR, 12 * HOUR), by_gateway(HOUR, 5 * HOUR)
    past, rest = (status.filter(c) for c in (F.unix_micros("ts") < cut, F.unix_micros("ts") >= cut))
    tick = {"sn": TICK, "status": "1", "ts": "2024-03-01T00:00:00", "event_id": -1}
    put(tmp_path / "in", [*parts(rest.orderBy("ts", "event_id").collect(), 3), [tick]])
    states = H.hold_states(
        J.offline_rows(status, delay, remind), ["sn"], F.lit(cut), policy=policy
    )
    watched = J.offline_watch(
        stream(spark, tmp_path / "in", STATUS), delay, remind, start=states
    )
    later = collect(watched, tmp_path).filter(f"sn <> '{TICK}'")
    end = F.lit(TICK_US - 1_000_000)
    before = A.offline_alarms(past, delay, horizon=F.lit(cut - 1))
    whole = A.offline_alarms(status, delay, horizon=end)
    kind = F.when(F.col("status") == "0", "alarm").otherwise("recover")
    told = ["sn", "emit_us", "event_id"]
    found = rows_of(before, *told, kind) + rows_of(later.filter("kind <> 'push'"), *told, "kind")
    assert sorted(found, key=repr) == rows_of(whole, *told, kind)

    def reminded(alarms, until):
        episodes = alarms.select("sn", "event_id", (F.col("status") == "0").alias("on"),
                                 F.timestamp_micros("emit_us").alias("ts"))
        return rows_of(A.repeat_reminders(episodes, ["sn"], "on", remind, horizon=until),
                       "sn", "due_us")

    pushes = reminded(before, F.lit(cut - 1)) + rows_of(later.filter("kind = 'push'"), "sn", "emit_us")
    assert sorted(pushes, key=repr) == reminded(whole, end)


def random_rows(seed):
    """Runs of all kinds; settings change within a key, times coincide with due times."""
    rng, out = random.Random(seed), []
    for i in range(400):
        second = rng.randrange(0, 600)
        out.append({
            "sn": str(rng.randrange(12)), "event_id": i, "holds": rng.random() < 0.75,
            "delay": rng.choice([0, 10, 20, 45]),
            "push_interval": rng.choice([None, 0, 7, 30]), "push_once": rng.random() < 0.4,
            "ts": f"2024-01-01T00:{second // 60:02d}:{second % 60:02d}",
        })
    return sorted(out, key=lambda r: (r["ts"], r["event_id"]))


@pytest.mark.parametrize("seed", [1, 2])
def test_a_job_from_a_batch_equals_a_job_from_the_start(spark, tmp_path, seed):
    rows = random_rows(seed)
    tick = {"sn": TICK, "event_id": -1, "holds": False, "ts": "2024-01-01T01:00:00"}
    at = "2024-01-01T00:05:00"
    cut = START_US + 300 * 1_000_000
    later = [r for r in rows if r["ts"] >= at]
    put(tmp_path / "all", [rows, [tick]])
    put(tmp_path / "rest", [later[:40], later[40:], [tick]])
    whole = spark.read.schema(ROWS).json(str(tmp_path / "all"))
    states = H.hold_states(whole, ["sn"], F.lit(cut), carry=["delay"])
    told = ["sn", "kind", "emit_us", "event_id", "delay"]

    def job(name, start):
        (tmp_path / f"run-{name}").mkdir()
        found = J.hold_alarms(stream(spark, tmp_path / name, ROWS), ["sn"], carry=["delay"], start=start)
        return collect(found, tmp_path / f"run-{name}").filter(F.col("emit_us") >= cut)

    want = rows_of(job("all", None), *told)
    assert rows_of(job("rest", states), *told) == want
    assert {r[1] for r in want} == {"alarm", "recover", "push"}


def test_no_past_leaves_no_state(spark):
    empty = spark.createDataFrame([], ROWS)
    assert H.hold_states(empty, ["sn"], F.lit(0)).count() == 0


def test_latest_rows_go_on_from_a_batch(spark, small_dir, tmp_path):
    status = B.status(spark, small_dir).select("sn", "status", "ts", "event_id")
    cut = START_US + 12 * 24 * HOUR * 1_000_000
    past = status.filter(F.unix_micros("ts") < cut)
    rest = status.filter(F.unix_micros("ts") >= cut).orderBy("ts", "event_id").collect()
    # a row older than what the batch has seen must not be told
    old = past.orderBy("ts", "event_id").first()
    put(tmp_path / "in", [[old.asDict()], *parts(rest, 2)])
    known = Q.latest_per_key(past, ["sn"], "ts", "event_id")
    first = known.filter(F.col("sn") == old.sn).first()
    assert first.event_id != old.event_id
    told = collect(
        J.latest_per_key(stream(spark, tmp_path / "in", STATUS), ["sn"], start=known),
        tmp_path, "update",
    )
    assert told.filter(F.col("event_id") == old.event_id).count() == 0
    cols = ["sn", "status", "ts_us", "event_id"]
    both = told.select(cols).unionByName(known.withColumn("ts_us", F.unix_micros("ts")).select(cols))
    want = Q.latest_per_key(status, ["sn"], "ts", "event_id").withColumn("ts_us", F.unix_micros("ts"))
    final = Q.latest_per_key(both, ["sn"], "ts_us", "event_id")
    assert rows_of(final, *cols) == rows_of(want, *cols)
