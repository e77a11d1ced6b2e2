"""Streams against their batch forms, and restart from a checkpoint."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from alarmloom.operators import alarms as A
from alarmloom.operators import frequency as Q
from alarmloom.plans import testbed as B
from alarmloom.streaming import jobs as J
from alarmloom.streaming import tables

HOUR = 3600
BATCHES = 4
TICK = "-1"
TICK_US = 1_709_251_200_000_000
WATERMARK_END = TICK_US - 1_000_000


def write_status(rows, folder):
    """The status rows as JSON files in the given order, one file per micro-batch."""
    share = -(-len(rows) // BATCHES)
    paths = []
    for n in range(BATCHES):
        path = folder / f"{n}.json"
        with open(path, "w") as f:
            for r in rows[n * share:(n + 1) * share]:
                f.write(json.dumps({"sn": r.sn, "status": r.status,
                                    "ts": r.ts.isoformat(), "event_id": r.event_id}))
                f.write("\n")
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))
        paths.append(path)
    # Moves the watermark past the end of the data; its own rows are left out below.
    tick = folder / "tick.json"
    tick.write_text(json.dumps({"sn": TICK, "status": "1", "event_id": -1,
                                "ts": "2024-03-01T00:00:00"}) + "\n")
    os.utime(tick, (1_700_000_100, 1_700_000_100))
    return folder


@pytest.fixture(scope="module")
def status_files(spark, small_dir, tmp_path_factory):
    rows = B.status(spark, small_dir).orderBy("ts", "event_id").collect()
    return write_status(rows, tmp_path_factory.mktemp("status"))


@pytest.fixture(scope="module")
def shuffled_files(spark, small_dir, tmp_path_factory):
    """Rows up to ten hours out of order, within and across micro-batches."""
    rng = random.Random(4)
    rows = B.status(spark, small_dir).collect()
    rows.sort(key=lambda r: r.ts.timestamp() + rng.uniform(0, 10 * HOUR))
    return write_status(rows, tmp_path_factory.mktemp("shuffled"))


@pytest.fixture(params=["1 second", "12 hours"], ids=["sorted", "shuffled"])
def arrival(request, status_files, shuffled_files):
    """Files, watermark delay and the watermark (us) after the last of them."""
    if request.param == "1 second":
        return status_files, request.param, TICK_US - 1_000_000
    return shuffled_files, request.param, TICK_US - 12 * HOUR * 1_000_000


def stream_of(spark, folder):
    return (
        spark.readStream.schema("sn string, status string, ts timestamp, event_id long")
        .option("maxFilesPerTrigger", 1)
        .json(str(folder))
    )


@pytest.fixture(autouse=True)
def few_state_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def run(df, tmp_path, mode="append"):
    out = str(tmp_path / "out")
    seen = []

    def keep(batch, number):
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")
        seen.append(number)

    query = (
        df.writeStream.foreachBatch(keep).outputMode(mode)
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True).start()
    )
    assert query.awaitTermination(120)
    assert len(seen) >= BATCHES
    return df.sparkSession.read.parquet(out)


def by_gateway(even, odd):
    return F.when(F.col("sn").cast("bigint") % 2 == 0, even).otherwise(odd)


def test_offline_watch_equals_batch(spark, small_dir, arrival, tmp_path):
    files, watermark, end = arrival
    delay = by_gateway(6 * HOUR, 12 * HOUR)
    remind = by_gateway(HOUR, 5 * HOUR)
    stream = J.offline_watch(stream_of(spark, files), delay, remind, watermark=watermark)
    got = run(stream, tmp_path).filter(f"sn <> '{TICK}'")
    end = F.lit(end)
    alarms = A.offline_alarms(B.status(spark, small_dir), delay, horizon=end)
    want = sorted(
        (r.sn, "alarm" if r.status == "0" else "recover", r.emit_us, r.event_id)
        for r in alarms.collect()
    )
    found = [(r.sn, r.kind, r.emit_us, r.event_id) for r in got.collect()]
    assert sorted(f for f in found if f[1] != "push") == want
    episodes = alarms.select(
        "sn", "event_id", (F.col("status") == "0").alias("on"),
        F.timestamp_micros("emit_us").alias("ts"),
    )
    reminders = A.repeat_reminders(episodes, ["sn"], "on", remind, horizon=end)
    assert sorted((f[0], f[2]) for f in found if f[1] == "push") == sorted(
        (r.sn, r.due_us) for r in reminders.collect()
    )


def test_off_count_watch_equals_batch(spark, small_dir, arrival, tmp_path):
    files, watermark, _ = arrival
    width, limit = by_gateway(24 * HOUR, 72 * HOUR), by_gateway(2, 3)
    stream = J.off_count_watch(
        stream_of(spark, files), width, limit, watermark=watermark
    )
    got = run(stream, tmp_path).filter(f"sn <> '{TICK}'")
    want = Q.off_count_alarms(B.status(spark, small_dir), width, limit)
    cols = ["sn", "status", "emit_us", "event_id"]
    assert sorted(got.select(cols).collect()) == sorted(want.select(cols).collect())


def test_disconnect_watch_equals_batch(spark, small_dir, arrival, tmp_path):
    files, watermark, end = arrival
    width, limit = by_gateway(72 * HOUR, 168 * HOUR), by_gateway(1, 2)
    stream = J.disconnect_watch(
        stream_of(spark, files), width, limit, watermark=watermark
    )
    rows = run(stream, tmp_path).filter(f"sn <> '{TICK}'").collect()
    pairs = Q.disconnects(B.status(spark, small_dir))
    want = sorted((r.sn, r.event_id) for r in pairs.collect())
    assert sorted((r.sn, r.event_id) for r in rows if r.kind == "disconnect") == want
    alarms = Q.disconnect_frequency(pairs, width, limit, horizon=F.lit(end))
    found = sorted(
        (r.sn, "0" if r.kind == "alarm" else "1", r.emit_us, r.event_id)
        for r in rows if r.kind != "disconnect"
    )
    assert found == sorted(
        (r.sn, r.status, r.emit_us, r.event_id) for r in alarms.collect()
    )


def test_latest_per_key_and_by_name(spark, small_dir, status_files, tmp_path):
    got = run(J.latest_per_key(stream_of(spark, status_files), ["sn"]), tmp_path,
              mode="update")
    final = Q.latest_per_key(got.drop("batch"), ["sn"], "ts_us", "event_id").filter(
        f"sn <> '{TICK}'"
    )
    want = Q.latest_per_key(B.status(spark, small_dir), ["sn"], "ts", "event_id")
    whole = want.withColumn("ts_us", F.unix_micros("ts"))
    cols = ["sn", "ts_us", "event_id", "status"]
    assert sorted(final.select(cols).collect()) == sorted(whole.select(cols).collect())
    named = J.latest_by_name(stream_of(spark, status_files), ["sn"], "status")
    other = tmp_path / "named"
    other.mkdir()
    rows = run(named, other, mode="update")
    final = {(r.sn, r.name): r.t for r in rows.groupBy("sn", "name")
             .agg(F.max("latest_us").alias("t")).filter(f"sn <> '{TICK}'").collect()}
    want = B.status(spark, small_dir).groupBy("sn", "status").agg(
        F.unix_micros(F.max("ts")).alias("t")
    )
    assert final == {(r.sn, r.status): r.t for r in want.collect()}


def test_restart_from_checkpoint_gives_the_same_rows(
    spark, small_dir, status_files, tmp_path
):
    """Two runs over one checkpoint: first half of the files, then the rest."""
    delay = by_gateway(6 * HOUR, 12 * HOUR)
    staged = tmp_path / "staged"
    staged.mkdir()
    names = sorted(os.listdir(status_files))
    names = [n for n in names if n.endswith(".json")]

    def stage(part):
        for n in part:
            target = staged / n
            target.write_bytes((status_files / n).read_bytes())
            stat = os.stat(status_files / n)
            os.utime(target, (stat.st_mtime, stat.st_mtime))

    def go():
        stream = J.offline_watch(stream_of(spark, staged), delay)
        query = J.write_alarms(
            stream, str(tmp_path / "cp"),
            {k: J.batch_folder(str(tmp_path / k)) for k in ("alarm", "recover")},
        ).trigger(availableNow=True).start()
        assert query.awaitTermination(120)

    stage(names[:2])
    go()
    stage(names[2:])
    go()
    want = A.offline_alarms(B.status(spark, small_dir), delay,
                            horizon=F.lit(WATERMARK_END))
    for kind, status in (("alarm", "0"), ("recover", "1")):
        rows = spark.read.parquet(str(tmp_path / kind)).filter(f"sn <> '{TICK}'")
        expected = want.filter(F.col("status") == status)
        cols = ["sn", "emit_us", "event_id"]
        assert sorted(rows.select(cols).collect()) == sorted(
            expected.select(cols).collect()
        )


def sorted_rows(frame, *columns):
    return sorted(map(tuple, frame.select(*columns).collect()), key=repr)


def test_rule_job_equals_batch_job(spark, small_dir, tmp_path):
    """Points to alarms, notifications and commands: stream and batch job agree."""
    from alarmloom.plans import monitor as M

    dims = dimensions(spark, small_dir)
    points = B.points(spark, small_dir)
    folder = str(tmp_path / "job")
    mapping = str(tmp_path / "mapping")
    tables.write_table(mapping_of(dims), mapping, ["type", "id"], 16)
    feed = Feed(spark, points.schema, tmp_path, dims, mapping, folder)
    for part in ["<= '2024-01-12'", "> '2024-01-12'"]:
        feed.push(points.filter(f"ts {part}"))
    feed.tick(points)
    want = M.run(points, dims, str(tmp_path / "batch"), horizon=F.lit(WATERMARK_END))
    check_outputs(spark, folder, want)


def test_rules_that_change_under_a_running_job(spark, small_dir, tmp_path):
    """Mapping and rule tables change between micro-batches; each batch meets its own."""
    from dataclasses import replace

    from alarmloom.operators import changes as C
    from alarmloom.operators import rules as R
    from alarmloom.streaming import processors as P

    dims, points = dimensions(spark, small_dir), B.points(spark, small_dir)
    folder, mapping = str(tmp_path / "job"), str(tmp_path / "mapping")
    before = mapping_of(dims)
    tables.write_table(before, mapping, ["type", "id"], 16)
    # a third of the points lose their rules, another third gets a rule more
    ids = before.select("type", "id").distinct()
    log = ids.select(
        "type", "id",
        F.when(F.col("id") % 3 == 0, P.DELETE).otherwise(P.ADD).alias("action"),
        F.array((F.col("id") * 5 + 1).cast("string")).alias("rule_ids"),
        F.lit(0).alias("at"), F.monotonically_increasing_id().alias("seq"),
    ).filter("id % 3 < 2").withColumn("at", F.timestamp_seconds("at"))
    # and some rules are switched off
    after = replace(dims, rules=dims.rules.filter("id % 7 <> 0"))
    first, rest = (points.filter(f"ts {c}") for c in ["<= '2024-01-12'", "> '2024-01-12'"])
    feed = Feed(spark, points.schema, tmp_path, dims, mapping, folder)
    feed.push(first)
    tables.update_table(
        mapping, log, lambda now, some: C.apply_rule_changes(now, some, "at", "seq"), 0
    )
    feed.dims = after
    feed.push(rest)
    feed.tick(points)

    def rows(part, dims, version):
        details = R.rule_details(dims.rules, dims.elements, dims.actions)
        tagged = J.tag_stream(part, *J.watch_lists(version, details))
        kept = str(tmp_path / f"want-{dims is after}")
        J.hold_rows(tagged, "ts", "event_id").write.parquet(kept)
        return spark.read.parquet(kept)

    changed = tables.read_table(spark, mapping)
    assert changed.exceptAll(before).count() and before.exceptAll(changed).count()
    keys = ["unique_data_point_id", "rule_id"]
    want = A.delayed_alarms(
        rows(first, dims, before).unionByName(rows(rest, after, changed)),
        keys, "holds", F.col("delay"), horizon=F.lit(WATERMARK_END),
    )
    told = [*keys, "event_id", "emit_us", "sn", "datapoint_id"]
    for kind, recover in (("alarm", False), ("recover", True)):
        expected = sorted_rows(want.filter(F.col("recover") == recover), *told)
        assert sorted_rows(spark.read.parquet(f"{folder}/{kind}"), *told) == expected
        assert expected


def dimensions(spark, sf):
    from alarmloom.plans import monitor as M

    return M.Dimensions(
        B.rules(spark, sf), B.rule_elements(spark, sf), B.rule_actions(spark, sf),
        B.unique_rules(spark, sf), B.template_rules(spark, sf),
        B.point_relation(spark, sf), B.machine_relation(spark, sf),
    )


def mapping_of(dims):
    unique = dims.unique_rules.select(
        F.lit("0").alias("type"), F.col("unique_data_point_id").alias("id"), "rule_id"
    )
    template = dims.template_rules.select(
        F.lit("1").alias("type"), F.col("datapoint_id").alias("id"), "rule_id"
    )
    return unique.unionByName(template)


class Feed:
    """Runs both halves of the rule job over whatever has been pushed."""

    def __init__(self, spark, schema, tmp_path, dims, mapping, folder):
        self.spark, self.schema, self.dims = spark, schema, dims
        self.mapping, self.folder = mapping, folder
        self.source, self.checkpoints = str(tmp_path / "points"), tmp_path / "cp"

    def push(self, rows):
        rows.coalesce(1).write.mode("append").parquet(self.source)
        points = self.spark.readStream.schema(self.schema).parquet(self.source)
        tag = J.tag_batches(
            points, lambda _: self.dims, self.mapping, self.folder,
            str(self.checkpoints / "tag"),
        )
        assert tag.trigger(availableNow=True).start().awaitTermination(180)
        alarms = J.alarm_batches(
            self.spark, lambda _: self.dims, self.folder, str(self.checkpoints / "alarm")
        )
        assert alarms.trigger(availableNow=True).start().awaitTermination(180)

    def tick(self, points, us=TICK_US):
        """A point that no rule watches moves time on."""
        self.push(points.limit(1).withColumns({
            "unique_data_point_id": F.lit(-5).cast("long"),
            "datapoint_id": F.lit(-5).cast("long"),
            "event_id": F.lit(-1).cast("long"),
            "ts": F.timestamp_micros(F.lit(us)),
        }))


def check_outputs(spark, folder, want):
    keys = ["unique_data_point_id", "rule_id", "event_id"]
    told = [*keys, "emit_us", "sn", "datapoint_id"]
    for kind, recover in (("alarm", False), ("recover", True)):
        expected = want["alarms"].filter(F.col("recover") == recover)
        found = spark.read.parquet(f"{folder}/{kind}")
        assert sorted_rows(found, *told) == sorted_rows(expected, *told)
        assert found.count()
    payload = ["sn", "msg", "push_way", "trigger_json"]
    found = spark.read.parquet(f"{folder}/push")
    # a notification carries the rule's text; a batch alarm has its own in msg
    assert sorted_rows(found, *keys, F.col("emit_us").alias("push_us"), *payload) == (
        sorted_rows(want["pushes"], *keys, "push_us", *payload)
    )
    commands = spark.read.parquet(f"{folder}/commands").drop("batch").unionByName(
        spark.read.parquet(f"{folder}/direct").drop("batch")
    )
    columns = [c for c in want["commands"].columns if c != "trigger"]
    assert sorted_rows(commands, *columns) == sorted_rows(want["commands"], *columns)


def test_late_rows_are_dropped_by_the_watermark(spark, tmp_path):
    """Rows of a closed window do not count; rows within the delay do."""
    def rows(*times):
        return spark.createDataFrame([(t,) for t in times], "t long").select(
            F.timestamp_seconds("t").alias("ts"))

    source = str(tmp_path / "in")

    def go():
        stream = spark.readStream.schema("ts timestamp").parquet(source)
        counts = stream.withWatermark("ts", "5 seconds").groupBy(
            F.window("ts", "10 seconds")).count()
        out = counts.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        query = out.option("checkpointLocation", str(tmp_path / "cp")).trigger(
            availableNow=True).start()
        assert query.awaitTermination(120)

    for part in (rows(1, 2, 11), rows(3, 27), rows(4, 28), rows(60)):
        part.coalesce(1).write.mode("append").parquet(source)
        go()
    found = spark.read.parquet(str(tmp_path / "out"))
    got = {(r.s, r["count"]) for r in found.select(
        F.unix_seconds("window.start").alias("s"), "count").collect()}
    # 3 comes while its window is open, 4 after the watermark (22) has passed it
    assert got == {(0, 3), (10, 1), (20, 2)}


def test_mapping_kept_from_a_change_stream(spark, small_dir, tmp_path):
    """The mapping after every micro-batch of changes equals one pass over the log."""
    from alarmloom.functions import parsing as X
    from alarmloom.operators import changes as C

    log = B.rule_change_messages(spark, small_dir)
    source = tmp_path / "log"
    for n, part in enumerate(["< '1998-01-01'", ">= '1998-01-01'"]):
        path = str(source / str(n))
        log.filter(f"ts {part}").coalesce(1).write.parquet(path)
    folder = str(tmp_path / "mapping")
    tables.write_table(
        spark.createDataFrame([], "type string, id long, rule_id long"), folder, ["type", "id"], 16)

    def go():
        stream = spark.readStream.schema(log.schema).parquet(str(tmp_path / "in"))
        J.maintain_table(
            X.parse_rule_changes(stream), str(tmp_path / "cp"), folder,
            lambda now, batch: C.apply_rule_changes(now, batch, "ts", "seq"),
        ).trigger(availableNow=True).start().awaitTermination(120)

    for n in range(2):
        spark.read.parquet(str(source / str(n))).write.mode("append").parquet(
            str(tmp_path / "in"))
        go()
    got = tables.read_table(spark, folder)
    want = C.point_rule_mapping(X.parse_rule_changes(log), "ts", "seq")
    cols = ["type", "id", "rule_id"]
    assert sorted(got.select(cols).collect()) == sorted(want.select(cols).collect())
    assert got.count() > 0


def test_state_with_time_to_live(spark, tmp_path):
    """A key is told again once its state has expired, although its row is older."""
    source = tmp_path / "in"
    source.mkdir()

    def put(name, second):
        text = json.dumps({"sn": "a", "status": "1", "event_id": 1,
                           "ts": f"2024-01-01T00:00:{second:02d}"})
        (source / f"{name}.json").write_text(text + "\n")

    def told(n):
        for _ in range(60):
            if spark.table("latest_ttl").count() >= n:
                return True
            query.awaitTermination(1)
        return False

    put("first", 30)
    stream = J.latest_per_key(stream_of(spark, source), ["sn"], ttl_ms=3000)
    query = (
        stream.writeStream.format("memory").queryName("latest_ttl").outputMode("update")
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(processingTime="200 milliseconds").start()
    )
    try:
        assert told(1)
        query.awaitTermination(8)
        put("older", 10)
        assert told(2)
    finally:
        query.stop()
    times = [r.ts_us for r in spark.table("latest_ttl").collect()]
    assert times[0] > times[1]
