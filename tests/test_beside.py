"""Changes beside a running stream: whatever the batching, the result is that of batch."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from alarmloom.operators import changes as C
from alarmloom.streaming import jobs as J

BASE = 1_704_067_200  # seconds
SCHEMA = "sn string, id long, t double, v string, action string, rules string"


@pytest.fixture(autouse=True)
def few_state_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def write(folder, batches):
    folder.mkdir(parents=True)
    for n, rows in enumerate(batches):
        path = folder / f"{n}.json"
        path.write_text("".join(json.dumps(r) + "\n" for r in rows))
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))


def stream(spark, folder, at_once):
    read = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", at_once)
    return read.json(str(folder)).withColumn("ts", F.timestamp_seconds(F.col("t") + BASE))


def table(spark, rows):
    keys = [c.split()[0] for c in SCHEMA.split(", ")]
    frame = spark.createDataFrame([tuple(r.get(k) for k in keys) for r in rows], SCHEMA)
    return frame.withColumn("ts", F.timestamp_seconds(F.col("t") + BASE))


def collected(df, tmp_path, name):
    out = str(tmp_path / f"out-{name}")
    query = (
        df.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", str(tmp_path / f"cp-{name}"))
        .trigger(availableNow=True).start()
    )
    assert query.awaitTermination(120)
    return df.sparkSession.read.parquet(out)


def made(seed):
    """Data and changes over 100 s, some at one instant, in the order they arrive."""
    rng = random.Random(seed)
    data = [{"sn": rng.choice("abc"), "id": i, "t": rng.randrange(200) / 2} for i in range(150)]
    log = [
        {"sn": rng.choice("ab"), "id": 1000 + i, "t": rng.randrange(200) / 2,
         "v": rng.choice(["x", "y", None]), "action": rng.choice("00012"),
         "rules": rng.choice(["1", "2, 3", "", "4,"])}
        for i in range(40)
    ]
    for rows in (data, log):  # up to 8 s out of order
        rows.sort(key=lambda r: r["t"] + rng.uniform(0, 8))
    return data, log


def split(rows, parts):
    """Batches of equal spans of time, so that both streams move on together."""
    edges = [100 * (n + 1) / parts for n in range(parts - 1)]
    out = [[] for _ in range(parts)]
    for r in rows:
        out[sum(r["t"] >= e for e in edges)].append(r)
    return out


TICK = [{"sn": "tick", "id": -1, "t": 1000.0}]


@pytest.mark.parametrize("parts", [1, 6])
def test_as_of_watch_equals_batch(spark, tmp_path, parts):
    data, log = made(parts)
    untimed = [{"sn": "a", "id": 500, "t": None}]
    write(tmp_path / "data", [*split(data, parts), untimed + TICK])
    write(tmp_path / "log", [*split(log, parts), [{**TICK[0], "v": "z"}]])
    rows, changes = (stream(spark, tmp_path / n, 1).drop("t", "action", "rules") for n in ("data", "log"))
    got = collected(
        J.as_of_watch(rows.drop("v"), changes, "sn", F.col("v"), "version", tie="id", watermark="20 seconds"),
        tmp_path, "as-of",
    )
    want = C.as_of_changes(
        table(spark, data + untimed).drop("v", "t", "action", "rules"), table(spark, log),
        "sn", "ts", "id", F.col("v"), "version",
    )
    found = [tuple(r) for r in got.select("id", "version").collect() if r.id != -1]
    assert sorted(found, key=repr) == sorted(map(tuple, want.select("id", "version").collect()), key=repr)


def plain_mapping(data, log):
    out = []
    for row in data:
        rules = []
        for change in sorted(log, key=lambda r: (r["t"], r["id"])):
            if change["sn"] == row["sn"] and change["t"] <= row["t"]:
                if change["action"] == "0":
                    rules += [x.strip() for x in change["rules"].split(",") if x.strip()]
                elif change["action"] == "2":
                    rules = []
        out += [(row["id"], int(rule)) for rule in rules]
    return sorted(out)


@pytest.mark.parametrize("parts", [1, 5])
def test_rules_change_beside_the_points(spark, tmp_path, parts):
    data, log = made(10 + parts)
    write(tmp_path / "data", [*split(data, parts), TICK])
    write(tmp_path / "log", [*split(log, parts), []])
    rows = stream(spark, tmp_path / "data", 1).select("sn", "id", "ts")
    changes = stream(spark, tmp_path / "log", 1).select(
        F.lit("0").alias("type"), F.col("sn").alias("id_"), "action", F.split("rules", ",").alias("rule_ids"), "id", "ts"
    )
    changes = changes.withColumnsRenamed({"id": "seq"}).withColumnRenamed("id_", "id")
    rows = rows.withColumnRenamed("id", "seq")
    got = collected(
        J.mapped_points(rows, changes, point="sn", tie="seq", watermark="20 seconds"), tmp_path, "mapped"
    )
    assert sorted(map(tuple, got.select("seq", "rule_id").collect())) == plain_mapping(data, log)
