"""Tables of copy-on-write buckets: what an update writes, reads and leaves."""

import os
import time

import pytest
from pyspark.sql import functions as F

from alarmloom.operators import changes as C
from alarmloom.streaming import tables as TB


def folder_of(tmp_path):
    return str(tmp_path / "table")


def size(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet"))


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def bindings(spark, n, start=0):
    return spark.range(start, n).select(
        F.concat(F.lit("gateway "), F.col("id").cast("string")).alias("sn"),
        F.explode(F.array(F.col("id") * 2, F.col("id") * 2 + 1)).alias("machine_id"),
    )


def drop_gateways(rows, changes):
    return rows.join(changes.select("sn").distinct(), "sn", "left_anti")


def one(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "sn string")


def test_bytes_written_follow_the_change(spark, tmp_path):
    folder = folder_of(tmp_path)
    whole = bindings(spark, 20_000)
    TB.write_table(whole, folder, ["sn"], 64)
    before = size(folder)
    touched = TB.update_table(folder, one(spark, "gateway 7"), drop_gateways, 0)
    assert len(touched) == 1
    assert size(folder) - before < before / 20
    assert rows_of(TB.read_table(spark, folder)) == rows_of(whole.where("sn <> 'gateway 7'"))
    assert rows_of(TB.read_table(spark, folder, before=0)) == rows_of(whole)
    grown = size(folder)
    assert TB.update_table(folder, one(spark), drop_gateways, 1) == []
    assert size(folder) == grown  # nothing changed, nothing written
    assert TB.read_table(spark, folder).count() == 39_998


def test_a_slow_reader_keeps_its_files(spark, tmp_path):
    folder = folder_of(tmp_path)
    TB.write_table(bindings(spark, 500), folder, ["sn"], 8)
    reader = TB.read_table(spark, folder)
    for n in range(4):
        TB.update_table(folder, one(spark, *[f"gateway {i}" for i in range(100 * n, 100 * n + 100)]), drop_gateways, n)
        TB.expire(spark, folder, older_than_s=3600)
    assert reader.count() == 1000  # the first version, four versions later
    kept = size(folder)
    TB.expire(spark, folder, older_than_s=3600, now=time.time() + 7200)
    assert size(folder) < kept
    assert os.listdir(f"{folder}/manifests") and TB.read_table(spark, folder, before=3) is None
    assert rows_of(TB.read_table(spark, folder)) == rows_of(bindings(spark, 500, 400))


def test_files_that_later_versions_share_stay(spark, tmp_path):
    folder = folder_of(tmp_path)
    TB.write_table(bindings(spark, 300), folder, ["sn"], 8)
    for n in range(3):
        TB.update_table(folder, one(spark, f"gateway {n}"), drop_gateways, n)
    TB.expire(spark, folder, older_than_s=0, now=time.time() + 60)
    assert rows_of(TB.read_table(spark, folder)) == rows_of(bindings(spark, 300, 3))


def test_a_repeated_batch_gives_the_same_table(spark, tmp_path):
    folder = folder_of(tmp_path)
    TB.write_table(spark.createDataFrame([("a", 1)], "sn string, n long"), folder, ["sn"], 4)

    def count_up(rows, changes):
        return rows.withColumn("n", F.col("n") + 1)

    for number in (0, 1, 1, 1):
        TB.update_table(folder, one(spark, "a"), count_up, number)
    assert rows_of(TB.read_table(spark, folder)) == [("a", 3)]


def test_rows_of_other_keys_are_refused(spark, tmp_path):
    folder = folder_of(tmp_path)
    TB.write_table(bindings(spark, 50), folder, ["sn"], 16)
    with pytest.raises(ValueError, match="not in the changes"):
        TB.update_table(folder, one(spark, "gateway 1"), lambda rows, _: bindings(spark, 50), 0)
    assert TB.read_table(spark, folder).count() == 100  # the version before


def test_empty_tables_and_null_keys(spark, tmp_path):
    folder = folder_of(tmp_path)
    TB.write_table(spark.createDataFrame([], "sn string, machine_id long"), folder, ["sn"], 4)
    assert TB.read_table(spark, folder).count() == 0
    assert TB.read_table(spark, folder, before=-1) is None
    assert TB.read_table(spark, str(tmp_path / "none")) is None
    fresh = spark.createDataFrame([(None, 1), ("a", None), ("", 2)], "sn string, machine_id long")
    TB.update_table(folder, fresh, lambda rows, new: rows.unionByName(new), 0)
    TB.update_table(folder, one(spark, None), lambda rows, _: rows.where("sn is not null"), 1)
    assert rows_of(TB.read_table(spark, folder)) == [("", 2), ("a", None)]


def test_resyncs_by_bucket_equal_resyncs_of_the_whole(spark, tmp_path):
    """Bind and unbind, points of gateways, controls of alarms: touched buckets suffice."""
    relation = spark.createDataFrame(
        [(f"gateway {i}", 10 * i) for i in range(0, 40, 3)], "device_sn string, machine_id long")
    changed = spark.createDataFrame(
        [(f"gateway {i}", i % 2 == 0) for i in range(0, 30, 2)] + [("gateway 33", False)], "sn string, bind boolean")
    whole = bindings(spark, 40)
    cases = {
        "machines": (whole, ["sn"], changed, lambda t, c: C.rebind_machines(t, relation, c)),
    }
    points = whole.select("sn", F.lit(1).cast("long").alias("device_template_point_id"), F.col("machine_id").alias("id"))
    of_points = relation.select(F.col("device_sn").alias("device_no"), F.lit(2).cast("long").alias("device_template_point_id"), F.col("machine_id").alias("id"))
    cases["points"] = (points, ["sn"], changed, lambda t, c: C.resync_gateway_points(t, of_points, c))
    rules = spark.createDataFrame([(100 + i, str(i % 7)) for i in range(20)], "id long, rely_rule_id string")
    controls = spark.createDataFrame([(i, 200 + i) for i in range(9)], "alarm_id long, control_id long")
    alarms = spark.createDataFrame([(3,), (5,), (8,)], "alarm_id long")
    cases["controls"] = (controls, ["alarm_id"], alarms, lambda t, c: C.resync_alarm_controls(t, rules, c))
    for name, (target, keys, log, apply) in cases.items():
        folder = str(tmp_path / name)
        TB.write_table(target, folder, keys, 32)
        TB.update_table(folder, log, apply, 0)
        assert rows_of(TB.read_table(spark, folder)) == rows_of(apply(target, log)), name
