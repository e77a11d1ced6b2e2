"""The rule monitoring job over bounded data, from tables to tables.

Alarms are written first and read back: notifications and commands both start from
them, and a written table cuts the lineage, so a lost executor never repeats the
alarm detection.  Give a folder on shared storage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alarmloom.functions import scalars as S
from alarmloom.operators import alarms as A
from alarmloom.operators import control as K
from alarmloom.operators import push as P
from alarmloom.operators import rules as R
from alarmloom.operators.hotkeys import (
    CHECKED,
    CHUNK,
    DEFAULT_POLICY,
    SplitPolicy,
    split_hot_keys,
)
from alarmloom.storage import written

KEYS = ["unique_data_point_id", "rule_id"]


@dataclass(frozen=True)
class Dimensions:
    """Rule tables and mappings, as in alarmloom.schemas."""

    rules: DataFrame
    elements: DataFrame  # with ``position``
    actions: DataFrame
    unique_rules: DataFrame  # unique_data_point_id, rule_id
    template_rules: DataFrame  # datapoint_id, rule_id
    point_relation: DataFrame
    machine_relation: DataFrame


def resolve_points(points: DataFrame, point_relation: DataFrame) -> DataFrame:
    """The unique point of each data point, through (gateway, template point).

    Gateways report template points only; points no relation knows are dropped.
    """
    known = point_relation.select(
        F.col("id").alias("unique_data_point_id"),
        F.col("device_no").alias("sn"),
        F.col("device_template_point_id").alias("datapoint_id"),
    )
    return points.join(known, ["sn", "datapoint_id"])


def detect_alarms(
    points: DataFrame,
    watch: tuple[DataFrame, DataFrame],
    *,
    tie: str = "event_id",
    horizon: Column | None = None,
    literal: bool = False,
    policy: SplitPolicy = DEFAULT_POLICY,
) -> tuple[DataFrame, DataFrame]:
    """Alarm rows of all rules, and the tagged points they come from.

    ``points``: sn, datapoint_id, unique_data_point_id, val, ts, tie.  Hot points
    are split before the join, where profiling is cheap, and the chunks are carried
    along.
    """
    if horizon is None:
        horizon = A.end_of(points, "ts")
    ready, _ = split_hot_keys(points, ["unique_data_point_id"], "ts", tie, policy)
    tagged = R.tag_points(S.with_number(ready), *watch)
    holds = S.trigger_holds(F.col("text"), F.col("number"), F.col("trigger"), literal)
    rows = R.alarm_path(tagged).select(
        *KEYS, *A.chunk_of(tagged), tie, "ts", "sn", "datapoint_id", "val", "delay",
        holds.alias("holds"),
    )
    alarms = A.delayed_alarms(
        rows, KEYS, "holds", F.col("delay"), tie=tie, horizon=horizon, policy=CHECKED
    )
    return alarms, tagged


def run(
    points: DataFrame,
    dims: Dimensions,
    folder: str,
    *,
    tie: str = "event_id",
    horizon: Column | None = None,
    include_recover: bool = True,
    policy: SplitPolicy = DEFAULT_POLICY,
) -> dict[str, DataFrame]:
    """Write alarms, pushes and commands under ``folder`` and return them.

    ``include_recover`` lets recoveries drive control commands as well.
    """
    spark = points.sparkSession
    if horizon is None:
        horizon = A.end_of(points, "ts")
    details = written(R.rule_details(dims.rules, dims.elements, dims.actions))
    watch = (
        R.watch_list(dims.unique_rules, details),
        R.watch_list(dims.template_rules, details),
    )
    found, tagged = detect_alarms(
        points, watch, tie=tie, horizon=horizon, policy=policy
    )
    uuid = S.row_id(F.col(tie), F.col("rule_id")).alias("uuid")
    each = S.row_id(F.col(tie), F.col("rule_id"), F.col("mapping"))
    texts = details.select(
        "rule_id", "alarm_msg", "trigger_type", "action_type",
        F.col("action.pushInterval").alias("push_interval"),
        F.col("action.pushFrequency").alias("push_frequency"),
        F.col("action.pushWay").alias("push_way"),
        "trigger_json",
    )
    message = F.when(F.col("recover"), S.recovery_message(F.col("rule_id")))
    complete = (
        found.join(texts, "rule_id")
        .withColumn("msg", message.otherwise(F.col("alarm_msg")))
        .select("*", uuid)
        .drop("holds", "delay", "alarm_msg")
    )
    complete.write.mode("overwrite").parquet(f"{folder}/alarms")
    alarms = spark.read.parquet(f"{folder}/alarms")

    pushes = P.push_messages(
        alarms.drop("ts"), KEYS, tie, horizon,
        CHECKED if CHUNK in alarms.columns else policy,
    ).select(*KEYS, "sn", tie, "msg", "push_us", "push_way", "trigger_json")
    pushes.write.mode("overwrite").parquet(f"{folder}/pushes")

    mapping = R.controls_of_alarms(
        dims.rules.filter(F.col("rely_rule_id").isNotNull()),
        dims.rules.select(F.col("id").alias("alarm_id")),
    )
    control = details.select("rule_id", "trigger_json", "action")
    wanted = ["uuid", *KEYS, "datapoint_id", "sn", "trigger_json", "action"]
    driving = alarms if include_recover else alarms.filter(~F.col("recover"))
    driven = K.alarm_driven_rows(driving.drop("trigger_json"), mapping).join(
        control, "rule_id"
    )
    direct = R.direct_controls(tagged).withColumn("uuid", each)
    rows = driven.select(*wanted).unionByName(direct.select(*wanted))
    commands = K.control_commands(
        K.match_elements(rows, dims.elements), dims.point_relation, dims.machine_relation
    )
    commands.write.mode("overwrite").parquet(f"{folder}/commands")
    return {n: spark.read.parquet(f"{folder}/{n}")
            for n in ("alarms", "pushes", "commands")}
