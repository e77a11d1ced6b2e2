"""Control commands from control rules and from alarms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alarmloom.functions.scalars import row_id
from alarmloom.operators.rules import ALARM_DRIVEN

# What a monitored element refers to.
GATEWAY, DEVICE, TEMPLATE = "0", "1", "2"


def alarm_driven_rows(alarms: DataFrame, alarm_controls: DataFrame) -> DataFrame:
    """One copy of an alarm row per control rule its alarm rule drives.

    ``alarm_controls`` holds (alarm_id, control_id).  The copy carries the control
    rule's id; attach that rule's details next.  Recovery rows drive controls too;
    filter on ``recover`` before for alarms only.
    """
    driving = alarms.filter(F.col("trigger_type") == ALARM_DRIVEN)
    return (
        driving.join(alarm_controls, driving["rule_id"] == alarm_controls["alarm_id"])
        .drop("rule_id", "alarm_id")
        .withColumnRenamed("control_id", "rule_id")
    )


def match_elements(rows: DataFrame, elements: DataFrame) -> DataFrame:
    """The first element of the row's rule that watches the row's point.

    Gateway and device elements match on the unique point, template elements on
    the template point.  The elements are reduced to the first one per rule and
    point before the join, so a row never fans out.
    """
    live = elements.filter(F.col("del_flag") == 0)
    first = F.min_by(
        F.struct("position", "element_type", "machine_id"), F.col("position")
    )
    unique = (
        live.filter(F.col("element_type").isin(GATEWAY, DEVICE))
        .groupBy("rule_id", "unique_data_point_id")
        .agg(first.alias("__by_unique"))
    )
    template = (
        live.filter(F.col("element_type") == TEMPLATE)
        .groupBy("rule_id", F.col("data_point_id").alias("datapoint_id"))
        .agg(first.alias("__by_template"))
    )
    u, t = F.col("__by_unique"), F.col("__by_template")
    chosen = (
        F.when(t.isNull() | (u["position"] < t["position"]), u).otherwise(t)
    )
    return (
        rows.join(unique, ["rule_id", "unique_data_point_id"], "left")
        .join(template, ["rule_id", "datapoint_id"], "left")
        .withColumn("element", chosen)
        .filter(F.col("element").isNotNull())
        .drop("__by_unique", "__by_template")
    )


def control_commands(
    matched: DataFrame, point_relation: DataFrame, machine_relation: DataFrame
) -> DataFrame:
    """One command per control action of a matched row.

    Template elements are resolved through the gateway: its machines, and the
    unique point behind (gateway, template point).  Flat: a command for several
    machines has one row per machine and one ``control_uuid``; a command for none
    has a null ``control_machine_id``.  The place of an action in its rule is part of
    the command's id, so equal actions are commands of their own.
    """
    kind = F.col("element")["element_type"]
    actions = matched.select(
        "*", F.posexplode(F.col("action")["controlActionDtos"]).alias("__n", "__c")
    ).withColumns(
        {
            # Null keys for other elements, so that they pass the joins untouched.
            "__sn": F.when(kind == TEMPLATE, F.col("sn")),
            "__tpl": F.when(kind == TEMPLATE, F.col("__c")["controlDataPointId"]).cast(
                "bigint"
            ),
        }
    )
    machines = machine_relation.select(
        F.col("device_sn").alias("__sn"), F.col("machine_id").alias("__machine")
    ).distinct()
    points = point_relation.groupBy(
        F.col("device_no").alias("__sn"), F.col("device_template_point_id").alias("__tpl")
    ).agg(F.max("id").alias("__point"))
    resolved = actions.join(points, ["__sn", "__tpl"], "left").join(
        machines, "__sn", "left"
    )
    return resolved.select(
        row_id(F.col("uuid"), F.col("rule_id"), F.col("__n")).alias("control_uuid"),
        F.col("uuid").alias("alarm_uuid"),
        F.when(kind == DEVICE, F.col("element")["machine_id"])
        .when(kind == TEMPLATE, F.col("__machine"))
        .alias("control_machine_id"),
        F.col("sn").alias("control_sn"),
        F.when(kind == TEMPLATE, F.col("__point"))
        .otherwise(F.col("__c")["controlUniqueDataPointId"].cast("bigint"))
        .alias("unique_data_point_id"),
        F.col("__c")["controlOperaDataPoint"].alias("opera_data_point_id"),
        F.col("__c")["controlData"].alias("control_data"),
        F.col("__c")["controlType"].alias("control_type"),
        "rule_id",
        F.col("trigger_json").alias("trigger"),
    )


def with_machine_lists(commands: DataFrame) -> DataFrame:
    """Commands as one row each, with the machines in a list that must fit a row."""
    rest = [c for c in commands.columns if c != "control_machine_id"]
    return commands.groupBy(*rest).agg(
        F.array_sort(F.collect_set("control_machine_id")).alias("control_machine_ids")
    )
