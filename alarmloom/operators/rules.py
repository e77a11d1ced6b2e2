"""Rules, their elements and actions, and the tagging of data points.

Mappings and element lists are kept flat, one row per pair, and not as comma
separated texts or nested lists: a mapping of any size can then be joined,
shuffled and split.  Nothing is broadcast by hint; Catalyst broadcasts a side when
its size is below the threshold and otherwise shuffles, and AQE splits skewed
partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alarmloom import schemas
from alarmloom.functions.scalars import typed_trigger

CONTROL_ACTION = "2"
ALARM_DRIVEN = "2"
SCHEDULED = "3"


# -- lookups -----------------------------------------------------------------


def active_rule_elements(
    rules: DataFrame, elements: DataFrame, ids: DataFrame | None = None
) -> DataFrame:
    """Rules in use joined to their elements; ``ids`` (column id) narrows them."""
    live = rules.filter((F.col("del_flag") == 0) & (F.col("status") == 0))
    if ids is not None:
        live = live.join(ids, "id", "left_semi")
    live = live.select("id", "rely_rule_id", "trigger", "trigger_type")
    parts = elements.filter(F.col("del_flag") == 0).drop("del_flag", "id")
    return live.join(parts, live["id"] == parts["rule_id"]).drop("rule_id")


def actions_of_rules(actions: DataFrame, ids: DataFrame) -> DataFrame:
    """Actions of the listed rules (column id)."""
    return actions.join(ids, actions["rule_id"] == ids["id"], "left_semi")


def assemble_rules(rule_elements: DataFrame, actions: DataFrame) -> DataFrame:
    """Rules with their elements and their action (null where there is none).

    Flat: one row per rule and element, so a rule may have any number of elements.
    A rule with two actions gives each element twice, where the studied code fails.
    """
    action = actions.select(
        F.col("rule_id").alias("__rule"),
        F.struct("execute_mode", "action_type", "action", "rule_id").alias(
            "rule_action"
        ),
    )
    return rule_elements.join(
        action, rule_elements["id"] == action["__rule"], "left"
    ).drop("__rule")


def nest_elements(assembled: DataFrame) -> DataFrame:
    """Assembled rules as one row each, with the elements in a list.

    For handing single rules to a consumer; the list must fit a row.
    """
    element = F.struct(
        "element_type", "machine_id", "unique_data_point_id", "template_id",
        "data_point_id", "sn", "opera_data_point_id",
    )
    header = ["id", "rely_rule_id", "trigger", "trigger_type", "rule_action"]
    return assembled.groupBy(*header).agg(
        F.sort_array(F.collect_list(element)).alias("element_list")
    )


def controls_of_alarms(rules: DataFrame, alarm_ids: DataFrame) -> DataFrame:
    """(control_id, alarm_id) of the rules that rely on the listed alarm rules."""
    pairs = rules.select(
        F.col("id").alias("control_id"),
        F.col("rely_rule_id").try_cast("bigint").alias("alarm_id"),
    )
    return pairs.join(alarm_ids, "alarm_id", "left_semi").select(
        "control_id", "alarm_id"
    )


def elements_of_points(elements: DataFrame, points: DataFrame) -> DataFrame:
    """Elements that watch the listed points (column unique_data_point_id)."""
    return elements.join(points, "unique_data_point_id", "left_semi")


def points_of_gateways(relation: DataFrame, gateways: DataFrame) -> DataFrame:
    """(id, sn, device_template_point_id) of the listed gateways (column sn)."""
    return relation.withColumnRenamed("device_no", "sn").join(
        gateways, "sn", "left_semi"
    ).select("id", "sn", "device_template_point_id")


def machines_of_gateways(relation: DataFrame, gateways: DataFrame) -> DataFrame:
    """(device_sn, machine_id) of the listed gateways (column sn)."""
    return relation.join(
        gateways, relation["device_sn"] == gateways["sn"], "left_semi"
    ).select("device_sn", "machine_id")


# -- rule details ------------------------------------------------------------


def rule_details(
    rules: DataFrame, elements: DataFrame, actions: DataFrame
) -> DataFrame:
    """One flat row per live rule: typed trigger, parsed action, first machine.

    ``position`` orders the elements of a rule.
    """
    first = (
        elements.filter(F.col("del_flag") == 0)
        .groupBy("rule_id")
        .agg(F.min_by("machine_id", "position").alias("rule_machine_id"))
    )
    trigger = F.from_json("trigger", schemas.TRIGGER)
    parsed = (
        rules.filter((F.col("del_flag") == 0) & (F.col("status") == 0))
        .withColumn("__t", trigger)
        .select(
            F.col("id").alias("rule_id"),
            "rely_rule_id",
            "trigger_type",
            F.col("trigger").alias("trigger_json"),
            typed_trigger(F.col("__t")).alias("trigger"),
            F.col("__t.alarmMsg").alias("alarm_msg"),
            F.coalesce("__t.delayTime", F.lit(0)).alias("delay"),
        )
    )
    act = actions.select(
        "rule_id",
        "action_type",
        "execute_mode",
        F.from_json("action", schemas.ACTION).alias("action"),
    )
    return parsed.join(first, "rule_id").join(act, "rule_id", "left")


# -- tagging -----------------------------------------------------------------


UNIQUE, TEMPLATE = 0, 1


def watch_list(mapping: DataFrame, details: DataFrame) -> DataFrame:
    """A point-to-rule mapping with the rules' details.

    Joins dimensions only, so that data points meet rules in a single join.
    Scheduled controls are left out: no data point drives them.
    """
    running = details.filter(~F.col("trigger_type").eqNullSafe(SCHEDULED))
    return mapping.join(running, "rule_id")


def tag_points(
    points: DataFrame, unique_watch: DataFrame, template_watch: DataFrame
) -> DataFrame:
    """One row per data point and rule that watches it.

    ``unique_watch`` has unique_data_point_id and rule columns, ``template_watch``
    datapoint_id and the same rule columns.  A rule reached both ways counts twice,
    as the two lists are simply appended; a point without rules is dropped.

    Both lists are one, by kind and id, and a point looks up its two ids in it, so that
    points are read and shuffled once.  ``mapping`` tells which id found the rule.
    """
    kinds = {UNIQUE: "unique_data_point_id", TEMPLATE: "datapoint_id"}
    lists = zip(kinds.items(), (unique_watch, template_watch))
    by_unique, by_template = (
        watch.withColumn("mapping", F.lit(kind)).withColumnRenamed(name, "__id")
        for (kind, name), watch in lists
    )
    ids = F.array(
        *[
            F.struct(F.lit(kind).alias("mapping"), F.col(name).cast("bigint").alias("__id"))
            for kind, name in kinds.items()
        ]
    )
    looking = points.select("*", F.inline(ids))
    watched = by_unique.unionByName(by_template).withColumn(
        "__id", F.col("__id").cast("bigint")
    )
    return looking.join(watched, ["mapping", "__id"]).drop("__id")


def tag_points_prototype(points: DataFrame, gateway_rules: DataFrame) -> DataFrame:
    """The early tagging: rules per (sn, point); points without rules stay."""
    return points.join(
        gateway_rules, ["sn", "unique_data_point_id"], "left"
    ).withColumn("device_id", F.lit(1))


def flatten_rule_lists(points: DataFrame, *lists: str) -> DataFrame:
    """Comma separated rule lists to one row per rule; null lists give none."""
    joined = F.concat_ws(",", *[F.col(c) for c in lists])
    others = [c for c in points.columns if c not in lists]
    return points.select(
        *others, F.explode(F.split(joined, ",")).alias("rule_id")
    ).filter(F.col("rule_id") != "")


def direct_controls(tagged: DataFrame) -> DataFrame:
    """Rows that go straight to control: control rules no alarm drives."""
    return tagged.filter(
        (F.col("action_type") == CONTROL_ACTION)
        & ~F.col("trigger_type").eqNullSafe(ALARM_DRIVEN)
    )


def alarm_path(tagged: DataFrame) -> DataFrame:
    """Rows that are tested for alarms: everything but control rules."""
    return tagged.filter(~F.col("action_type").eqNullSafe(CONTROL_ACTION))


def points_with_rules(points: DataFrame, watched: DataFrame) -> DataFrame:
    """Data points that are watched (column unique_data_point_id)."""
    return points.join(watched, "unique_data_point_id", "left_semi")


def with_ticks(status: DataFrame, ticks: DataFrame) -> DataFrame:
    """Status reports and clock ticks as one frame of status rows."""
    return status.unionByName(ticks)


def with_last_alarm(rows: DataFrame, alarms: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key has an alarm on record."""
    return rows.join(alarms, keys, "left_semi")


def without_alarm(rows: DataFrame, alarms: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key has none."""
    return rows.join(alarms, keys, "left_anti")
