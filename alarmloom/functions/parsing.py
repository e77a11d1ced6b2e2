"""Text and JSON lines to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alarmloom import schemas
from alarmloom.functions.scalars import literal_null


def explode_message(messages: DataFrame, message: str = "message") -> DataFrame:
    """One row per good data point of a parsed gateway message.

    A point whose ``err`` is null or not 0 is dropped, and so is a message with
    no points.
    """
    point = F.col("__point")
    others = [c for c in messages.columns if c != message]
    return (
        messages.select(
            *others,
            F.col(message)["deviceId"].alias("sn"),
            F.explode(F.col(message)["dataPoints"]).alias("__point"),
        )
        .filter(point["err"] == 0)
        .select(
            *others,
            "sn",
            point["dataPointId"].alias("datapoint_id"),
            point["value"].alias("val"),
            point["err"].alias("err"),
            point["timeMs"].alias("time_ms"),
            F.timestamp_millis(point["timeMs"]).alias("ts"),
        )
    )


def parse_messages(lines: DataFrame, value: str = "value") -> DataFrame:
    """JSON gateway messages (text or bytes) to data points."""
    text = F.col(value).cast("string")
    parsed = lines.withColumn("message", F.from_json(text, schemas.GATEWAY_MESSAGE))
    return explode_message(parsed.drop(value))


def parse_nested_messages(lines: DataFrame, value: str = "value") -> DataFrame:
    """The early message form, with the gateway message two levels down."""
    text = F.col(value).cast("string")
    path = F.from_json(text, schemas.NESTED_GATEWAY_MESSAGE)[
        "deviceDataPointDto"
    ]["parsedDataPointMessages"]
    return explode_message(lines.withColumn("message", path).drop(value))


def _split_line(lines: DataFrame, value: str, fields: list[tuple[str, str]]) -> DataFrame:
    parts = F.split(F.col(value), ",")
    others = [c for c in lines.columns if c != value]
    return lines.select(
        *others,
        *[F.get(parts, n).try_cast(t).alias(name) for n, (name, t) in enumerate(fields)],
    )


def parse_status_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """``sn,status,ms``"""
    out = _split_line(
        lines, value, [("sn", "string"), ("status", "string"), ("time_ms", "bigint")]
    )
    return out.withColumn("ts", F.timestamp_millis("time_ms"))


def parse_point_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """``sn,datapoint,unique point,template,value``"""
    return _split_line(
        lines,
        value,
        [
            ("sn", "string"),
            ("datapoint_id", "int"),
            ("unique_data_point_id", "int"),
            ("template_id", "int"),
            ("val", "string"),
        ],
    )


def parse_named_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """``name,ms``"""
    out = _split_line(lines, value, [("name", "string"), ("time_ms", "bigint")])
    return out.withColumn("ts", F.timestamp_millis("time_ms"))


def parse_pair_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """``sn,value``"""
    return _split_line(lines, value, [("sn", "string"), ("val", "string")])


def parse_person_json(lines: DataFrame, value: str = "value") -> DataFrame:
    """JSON with name, age and time to three columns."""
    person = F.from_json(F.col(value), "name string, age int, time bigint")
    others = [c for c in lines.columns if c != value]
    return lines.select(
        *others, *[person[f].alias(f) for f in ("name", "age", "time")]
    )


def explode_element_text(df: DataFrame, text: str) -> DataFrame:
    """``dev-sn-udp-tpl-dp#...`` to one row per monitored element."""
    part = F.split(F.col("__token"), "-")
    others = [c for c in df.columns if c != text]

    def number(n: int) -> Column:
        return literal_null(F.get(part, n)).try_cast("bigint")

    return df.select(
        *others, F.posexplode(F.split(F.col(text), "#")).alias("pos", "__token")
    ).select(
        *others,
        "pos",
        literal_null(F.get(part, 0)).alias("device_id"),
        literal_null(F.get(part, 1)).alias("sn"),
        number(2).alias("unique_data_point_id"),
        number(3).alias("template_id"),
        number(4).alias("data_point_id"),
    )


def parse_rule_changes(lines: DataFrame, value: str = "value") -> DataFrame:
    """Rule change messages: type, action, id and the list of rule ids."""
    change = F.from_json(F.col(value).cast("string"), schemas.RULE_CHANGE)
    others = [c for c in lines.columns if c != value]
    return lines.select(*others, change.alias("__c")).select(
        *others,
        F.col("__c.type").alias("type"),
        F.col("__c.actionType").alias("action"),
        F.col("__c.id").cast("bigint").alias("id"),
        F.split("__c.ruleId", ",").alias("rule_ids"),
    )


def explode_rule_ids(changes: DataFrame) -> DataFrame:
    """One row per rule id of a change."""
    others = [c for c in changes.columns if c != "rule_ids"]
    return changes.select(*others, F.explode("rule_ids").alias("__rule")).select(
        *others, F.trim("__rule").try_cast("bigint").alias("rule_id")
    )


def parse_alarm_control_changes(lines: DataFrame, value: str = "value") -> DataFrame:
    """Alarm rule ids whose control rules changed."""
    change = F.from_json(F.col(value).cast("string"), schemas.ALARM_CONTROL_CHANGE)
    return lines.select(F.explode(change["alarmRuleId"]).alias("id")).select(
        F.col("id").cast("bigint").alias("alarm_id")
    )


def parse_device_machine_changes(lines: DataFrame, value: str = "value") -> DataFrame:
    """Gateways to unbind from or bind to machines: (sn, bind)."""
    change = F.from_json(F.col(value).cast("string"), schemas.DEVICE_MACHINE_CHANGE)

    def side(field: str, bind: bool) -> Column:
        names = F.filter(F.split(change[field], ","), lambda s: s != "")
        boxed = F.transform(
            names, lambda s: F.struct(s.alias("sn"), F.lit(bind).alias("bind"))
        )
        return F.coalesce(boxed, F.array().cast("array<struct<sn:string,bind:boolean>>"))

    return lines.select(
        F.explode(F.concat(side("snUnbind", False), side("snBind", True))).alias("c")
    ).select("c.sn", "c.bind")


def parse_device_point_changes(lines: DataFrame, value: str = "value") -> DataFrame:
    """Gateways whose data points changed."""
    change = F.from_json(F.col(value).cast("string"), schemas.DEVICE_POINT_CHANGE)
    return lines.select(F.explode(change["sn"]).alias("sn"))
