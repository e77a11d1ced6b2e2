"""The given star-schema tables seen as telemetry and rule tables.

``events``    status reports and data points: gateway and unique point are the
              user, the template point is ``props.k``, "error" means off
``orders``    rules, their actions and the point-to-rule mapping (the customer is
              the point)
``lineitem``  monitored elements and the log of rule changes
``customer``  gateway-to-point relation
``supplier``  template-to-rule mapping
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from alarmloom.operators.hotkeys import DEFAULT_POLICY, SplitPolicy, split_hot_keys
from alarmloom.session import configure

HOUR = 3600


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    df = spark.read.schema(_SCHEMAS[path]).parquet(path)
    for field in df.schema:
        if field.dataType.typeName() == "timestamp_ntz":
            df = df.withColumn(field.name, F.col(field.name).cast("timestamp"))
    return df


# -- telemetry ---------------------------------------------------------------


def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sn, status "0" off / "1" on, ts, event_id"""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("sn"),
        F.when(F.col("event_type") == "error", "0").otherwise("1").alias("status"),
        "ts",
        "event_id",
    )


def split_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status rows with hot gateways split; use the CHECKED policy on them."""
    return split_hot_keys(status(spark, sf_dir), ["sn"], "ts", "event_id")[0]


def split_points(
    spark: SparkSession, sf_dir: str, policy: SplitPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Data points with hot points split; use the CHECKED policy on them."""
    rows = points(spark, sf_dir)
    keys = ["unique_data_point_id"]
    return split_hot_keys(rows, keys, "ts", "event_id", policy)[0]


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sn, datapoint_id, unique_data_point_id, val, ts, event_id"""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("sn"),
        F.get_json_object("props", "$.k").cast("bigint").alias("datapoint_id"),
        F.col("user_id").alias("unique_data_point_id"),
        F.col("value").cast("string").alias("val"),
        "ts",
        "event_id",
    )


def gateway_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON messages of two data points each, with all kinds of error codes."""
    e = table(spark, sf_dir, "events")
    err = (
        F.when(F.col("event_type") == "error", 1)
        .when(F.col("event_type") == "view", None)
        .otherwise(0)
    )
    k = F.get_json_object("props", "$.k").cast("int")
    ms = F.unix_millis("ts")

    def point(point_id: Column, err: Column) -> Column:
        return F.struct(
            point_id.alias("dataPointId"),
            ms.alias("timeMs"),
            F.col("value").cast("string").alias("value"),
            err.alias("err"),
        )

    both = F.array(point(k, err.cast("int")), point(k + 100, F.lit(0)))
    none = F.when(F.col("event_type") != "signup", both)  # a message with no points
    return e.select(
        "event_id",
        F.to_json(
            F.struct(
                F.col("user_id").cast("string").alias("deviceId"),
                none.alias("dataPoints"),
            )
        ).alias("value"),
    )


# -- rules -------------------------------------------------------------------


def _pick(key: str, n: int, *choices) -> Column:
    """One of the choices by the remainder of a key; the last is the default."""
    out = None
    for i, c in enumerate(choices[:-1]):
        test = F.col(key) % n == i
        out = F.when(test, c) if out is None else out.when(test, c)
    return out.otherwise(choices[-1])


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    trigger = F.to_json(
        F.struct(
            ((k + F.col("o_custkey")) % 7).cast("string").alias("triggerCondition"),
            (k % 40).cast("string").alias("triggerConditionAval"),
            (k % 60 + 20).cast("string").alias("triggerConditionBval"),
            F.when(k % 23 == 0, 1).otherwise(0).alias("triggerConditionValType"),
            F.concat(F.lit("point out of bounds "), k.cast("string")).alias("alarmMsg"),
            ((k % 4) * 6 * HOUR).cast("int").alias("delayTime"),
            F.when(k % 3 == 0, "")
            .otherwise(F.concat((k % 3).cast("string"), F.lit(".5")))
            .alias("alarmDeadZone"),
        )
    )
    return o.select(
        k.alias("id"),
        F.when(k % 5 == 3, (k - 2).cast("string")).alias("rely_rule_id"),
        trigger.alias("trigger"),
        _pick("o_orderkey", 5, "1", "2", "0", "2", "3").alias("trigger_type"),
        F.when(k % 17 == 0, 1).otherwise(0).alias("del_flag"),
        F.when(k % 19 == 0, 1).otherwise(0).alias("status"),
    )


def rule_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    null_int = F.lit(None).cast("int")

    def control(kind: Column, point: Column, data: Column) -> Column:
        return F.struct(
            kind.alias("controlType"),
            (k % 7).cast("int").alias("controlOperaDataPoint"),
            (k % 25).cast("int").alias("controlDataPointId"),
            point.cast("int").alias("controlUniqueDataPointId"),
            data.alias("controlData"),
        )

    one = control(F.lit(1), k % 100, F.concat(F.lit("set-"), k.cast("string")))
    two = control(F.lit(0), k % 101, F.lit("read"))
    action = F.to_json(
        F.struct(
            F.when(k % 3 == 0, null_int).when(k % 3 == 1, 6 * HOUR).otherwise(0)
            .alias("pushInterval"),
            F.when(k % 3 == 0, 0).otherwise(1).alias("pushFrequency"),
            F.lit(",1,2,").alias("pushWay"),
            F.when(F.col("o_orderpriority") == "1-URGENT", F.array(one, two))
            .when(F.col("o_orderpriority") != "5-LOW", F.array(one))
            .alias("controlActionDtos"),
        )
    )
    return o.select(
        k.alias("rule_id"),
        action.alias("action"),
        F.when(k % 5 == 0, F.when(k % 2 == 0, "3").otherwise("1"))
        .when(k % 5 == 1, "3")
        .otherwise("2")
        .alias("action_type"),
        F.lit("0").alias("execute_mode"),
    )


def rule_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitored elements; ``position`` orders the elements of a rule.

    A control rule watches the point of the alarm rule it relies on.
    """
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    line = F.col("l_linenumber")
    position = (
        line.cast("bigint") * 10**13 + F.col("l_partkey") * 10**4
        + F.col("l_suppkey") % 10**4
    )
    watched = F.col("l_orderkey") - F.when(F.col("l_orderkey") % 5 == 3, 2).otherwise(0)
    return li.join(o, watched == F.col("o_orderkey")).select(
        position.alias("id"),
        F.col("l_orderkey").alias("rule_id"),
        (line % 3).cast("string").alias("element_type"),
        F.col("l_suppkey").alias("machine_id"),
        (F.col("o_custkey") + F.when(line > 3, 1).otherwise(0)).alias(
            "unique_data_point_id"
        ),
        F.col("l_partkey").alias("template_id"),
        F.col("l_orderkey").alias("data_point_id"),
        F.lit(None).cast("bigint").alias("opera_data_point_id"),
        F.col("o_custkey").cast("string").alias("sn"),
        F.when(F.col("l_returnflag") == "A", 1).otherwise(0).alias("del_flag"),
        position.alias("position"),
    )


def unique_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("unique_data_point_id"),
        F.col("o_orderkey").alias("rule_id"),
    )


def template_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("datapoint_id"), F.col("s_suppkey").alias("rule_id")
    )


def gateway_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sn, unique_data_point_id, rule_id): the early per-gateway mapping."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("sn"),
        F.col("o_custkey").alias("unique_data_point_id"),
        F.col("o_orderkey").alias("rule_id"),
    )


def point_relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_custkey").cast("string").alias("device_no"),
        F.col("c_nationkey").cast("bigint").alias("device_template_point_id"),
    )


def machine_relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("device_sn"),
        F.col("o_orderkey").alias("machine_id"),
    )


def rule_change_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON rule changes with their time and sequence number, from lineitem."""
    li = table(spark, sf_dir, "lineitem")
    action = (
        F.when(F.col("l_returnflag") == "N", "0")
        .when(F.col("l_returnflag") == "A", "1")
        .otherwise("2")
    )
    rule_ids = F.concat_ws(",", "l_orderkey", "l_partkey")
    seq = F.col("l_orderkey") * 100_000_000 + F.col("l_partkey") * 10 + F.col(
        "l_linenumber"
    )
    return li.select(
        F.col("l_shipdate").alias("ts"),
        seq.alias("seq"),
        F.to_json(
            F.struct(
                F.col("l_suppkey").cast("int").alias("id"),
                (F.col("l_linenumber") % 3).cast("string").alias("type"),
                action.alias("actionType"),
                rule_ids.alias("ruleId"),
            )
        ).alias("value"),
    )
