"""Queries over messages and single rows: parsing, predicates, routing."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from alarmloom.functions import parsing
from alarmloom.functions import scalars as S
from alarmloom.operators import rules as R
from alarmloom.operators.hotkeys import DEFAULT_POLICY
from alarmloom.plans import oracle as O
from alarmloom.plans import testbed as B
from alarmloom.plans.registry import query
from alarmloom.storage import written

ERR = "CASE event_type WHEN 'error' THEN 1 WHEN 'view' THEN NULL ELSE 0 END"
K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
GOOD_POINTS = f"""
  SELECT event_id, CAST(user_id AS VARCHAR) AS sn, {K} AS datapoint_id,
         CAST(value AS VARCHAR) AS val, 0 AS err, epoch_us(ts) // 1000 AS time_ms
  FROM events WHERE event_type <> 'signup' AND {ERR} = 0
  UNION ALL
  SELECT event_id, CAST(user_id AS VARCHAR), {K} + 100, CAST(value AS VARCHAR), 0,
         epoch_us(ts) // 1000
  FROM events WHERE event_type <> 'signup'"""


@query("message_points", GOOD_POINTS)
def message_points(spark, sf):
    """JSON gateway messages to good data points."""
    return parsing.parse_messages(B.gateway_messages(spark, sf)).drop("ts")


@query("nested_message_points", GOOD_POINTS)
def nested_message_points(spark, sf):
    """The same through the early, nested message form."""
    nested = B.gateway_messages(spark, sf).withColumn(
        "value",
        F.concat(
            F.lit('{"deviceDataPointDto":{"parsedDataPointMessages":'),
            "value",
            F.lit("}}"),
        ),
    )
    return parsing.parse_nested_messages(nested).drop("ts")


@query(
    "status_lines",
    f"""WITH {O.STATUS} SELECT event_id, sn, status, t // 1000 AS time_ms FROM st""",
)
def status_lines(spark, sf):
    """``sn,status,ms`` lines to status rows."""
    lines = B.status(spark, sf).select(
        "event_id", F.concat_ws(",", "sn", "status", F.unix_millis("ts")).alias("value")
    )
    return parsing.parse_status_lines(lines).drop("ts")


@query(
    "point_lines",
    f"""WITH {O.POINTS} SELECT event_id, sn, CAST(datapoint_id AS INTEGER)
      AS datapoint_id, CAST(unique_data_point_id AS INTEGER) AS unique_data_point_id,
      CAST(datapoint_id % 10 AS INTEGER) AS template_id, val FROM pt""",
)
def point_lines(spark, sf):
    """``sn,datapoint,unique point,template,value`` lines to data points."""
    lines = B.points(spark, sf).select(
        "event_id",
        F.concat_ws(
            ",", "sn", "datapoint_id", "unique_data_point_id",
            F.col("datapoint_id") % 10, "val",
        ).alias("value"),
    )
    return parsing.parse_point_lines(lines)


@query(
    "named_lines",
    """SELECT event_id, event_type AS name, epoch_us(ts) // 1000 AS time_ms FROM events""",
)
def named_lines(spark, sf):
    """``name,ms`` lines to named rows."""
    lines = B.table(spark, sf, "events").select(
        "event_id", F.concat_ws(",", "event_type", F.unix_millis("ts")).alias("value")
    )
    return parsing.parse_named_lines(lines).drop("ts")


@query("pair_lines", f"WITH {O.POINTS} SELECT event_id, sn, val FROM pt")
def pair_lines(spark, sf):
    """``sn,value`` lines to pairs."""
    lines = B.points(spark, sf).select(
        "event_id", F.concat_ws(",", "sn", "val").alias("value")
    )
    return parsing.parse_pair_lines(lines)


@query(
    "person_json",
    """SELECT c_custkey, c_name AS name, c_nationkey AS age, c_custkey * 1000 AS "time"
       FROM customer""",
)
def person_json(spark, sf):
    """JSON rows to (name, age, time)."""
    lines = B.table(spark, sf, "customer").select(
        "c_custkey",
        F.to_json(
            F.struct(
                F.col("c_name").alias("name"),
                F.col("c_nationkey").alias("age"),
                (F.col("c_custkey") * 1000).alias("time"),
            )
        ).alias("value"),
    )
    return parsing.parse_person_json(lines)


@query(
    "number_texts",
    """SELECT event_id,
         CASE WHEN txt = '' THEN 0 ELSE COALESCE(TRY_CAST(txt AS DOUBLE), -1) END
           AS number
       FROM (SELECT event_id, CASE event_type WHEN 'view' THEN ''
              WHEN 'click' THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS txt
             FROM events)""",
)
def number_texts(spark, sf):
    """Text to number: blanks give 0, what is not a number gives null (here -1)."""
    text = (
        F.when(F.col("event_type") == "view", "  ")
        .when(F.col("event_type") == "click", "n/a")
        .otherwise(F.concat(F.lit(" \t"), F.col("value").cast("string"), F.lit("\n ")))
    )
    return B.table(spark, sf, "events").select(
        "event_id", F.coalesce(S.text_to_double(text), F.lit(-1.0)).alias("number")
    )


@query(
    "any_empty",
    f"""SELECT event_id, (event_type = 'signup' OR {ERR} IS NULL
          OR event_type = 'click') AS is_empty FROM events""",
)
def any_empty(spark, sf):
    """True when any of a null, an empty text or an empty list is among the values."""
    kind = F.col("event_type")
    text = F.when(kind == "signup", "").otherwise(kind)
    number = F.when(kind != "view", F.col("user_id"))
    items = F.when(kind == "click", F.array().cast("array<bigint>")).otherwise(
        F.array("user_id")
    )
    return B.table(spark, sf, "events").select(
        "event_id",
        S.any_empty(text, number, (items, T.ArrayType(T.LongType()))).alias("is_empty"),
    )


@query(
    "element_texts",
    """SELECT o_orderkey, pos, sn, unique_data_point_id, template_id, data_point_id
       FROM (
         SELECT o_orderkey, 0 AS pos, 'gw' || CAST(o_custkey AS VARCHAR) AS sn,
                o_custkey AS unique_data_point_id, -1::BIGINT AS template_id,
                o_orderkey AS data_point_id
         FROM orders
         UNION ALL
         SELECT o_orderkey, 1, 'gw' || CAST(o_custkey AS VARCHAR), -1,
                o_orderkey % 25, -1 FROM orders)""",
)
def element_texts(spark, sf):
    """``dev-sn-udp-tpl-dp#...`` texts to monitored elements."""
    gw = F.concat(F.lit("gw"), F.col("o_custkey").cast("string"))
    text = F.concat_ws(
        "#",
        F.concat_ws("-", F.lit("10"), gw, "o_custkey", F.lit("null"), "o_orderkey"),
        F.concat_ws(
            "-", F.lit("10"), gw, F.lit("null"), F.col("o_orderkey") % 25, F.lit("null")
        ),
    )
    rows = B.table(spark, sf, "orders").select("o_orderkey", text.alias("elements"))
    out = parsing.explode_element_text(rows, "elements").drop("device_id")
    ids = ["unique_data_point_id", "template_id", "data_point_id"]
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(-1)) for c in ids})


# -- triggers and routing ------------------------------------------------------


def details(spark, sf):
    """The rules' details as a table: several steps of a job join from it."""
    return written(
        R.rule_details(
            B.rules(spark, sf), B.rule_elements(spark, sf), B.rule_actions(spark, sf)
        )
    )


def tagged(spark, sf, rules=None, policy=DEFAULT_POLICY):
    """Data points with the rules that watch them, parsed and typed."""
    rules = details(spark, sf) if rules is None else rules
    return R.tag_points(
        S.with_number(B.split_points(spark, sf, policy)),
        R.watch_list(B.unique_rules(spark, sf), rules),
        R.watch_list(B.template_rules(spark, sf), rules),
    )


def trigger_rows(spark, sf, literal):
    holds = S.trigger_holds(F.col("text"), F.col("number"), F.col("trigger"), literal)
    return tagged(spark, sf).select("event_id", "rule_id", holds.alias("holds"))


TAG_CTES = (O.POINTS, O.RULES, O.ELEMENTS, O.DETAILS, O.TAGS, O.TAGGED_RULES)
TAGGED = O.with_(*TAG_CTES)


@query(
    "trigger_predicate",
    f"{TAGGED} SELECT event_id, rule_id, {O.holds()} AS holds FROM tr",
)
def trigger_predicate(spark, sf):
    """All seven trigger conditions over every tagged point."""
    return trigger_rows(spark, sf, literal=False)


@query(
    "trigger_predicate_literal",
    f"{TAGGED} SELECT event_id, rule_id, {O.holds(literal=True)} AS holds FROM tr",
)
def trigger_predicate_literal(spark, sf):
    """The conditions with the studied jobs' slips kept."""
    return trigger_rows(spark, sf, literal=True)


@query(
    "trigger_predicate_early",
    f"""WITH {O.POINTS} SELECT event_id, o_orderkey AS rule_id,
          (o_orderkey % 7 = 2 AND val = CAST(o_orderkey % 40 AS VARCHAR) || '.5')
            AS holds
        FROM pt JOIN orders ON o_custkey = unique_data_point_id""",
)
def trigger_predicate_early(spark, sf):
    """Text equality under condition 2, the early jobs' only condition."""
    points = R.tag_points_prototype(B.points(spark, sf), B.gateway_rules(spark, sf))
    rule = F.col("rule_id")
    return points.filter(rule.isNotNull()).select(
        "event_id",
        "rule_id",
        S.equals_trigger(
            F.col("val"),
            (rule % 7).cast("string"),
            F.concat((rule % 40).cast("string"), F.lit(".5")),
        ).alias("holds"),
    )


ROUTE = f"""{TAGGED} SELECT event_id, rule_id, trigger_type, uuid,
  COALESCE(rule_machine_id, -1) AS rule_machine_id FROM tr"""


@query("direct_controls", f"{ROUTE} WHERE action_type = '2' AND trigger_type <> '2'")
def direct_controls(spark, sf):
    """Rows routed straight to control."""
    return R.direct_controls(tagged(spark, sf)).select(
        "event_id", "rule_id", "trigger_type",
        S.row_id(F.col("event_id"), F.col("rule_id"), F.col("mapping")).alias("uuid"),
        F.coalesce("rule_machine_id", F.lit(-1)).alias("rule_machine_id"),
    )


@query("alarm_path", f"{ROUTE} WHERE action_type <> '2'")
def alarm_path(spark, sf):
    """Rows routed to the alarm test."""
    return R.alarm_path(tagged(spark, sf)).select(
        "event_id", "rule_id", "trigger_type",
        S.row_id(F.col("event_id"), F.col("rule_id"), F.col("mapping")).alias("uuid"),
        F.coalesce("rule_machine_id", F.lit(-1)).alias("rule_machine_id"),
    )


@query("tagged_points", ROUTE)
def tagged_points(spark, sf):
    """Data points tagged with rules and flattened; scheduled controls left out."""
    return tagged(spark, sf).select(
        "event_id", "rule_id", "trigger_type",
        S.row_id(F.col("event_id"), F.col("rule_id"), F.col("mapping")).alias("uuid"),
        F.coalesce("rule_machine_id", F.lit(-1)).alias("rule_machine_id"),
    )


@query(
    "rule_lists_flat",
    """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS rule_id FROM orders
         WHERE o_orderpriority <> '1-URGENT'
       UNION ALL
       SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) FROM orders
         WHERE o_orderpriority <> '1-URGENT'
       UNION ALL
       SELECT o_orderkey, CAST(o_orderkey + 1 AS VARCHAR) FROM orders
         WHERE o_orderstatus <> 'F'""",
)
def rule_lists_flat(spark, sf):
    """Two comma separated rule lists (device, template) to one row per rule."""
    o = B.table(spark, sf, "orders")
    rows = o.select(
        "o_orderkey",
        F.when(
            F.col("o_orderpriority") != "1-URGENT",
            F.concat_ws(",", "o_custkey", "o_orderkey"),
        ).alias("device_rules"),
        F.when(
            F.col("o_orderstatus") != "F", (F.col("o_orderkey") + 1).cast("string")
        ).alias("template_rules"),
    )
    return R.flatten_rule_lists(rows, "device_rules", "template_rules")


@query(
    "points_with_rules",
    f"""WITH {O.POINTS} SELECT event_id, sn FROM pt
        WHERE unique_data_point_id IN (SELECT o_custkey FROM orders)""",
)
def points_with_rules(spark, sf):
    """Data points that any rule watches."""
    watched = B.unique_rules(spark, sf).select("unique_data_point_id")
    return R.points_with_rules(B.points(spark, sf), watched).select("event_id", "sn")


@query(
    "point_rule_keys",
    f"""{O.with_(O.POINTS, O.TAGS)} SELECT unique_data_point_id, rule_id,
          count(*) AS n FROM tg GROUP BY ALL""",
)
def point_rule_keys(spark, sf):
    """Rows per (point, rule), the key of the alarm state."""
    rows = R.tag_points(
        B.points(spark, sf), B.unique_rules(spark, sf), B.template_rules(spark, sf)
    )
    return rows.groupBy("unique_data_point_id", "rule_id").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "recovery_messages",
    f"""SELECT o_orderkey, '{S.RECOVERY_PREFIX}' || CAST(o_orderkey AS VARCHAR) AS msg,
          sha256(CAST(o_custkey AS VARCHAR) || '|' || CAST(o_orderkey AS VARCHAR))
            AS row_id
        FROM orders""",
)
def recovery_messages(spark, sf):
    """Recovery texts and row ids."""
    return B.table(spark, sf, "orders").select(
        "o_orderkey",
        S.recovery_message(F.col("o_orderkey")).alias("msg"),
        S.row_id(F.col("o_custkey"), F.col("o_orderkey")).alias("row_id"),
    )


@query(
    "status_and_ticks",
    f"""WITH {O.STATUS} SELECT sn, status, t FROM st
        UNION ALL
        SELECT CAST(o_custkey AS VARCHAR), '0', epoch_us(o_orderdate) FROM orders""",
)
def status_and_ticks(spark, sf):
    """Status reports and clock ticks as one stream of status rows."""
    ticks = B.table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("sn"),
        F.lit("0").alias("status"),
        F.col("o_orderdate").alias("ts"),
    )
    both = R.with_ticks(B.status(spark, sf).drop("event_id"), ticks)
    return both.select("sn", "status", F.unix_micros("ts").alias("t"))


@query(
    "split_streams",
    f"""WITH {O.STATUS} SELECT 'main' AS stream, event_id, sn FROM st
        UNION ALL SELECT 'side', event_id, sn FROM st""",
)
def split_streams(spark, sf):
    """Every row to the main and to the side stream."""
    rows = B.status(spark, sf).select("event_id", "sn")
    return rows.select(
        F.explode(F.array(F.lit("main"), F.lit("side"))).alias("stream"), "*"
    )
