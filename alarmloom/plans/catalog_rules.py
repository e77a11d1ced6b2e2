"""Queries over rules, their elements and mappings, and their changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from alarmloom.functions import parsing
from alarmloom.operators import changes as C
from alarmloom.operators import rules as R
from alarmloom.operators.hotkeys import DEFAULT_POLICY, SplitPolicy
from alarmloom.plans import oracle as O
from alarmloom.plans import testbed as B
from alarmloom.plans.registry import query

URGENT = "SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'"


def urgent(spark, sf, name):
    """Ids asked for: the urgent orders."""
    o = B.table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    return o.select(F.col("o_orderkey").alias(name))


def building_gateways(spark, sf):
    """Gateways asked for: the customers of one segment."""
    c = B.table(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    return c.select(F.col("c_custkey").cast("string").alias("sn"))


BUILDING = """SELECT CAST(c_custkey AS VARCHAR) FROM customer
              WHERE c_mktsegment = 'BUILDING'"""


@query(
    "active_rule_elements",
    f"""WITH {O.RULES}, {O.ELEMENTS}
        SELECT rl.id, trigger_type, COALESCE(rely_rule_id, '') AS rely_rule_id,
               element_type, machine_id, el.unique_data_point_id, template_id,
               data_point_id, sn, position
        FROM rl JOIN el ON rl.id = el.rule_id
        WHERE rl.del_flag = 0 AND status = 0 AND el.del_flag = 0
          AND rl.id IN ({URGENT})""",
)
def active_rule_elements(spark, sf):
    """Rules in use joined to their elements, for a list of ids."""
    return R.active_rule_elements(
        B.rules(spark, sf), B.rule_elements(spark, sf), urgent(spark, sf, "id")
    ).select(
        "id", "trigger_type",
        F.coalesce("rely_rule_id", F.lit("")).alias("rely_rule_id"),
        "element_type", "machine_id", "unique_data_point_id", "template_id",
        "data_point_id", "sn", "position",
    )


@query(
    "actions_of_rules",
    f"""WITH {O.RULES} SELECT id AS rule_id, action_type, '0' AS execute_mode,
          COALESCE(push_interval, -1) AS push_interval, push_frequency,
          CASE o_orderpriority WHEN '1-URGENT' THEN 2 WHEN '5-LOW' THEN 0 ELSE 1 END
            AS controls
        FROM rl WHERE id IN ({URGENT})""",
)
def actions_of_rules(spark, sf):
    """Actions of a list of rules, with their JSON parsed."""
    from alarmloom import schemas

    rows = R.actions_of_rules(B.rule_actions(spark, sf), urgent(spark, sf, "id"))
    action = F.from_json("action", schemas.ACTION)
    return rows.select("rule_id", "action_type", "execute_mode", action.alias("a")).select(
        "rule_id", "action_type", "execute_mode",
        F.coalesce("a.pushInterval", F.lit(-1)).alias("push_interval"),
        F.col("a.pushFrequency").alias("push_frequency"),
        F.coalesce(F.size("a.controlActionDtos"), F.lit(0)).alias("controls"),
    )


@query(
    "assembled_rules",
    f"""WITH {O.RULES}, {O.ELEMENTS}
        SELECT rl.id, trigger_type, COALESCE(rely_rule_id, '') AS rely_rule_id,
               action_type, element_type, machine_id, el.unique_data_point_id, position
        FROM rl JOIN el ON rl.id = el.rule_id
        WHERE rl.del_flag = 0 AND status = 0 AND el.del_flag = 0""",
)
def assembled_rules(spark, sf):
    """Rules with their elements and action."""
    flat = R.active_rule_elements(B.rules(spark, sf), B.rule_elements(spark, sf))
    return R.assemble_rules(flat, B.rule_actions(spark, sf)).select(
        "id", "trigger_type",
        F.coalesce("rely_rule_id", F.lit("")).alias("rely_rule_id"),
        F.col("rule_action.action_type").alias("action_type"),
        "element_type", "machine_id", "unique_data_point_id", "position",
    )


@query(
    "rule_details",
    f"""{O.with_(O.RULES, O.ELEMENTS, O.DETAILS)}
        SELECT id AS rule_id, trigger_type, rule_machine_id, action_type, delay,
               alarm_msg, COALESCE(push_interval, -1) AS push_interval FROM dt""",
)
def rule_details(spark, sf):
    """Live rules with parsed trigger, parsed action and first machine."""
    return R.rule_details(
        B.rules(spark, sf), B.rule_elements(spark, sf), B.rule_actions(spark, sf)
    ).select(
        "rule_id", "trigger_type", "rule_machine_id", "action_type",
        F.col("delay").cast("bigint").alias("delay"), "alarm_msg",
        F.coalesce("action.pushInterval", F.lit(-1)).alias("push_interval"),
    )


@query(
    "controls_of_alarms",
    f"""WITH {O.RULES} SELECT id AS control_id,
          CAST(rely_rule_id AS BIGINT) AS alarm_id
        FROM rl WHERE CAST(rely_rule_id AS BIGINT) IN ({URGENT})""",
)
def controls_of_alarms(spark, sf):
    """Control rules that rely on a list of alarm rules."""
    return R.controls_of_alarms(B.rules(spark, sf), urgent(spark, sf, "alarm_id"))


@query(
    "elements_of_points",
    f"""WITH {O.ELEMENTS} SELECT unique_data_point_id, rule_id, element_type, position
        FROM el WHERE unique_data_point_id IN (
          SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def elements_of_points(spark, sf):
    """Elements that watch a list of points."""
    asked = building_gateways(spark, sf).select(
        F.col("sn").cast("bigint").alias("unique_data_point_id")
    )
    return R.elements_of_points(B.rule_elements(spark, sf), asked).select(
        "unique_data_point_id", "rule_id", "element_type", "position"
    )


@query(
    "points_of_gateways",
    f"""SELECT c_custkey AS id, CAST(c_custkey AS VARCHAR) AS sn,
          CAST(c_nationkey AS BIGINT) AS device_template_point_id
        FROM customer WHERE CAST(c_custkey AS VARCHAR) IN ({BUILDING})""",
)
def points_of_gateways(spark, sf):
    """Unique points of a list of gateways."""
    return R.points_of_gateways(
        B.point_relation(spark, sf), building_gateways(spark, sf)
    )


@query(
    "machines_of_gateways",
    f"""SELECT CAST(o_custkey AS VARCHAR) AS device_sn, o_orderkey AS machine_id
        FROM orders WHERE CAST(o_custkey AS VARCHAR) IN ({BUILDING})""",
)
def machines_of_gateways(spark, sf):
    """Machines of a list of gateways."""
    return R.machines_of_gateways(
        B.machine_relation(spark, sf), building_gateways(spark, sf)
    )


@query(
    "tagged_points_early",
    f"""WITH {O.POINTS} SELECT event_id, sn, 1 AS device_id,
          COALESCE(o_orderkey, -1) AS rule_id
        FROM pt LEFT JOIN orders ON o_custkey = unique_data_point_id
          AND CAST(o_custkey AS VARCHAR) = sn""",
)
def tagged_points_early(spark, sf):
    """The early tagging: points without rules stay."""
    return R.tag_points_prototype(
        B.points(spark, sf), B.gateway_rules(spark, sf)
    ).select(
        "event_id", "sn", "device_id", F.coalesce("rule_id", F.lit(-1)).alias("rule_id")
    )


# -- changes -------------------------------------------------------------------

CHANGES = """ch AS (
  SELECT epoch_us(l_shipdate) AS t,
         l_orderkey * 100000000 + l_partkey * 10 + l_linenumber AS seq,
         CAST(l_linenumber % 3 AS VARCHAR) AS type, l_suppkey AS id,
         CASE l_returnflag WHEN 'N' THEN '0' WHEN 'A' THEN '1' ELSE '2' END AS action,
         unnest([l_orderkey, l_partkey]) AS rule_id
  FROM lineitem)"""


def rule_changes(spark, sf):
    return parsing.parse_rule_changes(B.rule_change_messages(spark, sf))


@query(
    "rule_mapping_after_changes",
    f"""WITH {CHANGES},
        dl AS (SELECT type, id, max((t, seq)) AS gone FROM ch WHERE action = '2'
               GROUP BY ALL)
        SELECT ch.type, ch.id, ch.rule_id, ch.t FROM ch LEFT JOIN dl
          ON ch.type = dl.type AND ch.id = dl.id
        WHERE action = '0' AND (gone IS NULL OR (t, seq) > gone)""",
)
def rule_mapping_after_changes(spark, sf):
    """Point-to-rule mapping after the whole change log."""
    return C.point_rule_mapping(rule_changes(spark, sf), "ts", "seq").select(
        "type", "id", "rule_id", F.unix_micros("ts").alias("t")
    )


@query(
    "cached_rules_after_changes",
    f"""WITH {CHANGES},
        ld AS (SELECT rule_id, max((t, seq)) AS loaded FROM ch
               WHERE action IN ('0', '1') GROUP BY ALL),
        ev AS (SELECT DISTINCT id, t, seq, rule_id, action FROM ch WHERE type = '0'),
        de AS (SELECT DISTINCT id, t, seq FROM ev WHERE action = '2'),
        gd AS (SELECT a.rule_id, a.id, a.t, a.seq, min((d.t, d.seq)) AS gone
               FROM ev a JOIN de d ON a.id = d.id AND (d.t, d.seq) > (a.t, a.seq)
               WHERE a.action = '0' GROUP BY ALL),
        dr AS (SELECT rule_id, max(gone) AS dropped FROM gd GROUP BY ALL)
        SELECT ld.rule_id FROM ld LEFT JOIN dr ON ld.rule_id = dr.rule_id
        WHERE dropped IS NULL OR loaded > dropped""",
)
def cached_rules_after_changes(spark, sf):
    """Rules whose details are held after the whole change log."""
    return C.cached_rules(rule_changes(spark, sf), "ts", "seq")


@query(
    "rules_of_changed_points",
    f"""WITH {O.ELEMENTS} SELECT sn, unique_data_point_id, rule_id FROM el
        WHERE unique_data_point_id IN (
          SELECT l_suppkey FROM lineitem WHERE l_linenumber % 3 = 0)""",
)
def rules_of_changed_points(spark, sf):
    """The early form of a rule change: all rules of the changed unique points."""
    return C.rules_of_changed_points(
        rule_changes(spark, sf), B.rule_elements(spark, sf)
    )


STALE_CONTROLS = """SELECT o_orderkey AS alarm_id, o_orderkey + 1 AS control_id
                    FROM orders WHERE o_orderstatus = 'F'"""


@query(
    "alarm_controls_resynced",
    f"""WITH {O.RULES},
        fresh AS (SELECT CAST(rely_rule_id AS BIGINT) AS alarm_id, id AS control_id
                  FROM rl WHERE rely_rule_id IS NOT NULL)
        SELECT * FROM ({STALE_CONTROLS}) s WHERE alarm_id NOT IN ({URGENT})
        UNION ALL SELECT * FROM fresh WHERE alarm_id IN ({URGENT})""",
)
def alarm_controls_resynced(spark, sf):
    """Alarm-to-control mapping after a change message per urgent alarm rule."""
    stale = B.table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("alarm_id"),
        (F.col("o_orderkey") + 1).alias("control_id"),
    )
    messages = urgent(spark, sf, "id").select(
        F.to_json(F.struct(F.array("id").alias("alarmRuleId"))).alias("value")
    )
    changed = parsing.parse_alarm_control_changes(messages)
    return C.resync_alarm_controls(stale, B.rules(spark, sf), changed)


@query(
    "machines_rebound",
    f"""WITH fresh AS (SELECT CAST(o_custkey AS VARCHAR) AS sn, o_orderkey AS machine_id
                       FROM orders),
        stale AS (SELECT CAST(o_custkey AS VARCHAR) AS sn, o_orderkey AS machine_id
                  FROM orders WHERE o_orderstatus = 'O'),
        unbound AS (SELECT CAST(c_custkey AS VARCHAR) AS sn FROM customer
                    WHERE c_mktsegment = 'BUILDING'),
        bound AS (SELECT CAST(c_custkey AS VARCHAR) AS sn FROM customer
                  WHERE c_mktsegment = 'MACHINERY'),
        again AS (SELECT sn FROM unbound
                  UNION SELECT sn FROM bound WHERE sn IN (SELECT sn FROM fresh))
        SELECT * FROM stale WHERE sn NOT IN (SELECT sn FROM again)
        UNION ALL SELECT * FROM fresh WHERE sn IN (SELECT sn FROM again)""",
)
def machines_rebound(spark, sf):
    """Gateway-to-machine mapping after bind and unbind messages."""
    o = B.table(spark, sf, "orders")
    stale = o.filter(F.col("o_orderstatus") == "O").select(
        F.col("o_custkey").cast("string").alias("sn"),
        F.col("o_orderkey").alias("machine_id"),
    )
    sn, segment = F.col("c_custkey").cast("string"), F.col("c_mktsegment")
    messages = B.table(spark, sf, "customer").select(
        F.to_json(
            F.struct(
                F.when(segment == "BUILDING", sn).alias("snUnbind"),
                F.when(segment == "MACHINERY", sn).alias("snBind"),
            )
        ).alias("value")
    )
    changed = parsing.parse_device_machine_changes(messages)
    return C.rebind_machines(stale, B.machine_relation(spark, sf), changed)


@query(
    "gateway_points_resynced",
    f"""WITH fresh AS (SELECT CAST(c_custkey AS VARCHAR) AS sn,
                         CAST(c_nationkey AS BIGINT) AS device_template_point_id,
                         c_custkey AS id FROM customer),
        stale AS (SELECT CAST(o_custkey AS VARCHAR) AS sn,
                    o_orderkey % 25 AS device_template_point_id, o_orderkey AS id
                  FROM orders WHERE o_orderstatus = 'O'),
        again AS (SELECT CAST(o_custkey AS VARCHAR) AS sn FROM orders
                  WHERE o_orderpriority = '1-URGENT')
        SELECT * FROM stale WHERE sn NOT IN (SELECT sn FROM again)
        UNION ALL SELECT * FROM fresh WHERE sn IN (SELECT sn FROM again)""",
)
def gateway_points_resynced(spark, sf):
    """Gateway-to-point mapping after change messages."""
    o = B.table(spark, sf, "orders")
    stale = o.filter(F.col("o_orderstatus") == "O").select(
        F.col("o_custkey").cast("string").alias("sn"),
        (F.col("o_orderkey") % 25).alias("device_template_point_id"),
        F.col("o_orderkey").alias("id"),
    )
    messages = o.filter(F.col("o_orderpriority") == "1-URGENT").select(
        F.to_json(
            F.struct(F.array(F.col("o_custkey").cast("string")).alias("sn"))
        ).alias("value")
    )
    changed = parsing.parse_device_point_changes(messages)
    return C.resync_gateway_points(stale, B.point_relation(spark, sf), changed)


AS_OF_SQL = """WITH d AS (SELECT event_id, user_id, epoch_us(ts) AS t FROM events
                  WHERE event_type <> 'signup'),
            c AS (SELECT user_id, epoch_us(ts) AS t, event_id AS version
                  FROM events WHERE event_type = 'signup')
       SELECT d.event_id, d.user_id, COALESCE(version, -1) AS version
       FROM d ASOF LEFT JOIN c ON d.user_id = c.user_id AND d.t >= c.t"""


def as_of_rows(spark, sf, policy):
    e = B.table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    is_change = F.col("event_type") == "signup"
    rows = e.filter(~is_change).drop("event_type")
    out = C.as_of_changes(
        rows, e.filter(is_change), "user_id", "ts", "event_id",
        F.col("event_id"), "version", policy,
    )
    return out.select(
        "event_id", "user_id", F.coalesce("version", F.lit(-1)).alias("version")
    )


@query("points_as_of_changes", AS_OF_SQL)
def points_as_of_changes(spark, sf):
    """Each data row with the version set by the latest change of its key."""
    return as_of_rows(spark, sf, DEFAULT_POLICY)


@query("points_as_of_changes_split", AS_OF_SQL)
def points_as_of_changes_split(spark, sf):
    """The same with hot keys cut into chunks."""
    return as_of_rows(spark, sf, SplitPolicy(target_rows=20))
