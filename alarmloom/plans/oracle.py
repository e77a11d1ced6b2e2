"""DuckDB SQL over the given tables: the testbed views and window labelling.

Written from the definitions, not from the Spark plans: JSON is never involved
here, and sequential rules are recursive queries that visit one row per key and
step.
"""

from __future__ import annotations

HOUR_US = 3_600_000_000

STATUS = """st AS (
  SELECT CAST(user_id AS VARCHAR) AS sn,
         CASE WHEN event_type = 'error' THEN '0' ELSE '1' END AS status,
         epoch_us(ts) AS t, event_id, user_id
  FROM events)"""

POINTS = """pt AS (
  SELECT CAST(user_id AS VARCHAR) AS sn,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS datapoint_id,
         user_id AS unique_data_point_id, CAST(value AS VARCHAR) AS val,
         epoch_us(ts) AS t, event_id
  FROM events)"""

HORIZON = "(SELECT max(epoch_us(ts)) FROM events)"

RULES = """rl AS (
  SELECT o_orderkey AS id, o_custkey,
         CASE WHEN o_orderkey % 5 = 3 THEN CAST(o_orderkey - 2 AS VARCHAR) END
           AS rely_rule_id,
         CASE o_orderkey % 5 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '0'
              WHEN 3 THEN '2' ELSE '3' END AS trigger_type,
         CASE WHEN o_orderkey % 17 = 0 THEN 1 ELSE 0 END AS del_flag,
         CASE WHEN o_orderkey % 19 = 0 THEN 1 ELSE 0 END AS status,
         (o_orderkey + o_custkey) % 7 AS cond,
         CAST(o_orderkey % 40 AS DOUBLE) AS a,
         CAST(o_orderkey % 40 AS VARCHAR) AS a_text,
         CAST(o_orderkey % 60 + 20 AS DOUBLE) AS b,
         CASE WHEN o_orderkey % 23 = 0 THEN 1 ELSE 0 END AS vt,
         'point out of bounds ' || CAST(o_orderkey AS VARCHAR) AS alarm_msg,
         (o_orderkey % 4) * 21600 AS delay,
         CASE WHEN o_orderkey % 3 = 0 THEN 0.0 ELSE o_orderkey % 3 + 0.5 END::DOUBLE
           AS dz,
         CASE WHEN o_orderkey % 5 = 0
              THEN CASE WHEN o_orderkey % 2 = 0 THEN '3' ELSE '1' END
              WHEN o_orderkey % 5 = 1 THEN '3' ELSE '2' END AS action_type,
         CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN 21600
              ELSE 0 END AS push_interval,
         CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 1 END AS push_frequency,
         o_orderpriority
  FROM orders)"""

ELEMENTS = """el AS (
  SELECT l_orderkey AS rule_id, CAST(l_linenumber % 3 AS VARCHAR) AS element_type,
         l_suppkey AS machine_id,
         o_custkey + CASE WHEN l_linenumber > 3 THEN 1 ELSE 0 END
           AS unique_data_point_id,
         l_partkey AS template_id, l_orderkey AS data_point_id,
         CAST(o_custkey AS VARCHAR) AS sn,
         CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS del_flag,
         CAST(l_linenumber AS BIGINT) * 10000000000000 + l_partkey * 10000
           + l_suppkey % 10000 AS position
  FROM lineitem JOIN orders
    ON o_orderkey = l_orderkey - CASE WHEN l_orderkey % 5 = 3 THEN 2 ELSE 0 END)"""

# Live rules: in use and with at least one element; the first one's machine.
DETAILS = """dt AS (
  SELECT rl.*, f.rule_machine_id FROM rl JOIN (
    SELECT rule_id, arg_min(machine_id, position) AS rule_machine_id
    FROM el WHERE del_flag = 0 GROUP BY rule_id) f ON rl.id = f.rule_id
  WHERE rl.del_flag = 0 AND rl.status = 0)"""

TAGS = """tg AS (
  SELECT pt.*, o_orderkey AS rule_id, 0 AS mapping FROM pt
    JOIN orders ON o_custkey = unique_data_point_id
  UNION ALL
  SELECT pt.*, s_suppkey AS rule_id, 1 AS mapping FROM pt JOIN supplier ON s_suppkey = datapoint_id)"""


def holds(literal: bool = False) -> str:
    """The trigger predicate over val, cond, vt, a, a_text, b, dz."""
    num = "(CASE WHEN trim(val) = '' THEN 0 ELSE TRY_CAST(trim(val) AS DOUBLE) END)"
    if literal:
        equals = f"(vt = 0 AND {num} = 0) OR (vt = 1 AND trim(val) = a_text)"
        below = f"vt = 0 AND {num} > b - dz"
        between = outside = "FALSE"
    else:
        equals = f"(vt = 0 AND {num} = a) OR (vt = 1 AND trim(val) = a_text)"
        below = f"vt = 0 AND {num} < b - dz"
        between = f"vt = 0 AND {num} > a + dz AND {num} < b - dz"
        outside = f"vt = 0 AND ({num} < a - dz OR {num} > b + dz)"
    return f"""COALESCE(CASE cond WHEN 0 THEN trim(val) = '1' WHEN 1 THEN trim(val) = '0'
      WHEN 2 THEN {equals} WHEN 3 THEN vt = 0 AND {num} > a + dz
      WHEN 4 THEN {below} WHEN 5 THEN {between} WHEN 6 THEN {outside} END, FALSE)"""


TAGGED_RULES = """tr AS (
  SELECT tg.*, dt.* EXCLUDE (id, o_custkey, del_flag, status),
         sha256(CAST(event_id AS VARCHAR) || '|' || CAST(tg.rule_id AS VARCHAR)
           || '|' || CAST(mapping AS VARCHAR)) AS uuid
  FROM tg JOIN dt ON tg.rule_id = dt.id WHERE dt.trigger_type <> '3')"""

# A rule that watches a point by both of its ids has each row twice; but for the mapping
# the copies are equal, so their order does not matter to alarms.
ALARM_ROWS = f"""ar AS (
  SELECT tr.* EXCLUDE (uuid, mapping),
         sha256(CAST(event_id AS VARCHAR) || '|' || CAST(rule_id AS VARCHAR)) AS uuid, {holds()} AS holds FROM tr WHERE action_type <> '2')"""


def windows(source: str, keys: str, name: str = "w") -> str:
    """CTEs that label ``source`` (keys, t, event_id, kind, due, ...) with windows."""
    key_list = [k.strip() for k in keys.split(",")]
    same = " AND ".join(f"n.{k} = w.{k}" for k in key_list)
    live = "(w.kind <> -1 AND w.w_due IS NOT NULL AND n.t <= w.w_due)"
    opens = "CASE WHEN n.kind = 1 THEN {} END"
    return f"""{name}_n AS MATERIALIZED (
  SELECT *, row_number() OVER k AS rn, lead(t) OVER k AS w_next FROM {source}
  WINDOW k AS (PARTITION BY {keys} ORDER BY t, event_id)),
{name} AS (
  SELECT n.*, {opens.format('due')} AS w_due, {opens.format('t')} AS w_open,
         {opens.format('1')} AS w_pos, {opens.format('due')} AS w_first
  FROM {name}_n n WHERE rn = 1
  UNION ALL
  SELECT n.*,
    CASE WHEN {live} THEN w.w_due ELSE {opens.format('n.due')} END,
    CASE WHEN {live} THEN w.w_open ELSE {opens.format('n.t')} END,
    CASE WHEN {live} THEN w.w_pos + CASE WHEN n.kind = 1 THEN 1 ELSE 0 END
         ELSE {opens.format('1')} END,
    CASE WHEN w.kind <> -1 AND w.w_first IS NOT NULL THEN w.w_first
         ELSE {opens.format('n.due')} END
  FROM {name} w JOIN {name}_n n ON {same} AND n.rn = w.rn + 1)"""


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"
