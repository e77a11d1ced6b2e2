"""Queries over time: windows, alarms, frequencies, notifications, commands."""

from __future__ import annotations

from pyspark.sql import functions as F

from alarmloom.functions import scalars as S
from alarmloom.operators import alarms as A
from alarmloom.operators import control as K
from alarmloom.operators import frequency as Q
from alarmloom.operators import push as P
from alarmloom.operators import rules as R
from alarmloom.operators import windows as W
from alarmloom.operators.hotkeys import (
    CHECKED,
    CHUNK,
    DEFAULT_POLICY,
    SplitPolicy,
    split_hot_keys,
)
from alarmloom.plans import oracle as O
from alarmloom.plans import testbed as B
from alarmloom.plans.catalog_points import TAG_CTES, details, tagged
from alarmloom.plans.registry import query

HOUR = B.HOUR
HOUR_US = O.HOUR_US


def horizon(spark, sf):
    return A.end_of(B.table(spark, sf, "events"), "ts")


def by_gateway(even, odd):
    """A setting that differs between gateways."""
    return F.when(F.col("sn").cast("bigint") % 2 == 0, even).otherwise(odd)


def by_gateway_sql(even, odd):
    return f"CASE WHEN user_id % 2 = 0 THEN {even} ELSE {odd} END"


# -- windows and watermarks ----------------------------------------------------

ARRIVALS = f"""ev AS (
  SELECT event_id, event_type AS name, epoch_us(ts) AS t,
         epoch_us(ts) + CAST(json_extract_string(props, '$.k') AS BIGINT) * 60000000
           AS arrival FROM events)"""


def arrivals(spark, sf):
    """Named rows that arrive up to 99 minutes late."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    return B.table(spark, sf, "events").select(
        "event_id",
        F.col("event_type").alias("name"),
        "ts",
        F.timestamp_micros(F.unix_micros("ts") + k * 60_000_000).alias("arrival"),
    )


def bounds(df):
    return df.select(
        "event_id", "name",
        F.unix_millis("start").alias("start_ms"), F.unix_millis("end").alias("end_ms"),
    )


def bounds_sql(column):
    return f"""SELECT event_id, name, ({column} - {column} % {HOUR_US}) // 1000
      AS start_ms, ({column} - {column} % {HOUR_US} + {HOUR_US}) // 1000 AS end_ms"""


@query("tumbling_event_time", f"WITH {ARRIVALS} {bounds_sql('t')} FROM ev")
def tumbling_event_time(spark, sf):
    """Every row stamped with its event-time window."""
    return bounds(W.tumbling(arrivals(spark, sf), "ts", "1 hour"))


@query("tumbling_arrival_time", f"WITH {ARRIVALS} {bounds_sql('arrival')} FROM ev")
def tumbling_arrival_time(spark, sf):
    """Every row stamped with the window it arrived in."""
    return bounds(W.tumbling(arrivals(spark, sf), "arrival", "1 hour"))


@query(
    "window_labels",
    f"""WITH {ARRIVALS} SELECT event_id,
        '-----start:--' || CAST(start_ms AS VARCHAR) || '----end:--' ||
        CAST(end_ms AS VARCHAR) AS "window" FROM ({bounds_sql('t')} FROM ev)""",
)
def window_labels(spark, sf):
    """Every row with its window as a text."""
    rows = W.window_label(W.tumbling(arrivals(spark, sf), "ts", "1 hour"))
    return rows.select("event_id", "window")


@query(
    "json_event_times",
    f"""WITH {ARRIVALS} SELECT event_id,
          (t // 1000 * 1000 - t // 1000 * 1000 % {HOUR_US}) // 1000 AS start_ms FROM ev""",
)
def json_event_times(spark, sf):
    """JSON rows windowed by the time in their text."""
    lines = B.table(spark, sf, "events").select(
        "event_id",
        F.to_json(F.struct(F.unix_millis("ts").alias("time"))).alias("value"),
    )
    rows = W.tumbling(W.json_event_time(lines), "ts", "1 hour")
    return rows.select("event_id", F.unix_millis("start").alias("start_ms"))


WATERMARK = """max(t) OVER (ORDER BY arrival, event_id
  ROWS UNBOUNDED PRECEDING) - 1800001000"""


@query(
    "late_rows_dropped",
    f"""WITH {ARRIVALS}, m AS (SELECT *, {WATERMARK}
          AS wm FROM ev)
        {bounds_sql('t')} FROM m
        WHERE t - t % {HOUR_US} + {HOUR_US} - 1000 > wm""",
)
def late_rows_dropped(spark, sf):
    """Windowed rows less those that arrive after their window closed."""
    windowed = W.tumbling(arrivals(spark, sf), "ts", "1 hour")
    return bounds(W.drop_late(windowed, "ts", "arrival", "event_id", 1_800_000))


@query(
    "latest_per_name",
    """SELECT user_id, max(epoch_us(ts)) AS t, arg_max(event_id, (ts, event_id))
         AS event_id, arg_max(value, (ts, event_id)) AS value
       FROM events GROUP BY user_id""",
)
def latest_per_name(spark, sf):
    """The latest row of every key."""
    e = B.table(spark, sf, "events").select("user_id", "ts", "event_id", "value")
    return Q.latest_per_key(e, ["user_id"], "ts", "event_id").select(
        "user_id", F.unix_micros("ts").alias("t"), "event_id", "value"
    )


# -- alarms --------------------------------------------------------------------


@query(
    "first_offline_alarms",
    f"""WITH {O.STATUS},
        g AS (SELECT *, sum(CASE WHEN status = '1' THEN 1 ELSE 0 END)
                OVER (PARTITION BY sn ORDER BY t, event_id) AS grp FROM st),
        r AS (SELECT sn, grp, min(t) AS run_start_us FROM g WHERE status = '0'
              GROUP BY ALL),
        e AS (SELECT sn, grp - 1 AS grp, t AS recover_us FROM g WHERE status = '1')
        SELECT r.sn, run_start_us, run_start_us + {6 * HOUR_US} AS due_us,
               COALESCE(recover_us, -1) AS recover_us
        FROM r LEFT JOIN e ON r.sn = e.sn AND r.grp = e.grp
        WHERE COALESCE(recover_us > run_start_us + {6 * HOUR_US},
                       run_start_us + {6 * HOUR_US} <= {O.HORIZON})""",
)
def first_offline_alarms(spark, sf):
    """The first alarm of every offline run of at least six hours."""
    off = B.status(spark, sf).withColumn("off", F.col("status") == "0")
    out = A.first_alarms(
        off, ["sn"], "off", F.lit(6 * HOUR), horizon=horizon(spark, sf)
    )
    return out.withColumn("recover_us", F.coalesce("recover_us", F.lit(-1)))


OFF_ROWS = f"""src AS (
  SELECT sn, t, event_id, user_id, status,
         CASE WHEN status = '0' THEN 1 ELSE -1 END AS kind,
         t + {by_gateway_sql(6 * HOUR_US, 12 * HOUR_US)} AS due FROM st)"""
FIRES = f"kind = 1 AND COALESCE(w_next > w_due, w_due <= {O.HORIZON})"

DELAYED_SQL = f"""{O.with_(O.STATUS, OFF_ROWS, O.windows('src', 'sn'))}
  SELECT sn, event_id, CASE WHEN kind = 1 THEN w_due ELSE t END AS emit_us,
         kind = -1 AS recover
  FROM w WHERE ({FIRES}) OR (kind = -1 AND w_first < t)"""


# Chunks so small that many keys of the given tables count as hot.
FINE = SplitPolicy(target_rows=20)


def delayed_alarm_rows(spark, sf, policy=DEFAULT_POLICY):
    off = B.status(spark, sf).withColumn("off", F.col("status") == "0")
    return A.delayed_alarms(
        off, ["sn"], "off", by_gateway(6 * HOUR, 12 * HOUR),
        horizon=horizon(spark, sf), policy=policy,
    ).select("sn", "event_id", "emit_us", "recover")


@query("delayed_alarms", DELAYED_SQL)
def delayed_alarms(spark, sf):
    """Gateways off for six or twelve hours, alarming again, with one recovery."""
    return delayed_alarm_rows(spark, sf)


@query("delayed_alarms_split", DELAYED_SQL)
def delayed_alarms_split(spark, sf):
    """The same with hot gateways cut into chunks."""
    return delayed_alarm_rows(spark, sf, FINE)


OFFLINE_CTES = (O.STATUS, OFF_ROWS, O.windows("src", "sn"), f"""oa AS (
  SELECT sn, {S.OFFLINE_RULE_ID} AS rule_id,
         CASE WHEN kind = 1 THEN '{S.OFFLINE_ALARM_TEXT}'
              ELSE '{S.OFFLINE_RECOVERY_TEXT}' END AS msg,
         CASE WHEN kind = 1 THEN w_due ELSE t END AS emit_us,
         CASE WHEN kind = 1 THEN '0' ELSE '1' END AS status, event_id
  FROM w WHERE ({FIRES}) OR kind = -1)""")


@query("offline_alarms", O.with_(*OFFLINE_CTES) + "SELECT * FROM oa")
def offline_alarms(spark, sf):
    """Offline alarms where every report of being on recovers."""
    return offline_alarm_rows(spark, sf).drop(CHUNK)


def offline_alarm_rows(spark, sf):
    return A.offline_alarms(
        B.split_status(spark, sf), by_gateway(6 * HOUR, 12 * HOUR),
        horizon=horizon(spark, sf), policy=CHECKED,
    )


@query(
    "once_reminders",
    O.with_(*OFFLINE_CTES) + "SELECT sn, emit_us, event_id FROM oa WHERE status = '0'",
)
def once_reminders(spark, sf):
    """One reminder per offline alarm."""
    return A.once_reminders(offline_alarms(spark, sf)).select(
        "sn", "emit_us", "event_id"
    )


REMINDERS_SQL = f"""{O.with_(*OFFLINE_CTES, f'''
  ch AS (SELECT *, lag(status) OVER (PARTITION BY sn ORDER BY emit_us, event_id) AS was
         FROM oa),
  ed AS (SELECT *, lead(emit_us) OVER (PARTITION BY sn ORDER BY emit_us, event_id)
           AS nx FROM ch WHERE status <> COALESCE(was, '1')),
  ep AS (SELECT sn, emit_us AS start_us, nx,
           CAST({by_gateway_sql(HOUR_US, 5 * HOUR_US).replace('user_id',
             'CAST(sn AS BIGINT)')} AS BIGINT) AS i
         FROM ed WHERE status = '0')''')}
  SELECT sn, start_us, n, start_us + n * i AS due_us FROM (
    SELECT sn, start_us, i, nx, unnest(range(1,
      CAST((COALESCE(nx - 1, {O.HORIZON}) - start_us) // i + 1 AS BIGINT))) AS n
    FROM ep)"""


@query("repeat_reminders", REMINDERS_SQL)
def repeat_reminders(spark, sf):
    """A reminder every one or five hours while a gateway stays in alarm."""
    alarms = offline_alarm_rows(spark, sf)
    rows = alarms.select(
        "sn", "event_id", *A.chunk_of(alarms), (F.col("status") == "0").alias("on"),
        F.timestamp_micros("emit_us").alias("ts"),
    )
    return A.repeat_reminders(
        rows, ["sn"], "on", by_gateway(HOUR, 5 * HOUR), horizon=horizon(spark, sf),
        policy=CHECKED,
    )


# -- frequencies ---------------------------------------------------------------

COUNT_ROWS = f"""src AS (
  SELECT sn, t, event_id, user_id, status,
         CASE WHEN status = '0' THEN 1 ELSE 0 END AS kind,
         t + {by_gateway_sql(24 * HOUR_US, 72 * HOUR_US)} AS due FROM st)"""


def off_count_sql(reached):
    return f"""{O.with_(O.STATUS, COUNT_ROWS, O.windows('src', 'sn'))}
      SELECT sn, {S.OFF_COUNT_RULE_ID} AS rule_id,
             CASE WHEN kind = 1 THEN '{S.OFFLINE_ALARM_TEXT}'
                  ELSE '{S.OFF_COUNT_RECOVERY_TEXT}' END AS msg, t AS emit_us,
             CASE WHEN kind = 1 THEN '0' ELSE '1' END AS status, event_id
      FROM w WHERE (kind = 1 AND {reached}) OR (kind = 0 AND w_due IS NULL)"""


@query("off_count_alarms", off_count_sql(f"w_pos = {by_gateway_sql(2, 3)}"))
def off_count_alarms(spark, sf):
    """Gateways off two (three) times within one (three) days."""
    return Q.off_count_alarms(
        B.status(spark, sf), by_gateway(24 * HOUR, 72 * HOUR), by_gateway(2, 3)
    )


@query("off_count_alarms_split", off_count_sql(f"w_pos = {by_gateway_sql(2, 3)}"))
def off_count_alarms_split(spark, sf):
    """The same with hot gateways cut into chunks."""
    return Q.off_count_alarms(
        B.status(spark, sf), by_gateway(24 * HOUR, 72 * HOUR), by_gateway(2, 3),
        policy=FINE,
    )


@query(
    "off_count_alarms_literal",
    off_count_sql(f"w_pos >= 2 AND {by_gateway_sql(2, 3)} <= 2"),
)
def off_count_alarms_literal(spark, sf):
    """The same with the studied job's slip: the count is never stored."""
    return Q.off_count_alarms(
        B.status(spark, sf), by_gateway(24 * HOUR, 72 * HOUR), by_gateway(2, 3),
        literal=True,
    )


DISCONNECTS = """dc AS (
  SELECT sn, user_id, on_t, t, event_id FROM (
    SELECT *, lag(status) OVER k AS was, lag(t) OVER k AS on_t FROM st
    WINDOW k AS (PARTITION BY sn ORDER BY t, event_id))
  WHERE was = '1' AND status = '0')"""


@query(
    "disconnects",
    f"""WITH {O.STATUS}, {DISCONNECTS} SELECT sn, on_t AS online_us, t AS offline_us,
        event_id FROM dc""",
)
def disconnects(spark, sf):
    """A report of being on directly followed by one of being off."""
    return Q.disconnects(B.status(spark, sf)).select(
        "sn", F.unix_micros("online_ts").alias("online_us"),
        F.unix_micros("offline_ts").alias("offline_us"), "event_id",
    )


FREQUENCY_ROWS = f"""src AS (
  SELECT *, 1 AS kind, on_t + {by_gateway_sql(72 * HOUR_US, 168 * HOUR_US)} AS due
  FROM dc)"""


FREQUENCY_SQL = f"""{O.with_(O.STATUS, DISCONNECTS, FREQUENCY_ROWS,
                              O.windows('src', 'sn'))}
      SELECT sn, {S.DISCONNECT_RULE_ID} AS rule_id,
             '{S.DISCONNECT_ALARM_TEXT}' AS msg, t AS emit_us, '0' AS status, event_id
      FROM w WHERE w_pos > {by_gateway_sql(1, 2)}
      UNION ALL
      SELECT sn, {S.DISCONNECT_RULE_ID}, '{S.DISCONNECT_RECOVERY_TEXT}', w_due, '1',
             event_id
      FROM w WHERE COALESCE(w_next > w_due, w_due <= {O.HORIZON})"""


def frequency_rows(spark, sf, pairs, policy):
    return Q.disconnect_frequency(
        pairs,
        by_gateway(72 * HOUR, 168 * HOUR),
        by_gateway(1, 2),
        horizon=horizon(spark, sf),
        policy=policy,
    )


@query("disconnect_frequency", FREQUENCY_SQL)
def disconnect_frequency(spark, sf):
    """Gateways that disconnect more than once (twice) within three (seven) days."""
    pairs = Q.disconnects(B.split_status(spark, sf), policy=CHECKED)
    return frequency_rows(spark, sf, pairs, CHECKED)


@query("disconnect_frequency_split", FREQUENCY_SQL)
def disconnect_frequency_split(spark, sf):
    """The same with hot gateways cut into chunks."""
    status, _ = split_hot_keys(B.status(spark, sf), ["sn"], "ts", "event_id", FINE)
    return frequency_rows(spark, sf, Q.disconnects(status, policy=CHECKED), CHECKED)


# -- rule alarms ---------------------------------------------------------------

KEYS = ["unique_data_point_id", "rule_id"]


def rule_alarms_frame(spark, sf, rules, policy=DEFAULT_POLICY):
    """Alarms and recoveries of all rules over all data points.

    Only what the alarm test needs goes through it; texts and actions are attached
    to the far fewer rows that come out.
    """
    tags = R.alarm_path(tagged(spark, sf, rules, policy))
    rows = tags.select(
        *KEYS, *A.chunk_of(tags), "event_id", "ts", "sn", "datapoint_id", "delay",
        "trigger_type",
        S.trigger_holds(F.col("text"), F.col("number"), F.col("trigger")).alias("holds"),
    )
    return A.delayed_alarms(
        rows, KEYS, "holds", F.col("delay"), horizon=horizon(spark, sf), policy=CHECKED
    )


def uuid():
    return S.row_id(F.col("event_id"), F.col("rule_id")).alias("uuid")


ALARM_CTES = (*TAG_CTES, O.ALARM_ROWS, """src AS (
  SELECT *, CASE WHEN holds THEN 1 ELSE -1 END AS kind, t + delay * 1000000 AS due
  FROM ar)""", O.windows("src", "unique_data_point_id, rule_id"), f"""al AS (
  SELECT *, CASE WHEN kind = 1 THEN w_due ELSE t END AS emit_us,
         kind = -1 AS recover,
         CASE WHEN kind = 1 THEN alarm_msg
              ELSE '{S.RECOVERY_PREFIX}' || CAST(rule_id AS VARCHAR) END AS msg
  FROM w WHERE ({FIRES}) OR (kind = -1 AND w_first < t))""")


RULE_ALARMS_SQL = O.with_(*ALARM_CTES) + """SELECT unique_data_point_id, rule_id,
  event_id, sn, emit_us, recover, msg, TRUE AS storage FROM al"""


def rule_alarm_rows(spark, sf, policy=DEFAULT_POLICY):
    rules = details(spark, sf)
    texts = rules.select("rule_id", "alarm_msg")
    msg = F.when(F.col("recover"), S.recovery_message(F.col("rule_id"))).otherwise(
        F.col("alarm_msg")
    )
    return rule_alarms_frame(spark, sf, rules, policy).join(texts, "rule_id").select(
        *KEYS, "event_id", "sn", "emit_us", "recover", msg.alias("msg"), "storage"
    )


@query("rule_alarms", RULE_ALARMS_SQL)
def rule_alarms(spark, sf):
    """Delayed alarms and recoveries of every rule over every data point."""
    return rule_alarm_rows(spark, sf)


@query("rule_alarms_split", RULE_ALARMS_SQL)
def rule_alarms_split(spark, sf):
    """The same with hot points cut into chunks before they meet their rules."""
    return rule_alarm_rows(spark, sf, FINE)


@query(
    "push_messages",
    O.with_(*ALARM_CTES, f"""pa AS (SELECT * EXCLUDE (w_next) FROM al
         WHERE action_type = '3'),
       once AS (SELECT unique_data_point_id, rule_id,
           arg_min(event_id, (emit_us, event_id)) AS event_id,
           min(emit_us) AS push_us FROM pa
         WHERE COALESCE(push_interval, 0) <= 0 AND push_frequency = 0 AND NOT recover
         GROUP BY ALL),
       i1 AS (SELECT *, lag(recover) OVER k AS was, lead(emit_us) OVER k AS nx FROM pa
         WHERE push_interval > 0
         WINDOW k AS (PARTITION BY unique_data_point_id, rule_id
                      ORDER BY emit_us, event_id)),
       i2 AS (SELECT *, sum(CASE WHEN NOT recover AND COALESCE(was, TRUE)
                            THEN 1 ELSE 0 END)
           OVER (PARTITION BY unique_data_point_id, rule_id
                 ORDER BY emit_us, event_id) AS episode FROM i1),
       ep AS (SELECT unique_data_point_id, rule_id, episode,
           min(emit_us) FILTER (WHERE NOT recover) AS start_us,
           min(emit_us) FILTER (WHERE recover) AS end_us,
           CAST(max(push_interval) AS BIGINT) * 1000000 AS i
         FROM i2 GROUP BY ALL),
       du AS (SELECT *, start_us + i * unnest(range(1, CAST(
             (COALESCE(end_us - 1, {O.HORIZON}) - start_us) // i + 1 AS BIGINT)))
           AS push_us FROM ep),
       aa AS (SELECT * FROM i2 WHERE NOT recover)""")
    + """SELECT p.*, e.sn, dt.alarm_msg AS msg, ',1,2,' AS push_way,
           CAST(dt.cond AS VARCHAR) AS trigger_condition
         FROM (
           SELECT unique_data_point_id, rule_id, event_id, push_us FROM once
           UNION ALL
           SELECT du.unique_data_point_id, du.rule_id, aa.event_id, du.push_us
           FROM du ASOF JOIN aa ON du.unique_data_point_id = aa.unique_data_point_id
             AND du.rule_id = aa.rule_id AND du.push_us >= aa.emit_us) p
         JOIN dt ON dt.id = p.rule_id
         JOIN (SELECT event_id, CAST(user_id AS VARCHAR) AS sn FROM events) e
           ON e.event_id = p.event_id""",
)
def push_messages(spark, sf):
    """Notifications: once per key, or at an interval with the latest alarm."""
    rules = details(spark, sf)
    actions = rules.select(
        "rule_id",
        "action_type",
        F.col("action.pushInterval").alias("push_interval"),
        F.col("action.pushFrequency").alias("push_frequency"),
    )
    payload = rules.select(
        "rule_id",
        F.col("alarm_msg").alias("msg"),
        F.col("action.pushWay").alias("push_way"),
        F.get_json_object("trigger_json", "$.triggerCondition").alias(
            "trigger_condition"
        ),
    )
    alarms = rule_alarms_frame(spark, sf, rules).drop("ts").join(actions, "rule_id")
    pushes = P.push_messages(alarms, KEYS, "event_id", horizon(spark, sf), CHECKED)
    return pushes.join(payload, "rule_id").select(
        *KEYS, "event_id", "push_us", "sn", "msg", "push_way", "trigger_condition"
    )


# -- control commands ----------------------------------------------------------

COMMANDS = f"""
  fu AS (SELECT rule_id, unique_data_point_id, min(position) AS pos,
           arg_min(element_type, position) AS et, arg_min(machine_id, position) AS mach
         FROM el WHERE del_flag = 0 AND element_type IN ('0', '1') GROUP BY ALL),
  ft AS (SELECT rule_id, data_point_id, min(position) AS pos,
           arg_min(machine_id, position) AS mach
         FROM el WHERE del_flag = 0 AND element_type = '2' GROUP BY ALL),
  ma AS (SELECT cr.*,
           CASE WHEN ft.pos IS NULL OR fu.pos < ft.pos THEN fu.et ELSE '2' END AS kind2,
           CASE WHEN ft.pos IS NULL OR fu.pos < ft.pos THEN fu.mach ELSE ft.mach END
             AS mach
         FROM cr
         LEFT JOIN fu ON cr.rule_id = fu.rule_id
           AND cr.unique_data_point_id = fu.unique_data_point_id
         LEFT JOIN ft ON cr.rule_id = ft.rule_id AND cr.datapoint_id = ft.data_point_id
         WHERE fu.pos IS NOT NULL OR ft.pos IS NOT NULL),
  ac AS (SELECT o_orderkey AS rid, 1 AS ctype, o_orderkey % 100 AS cpoint,
           'set-' || CAST(o_orderkey AS VARCHAR) AS cdata FROM orders
           WHERE o_orderpriority <> '5-LOW'
         UNION ALL
         SELECT o_orderkey, 0, o_orderkey % 101, 'read' FROM orders
           WHERE o_orderpriority = '1-URGENT'),
  mr AS (SELECT o_custkey, o_orderkey FROM orders),
  co AS (SELECT ma.uuid AS alarm_uuid, ma.rule_id, ma.sn AS control_sn,
           ac.ctype AS control_type, ac.cdata AS control_data,
           ma.rule_id % 7 AS opera_data_point_id,
           COALESCE(CASE kind2 WHEN '1' THEN mach WHEN '2' THEN mr.o_orderkey END, -1)
             AS control_machine_id,
           COALESCE(CASE WHEN kind2 = '2' THEN c_custkey ELSE ac.cpoint END, -1)
             AS unique_data_point_id
         FROM ma JOIN ac ON ma.rule_id = ac.rid
         LEFT JOIN mr ON CAST(mr.o_custkey AS VARCHAR) = ma.sn AND kind2 = '2'
         LEFT JOIN customer ON CAST(c_custkey AS VARCHAR) = ma.sn
           AND c_nationkey = ma.rule_id % 25)"""


def commands(spark, sf, rows):
    matched = K.match_elements(rows, B.rule_elements(spark, sf))
    out = K.control_commands(
        matched, B.point_relation(spark, sf), B.machine_relation(spark, sf)
    )
    return out.select(
        "alarm_uuid", "rule_id", "control_sn", "control_type", "control_data",
        F.col("opera_data_point_id").cast("bigint").alias("opera_data_point_id"),
        F.coalesce("control_machine_id", F.lit(-1)).alias("control_machine_id"),
        F.coalesce("unique_data_point_id", F.lit(-1)).alias("unique_data_point_id"),
    )


@query(
    "control_from_rules",
    O.with_(*TAG_CTES, """cr AS (SELECT uuid, rule_id, unique_data_point_id,
         datapoint_id, sn FROM tr WHERE action_type = '2' AND trigger_type <> '2')""",
            COMMANDS)
    + "SELECT * FROM co",
)
def control_from_rules(spark, sf):
    """Commands of control rules that data points drive directly."""
    each = S.row_id(F.col("event_id"), F.col("rule_id"), F.col("mapping"))
    rows = R.direct_controls(tagged(spark, sf)).select(
        each.alias("uuid"), *KEYS, "datapoint_id", "sn", "action", "trigger_json"
    )
    return commands(spark, sf, rows)


@query(
    "control_from_alarms",
    O.with_(*ALARM_CTES, """cr AS (SELECT al.uuid, dt.id AS rule_id,
         al.unique_data_point_id, al.datapoint_id, al.sn
         FROM al JOIN rl r2 ON CAST(r2.rely_rule_id AS BIGINT) = al.rule_id
         JOIN dt ON dt.id = r2.id WHERE al.trigger_type = '2')""", COMMANDS)
    + "SELECT * FROM co",
)
def control_from_alarms(spark, sf):
    """Commands of control rules that alarms and recoveries drive."""
    all_rules = B.rules(spark, sf)
    mapping = R.controls_of_alarms(
        all_rules.filter(F.col("rely_rule_id").isNotNull()),
        all_rules.select(F.col("id").alias("alarm_id")),
    )
    rules = details(spark, sf)
    alarms = rule_alarms_frame(spark, sf, rules).select(
        uuid(), *KEYS, "datapoint_id", "sn", "trigger_type"
    )
    controls = rules.select("rule_id", "trigger_json", "action")
    rows = K.alarm_driven_rows(alarms, mapping).join(controls, "rule_id")
    return commands(spark, sf, rows)


@query(
    "command_machine_lists",
    O.with_(*TAG_CTES, """cr AS (SELECT uuid, rule_id, unique_data_point_id,
         datapoint_id, sn FROM tr WHERE action_type = '2' AND trigger_type <> '2')""",
            COMMANDS.replace("ac.cdata AS control_data,", "ac.cdata AS control_data, ac.n,")
            .replace("SELECT o_orderkey AS rid, 1 AS ctype", "SELECT o_orderkey AS rid, 0 AS n, 1 AS ctype")
            .replace("SELECT o_orderkey, 0, o_orderkey % 101", "SELECT o_orderkey, 1, 0, o_orderkey % 101"))
    + """SELECT alarm_uuid, rule_id, control_data,
           coalesce(string_agg(DISTINCT CAST(nullif(control_machine_id, -1) AS VARCHAR), ','
             ORDER BY CAST(nullif(control_machine_id, -1) AS VARCHAR)), '') AS machines
         FROM co GROUP BY alarm_uuid, rule_id, control_data, n""",
)
def command_machine_lists(spark, sf):
    """Direct commands as one row each, with their machines as a sorted text."""
    rows = R.direct_controls(tagged(spark, sf)).select(
        S.row_id(F.col("event_id"), F.col("rule_id"), F.col("mapping")).alias("uuid"),
        *KEYS, "datapoint_id", "sn", "action", "trigger_json",
    )
    flat = K.control_commands(
        K.match_elements(rows, B.rule_elements(spark, sf)),
        B.point_relation(spark, sf), B.machine_relation(spark, sf),
    )
    machines = F.array_sort(F.col("control_machine_ids").cast("array<string>"))
    return K.with_machine_lists(flat).select(
        "alarm_uuid", "rule_id", "control_data",
        F.array_join(machines, ",").alias("machines"),
    )


# -- remembered alarms ---------------------------------------------------------


@query(
    "points_in_alarm",
    O.with_(*OFFLINE_CTES, """lt AS (SELECT sn, arg_max(status, (emit_us, event_id))
         AS status FROM oa GROUP BY sn)""")
    + """SELECT st.event_id, st.sn FROM st
         WHERE sn IN (SELECT sn FROM lt WHERE status = '0')""",
)
def points_in_alarm(spark, sf):
    """Status rows of gateways whose last alarm has not recovered."""
    last = Q.latest_per_key(offline_alarms(spark, sf), ["sn"], "emit_us", "event_id")
    return R.with_last_alarm(
        B.status(spark, sf), last.filter(F.col("status") == S.ALARM), ["sn"]
    ).select("event_id", "sn")


NO_ALARM = off_count_sql(f"w_pos = {by_gateway_sql(2, 3)}")


@query(
    "points_not_yet_alarmed",
    f"""SELECT event_id, CAST(user_id AS VARCHAR) AS sn FROM events
        WHERE CAST(user_id AS VARCHAR) NOT IN (
          SELECT sn FROM ({NO_ALARM}) WHERE status = '0')""",
)
def points_not_yet_alarmed(spark, sf):
    """Status rows of gateways that were never off too often."""
    alarmed = A.once_reminders(off_count_alarms(spark, sf))
    return R.without_alarm(B.status(spark, sf), alarmed, ["sn"]).select(
        "event_id", "sn"
    )
