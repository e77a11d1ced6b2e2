"""Timelines written by hand for every alarm operator."""

import pytest
from pyspark.sql import functions as F

from alarmloom.functions import scalars as S
from alarmloom.operators import alarms as A
from alarmloom.operators import frequency as Q
from alarmloom.operators import push as P
from alarmloom.operators.hotkeys import SplitPolicy

US = 1_000_000
SPLIT = SplitPolicy(target_rows=10)


def timeline(spark, rows):
    """rows of (key, second, value); ids in the order given"""
    data = [(k, s * US, n, v) for n, (k, s, v) in enumerate(rows)]
    kind = "boolean" if isinstance(rows[0][2], bool) else "string"
    df = spark.createDataFrame(data, f"sn string, t long, event_id long, v {kind}")
    return df.withColumn("ts", F.timestamp_micros("t"))


def delayed(spark, rows, delay=10, horizon=None, **kw):
    df = timeline(spark, rows)
    end = None if horizon is None else F.lit(horizon * US)
    out = A.delayed_alarms(df, ["sn"], "v", F.lit(delay), horizon=end, **kw).collect()
    return sorted(
        (r.sn, r.emit_us // US, "recover" if r.recover else "alarm", r.t // US)
        for r in out
    )


CASES = {
    "cancelled": ([("k", 0, True), ("k", 5, False)], {}, []),
    "held": (
        [("k", 0, True), ("k", 5, True), ("k", 12, False)], {},
        [("k", 10, "alarm", 5), ("k", 12, "recover", 12)],
    ),
    "tie": ([("k", 0, True), ("k", 10, False)], {}, []),
    "again": (
        [("k", 0, True), ("k", 11, True), ("k", 25, False)], {},
        [("k", 10, "alarm", 0), ("k", 21, "alarm", 11), ("k", 25, "recover", 25)],
    ),
    "recover once": (
        [("k", 0, True), ("k", 12, False), ("k", 13, False)], {},
        [("k", 10, "alarm", 0), ("k", 12, "recover", 12)],
    ),
    "recover on every clear": (
        [("k", 0, True), ("k", 12, False), ("k", 13, False)],
        {"recover_on_every_clear": True},
        [("k", 10, "alarm", 0), ("k", 12, "recover", 12), ("k", 13, "recover", 13)],
    ),
    "open, not yet due": ([("k", 0, True)], {"horizon": 9}, []),
    "open, due": ([("k", 0, True)], {"horizon": 10}, [("k", 10, "alarm", 0)]),
    "open, default horizon": (
        [("k", 0, True), ("other", 10, False)], {}, [("k", 10, "alarm", 0)],
    ),
    "zero delay": (
        [("k", 0, True), ("k", 1, True), ("k", 2, False)], {"delay": 0},
        [("k", 0, "alarm", 0), ("k", 1, "alarm", 1), ("k", 2, "recover", 2)],
    ),
    "two keys": (
        [("a", 0, True), ("b", 1, True), ("a", 5, False), ("b", 13, False)], {},
        [("b", 11, "alarm", 1), ("b", 13, "recover", 13)],
    ),
    "out of order": (
        [("k", 12, False), ("k", 5, True), ("k", 0, True)], {},
        [("k", 10, "alarm", 5), ("k", 12, "recover", 12)],
    ),
}


@pytest.mark.parametrize("case", CASES)
def test_delayed_alarms(spark, case):
    rows, options, want = CASES[case]
    assert delayed(spark, rows, **options) == want


def test_delayed_alarms_split_equals_whole(spark):
    rows = [("hot", (i * 7) % 613, i % 11 != 3) for i in range(400)]
    rows += [("cold", i * 3, i % 4 != 0) for i in range(12)]
    assert delayed(spark, rows, policy=SPLIT) == delayed(spark, rows)


def test_first_alarms(spark):
    df = timeline(spark, [("k", 0, True), ("k", 11, True), ("k", 25, False),
                          ("k", 30, True), ("k", 35, False), ("j", 20, True)])
    out = A.first_alarms(df, ["sn"], "v", F.lit(10), horizon=F.lit(40 * US))
    assert sorted(out.collect(), key=lambda r: r.sn) == [
        ("j", 20 * US, 30 * US, None), ("k", 0, 10 * US, 25 * US),
    ]
    split = A.first_alarms(df, ["sn"], "v", F.lit(10), horizon=F.lit(40 * US),
                           policy=SplitPolicy(target_rows=2))
    assert sorted(split.collect()) == sorted(out.collect())


def test_repeat_reminders(spark):
    df = timeline(spark, [("k", 0, True), ("k", 3, True), ("k", 10, False),
                          ("k", 12, False), ("k", 20, True)])
    out = A.repeat_reminders(df, ["sn"], "v", F.lit(5), horizon=F.lit(31 * US))
    # 10 is cancelled: the recovery at that time comes first.
    assert sorted(r.due_us // US for r in out.collect()) == [5, 25, 30]


def test_reminders_over_a_long_range(spark):
    df = timeline(spark, [("k", 0, True), ("k", 25_001, False)])
    out = A.repeat_reminders(df, ["sn"], "v", F.lit(1), horizon=A.end_of(df, "ts"))
    stats = out.agg(F.count("*"), F.countDistinct("due_us"), F.max("due_us")).first()
    assert tuple(stats) == (25_000, 25_000, 25_000 * US)


def status(spark, rows):
    return timeline(spark, rows).withColumnRenamed("v", "status")


def test_off_count_alarms(spark):
    df = status(spark, [("k", 0, "0"), ("k", 2, "0"), ("k", 4, "1"), ("k", 5, "0"),
                        ("k", 10, "0"), ("k", 11, "1"), ("k", 12, "0"), ("k", 13, "0")])
    found = {(r.emit_us // US, r.status) for r in Q.off_count_alarms(
        df, F.lit(10), F.lit(3)).collect()}
    # The third "off" of the window alarms once; 4 lies in the window; 11 does not.
    assert found == {(5, "0"), (11, "1")}
    literal = Q.off_count_alarms(df, F.lit(10), F.lit(3), literal=True)
    assert {(r.emit_us // US, r.status) for r in literal.collect()} == {(11, "1")}
    literal = Q.off_count_alarms(df, F.lit(10), F.lit(2), literal=True)
    assert {(r.emit_us // US, r.status) for r in literal.collect()} == {
        (2, "0"), (5, "0"), (10, "0"), (11, "1"), (13, "0")
    }


def test_disconnects_and_frequency(spark):
    rows = [("k", 0, "0"), ("k", 1, "1"), ("k", 2, "0"), ("k", 3, "0"), ("k", 4, "1"),
            ("k", 5, "1"), ("k", 6, "0"), ("k", 7, "1"), ("k", 8, "0"), ("k", 30, "1"),
            ("k", 31, "0")]
    df = status(spark, rows)
    pairs = Q.disconnects(df)
    assert sorted((r.online_ts.second, r.offline_ts.second) for r in pairs.collect()) == [
        (1, 2), (5, 6), (7, 8), (30, 31)
    ]
    out = Q.disconnect_frequency(pairs, F.lit(10), F.lit(1), horizon=F.lit(35 * US))
    # The window runs from the online time 1 to 11; the next one is still open.
    assert sorted((r.emit_us // US, r.status) for r in out.collect()) == [
        (6, "0"), (8, "0"), (11, "1")
    ]
    out = Q.disconnect_frequency(
        Q.disconnects(df, policy=SplitPolicy(target_rows=2)),
        F.lit(10), F.lit(1), horizon=F.lit(35 * US),
        policy=SplitPolicy(target_rows=1),
    )
    assert sorted((r.emit_us // US, r.status) for r in out.collect()) == [
        (6, "0"), (8, "0"), (11, "1")
    ]


def test_a_window_that_is_over_before_its_disconnect(spark):
    # Online since 0, off at 50: the window of 10 s ends before it is opened.
    df = status(spark, [("k", 0, "1"), ("k", 50, "0"), ("k", 51, "1"), ("k", 52, "0")])
    out = Q.disconnect_frequency(
        Q.disconnects(df), F.lit(10), F.lit(1), horizon=F.lit(100 * US)
    )
    assert sorted((r.emit_us // US, r.status) for r in out.collect()) == [
        (10, "1"), (61, "1")
    ]


def alarm_rows(spark, rows, interval, frequency, action="3"):
    data = [("p", "r", s * US, rec, n, action, interval, frequency)
            for n, (s, rec) in enumerate(rows)]
    return spark.createDataFrame(
        data, "point string, rule string, emit_us long, recover boolean, event_id long,"
        "action_type string, push_interval int, push_frequency int")


def pushes(spark, rows, interval, frequency, horizon, **kw):
    df = alarm_rows(spark, rows, interval, frequency, **kw)
    out = P.push_messages(df, ["point", "rule"], "event_id", F.lit(horizon * US))
    return sorted((r.push_us // US, r.event_id) for r in out.collect())


def test_push_messages(spark):
    rows = [(0, False), (7, False), (20, True), (25, False), (26, True), (40, False)]
    # Every 5 s with the latest alarm; 20 is cancelled by the recovery at 20.
    assert pushes(spark, rows, 5, 1, 46) == [(5, 0), (10, 1), (15, 1), (45, 5)]
    # An alarm at exactly a due time replaces the payload first.
    assert pushes(spark, [(0, False), (5, False)], 5, 1, 9) == [(5, 1)]
    # No interval: once per key ever, or never.
    assert pushes(spark, rows, None, 0, 46) == [(0, 0)]
    assert pushes(spark, rows, 0, 1, 46) == []
    assert pushes(spark, rows, 5, 1, 46, action="1") == []


TRIGGER_ROWS = [
    # value, condition, A, B, kind, zone, intended, literal
    (" 1 ", "0", None, None, 0, "", True, True),
    ("0", "0", None, None, 0, "", False, False),
    ("0", "1", None, None, 0, "", True, True),
    ("20.0", "2", "20", None, 0, "", True, False),
    ("0", "2", "20", None, 0, "", False, True),
    ("", "2", "0", None, 0, "", True, True),
    ("on", "2", " on ", None, 1, "", True, True),
    ("off", "2", "on", None, 1, "", False, False),
    ("31", "3", "30", None, 0, "0.5", True, True),
    ("30.5", "3", "30", None, 0, "0.5", False, False),
    ("31", "3", "30", None, None, None, True, True),
    ("31", "3", "30", None, 1, "", False, False),
    ("9", "4", None, "10", 0, "0.5", True, False),
    ("9.5", "4", None, "10", 0, "0.5", False, False),
    ("11", "4", None, "10", 0, "", False, True),
    ("5", "5", "1", "10", 0, "1", True, False),
    ("2", "5", "1", "10", 0, "1", False, False),
    ("12", "6", "1", "10", 0, "1", True, False),
    ("11", "6", "1", "10", 0, "1", False, False),
    ("-1", "6", "1", "10", 0, "1", True, False),
    ("n/a", "3", "30", None, 0, "", False, False),
    (None, "3", "30", None, 0, "", False, False),
    ("1", "9", "30", None, 0, "", False, False),
]


def test_trigger_truth_table(spark):
    df = spark.createDataFrame(
        [(n, *r) for n, r in enumerate(TRIGGER_ROWS)],
        "n int, val string, c string, a string, b string, k int, z string,"
        "want boolean, literal boolean",
    ).withColumn(
        "t",
        S.typed_trigger(F.struct(
            F.col("c").alias("triggerCondition"),
            F.col("a").alias("triggerConditionAval"),
            F.col("b").alias("triggerConditionBval"),
            F.col("k").alias("triggerConditionValType"),
            F.col("z").alias("alarmDeadZone"),
        )),
    )
    args = (F.col("text"), F.col("number"), F.col("t"))
    out = S.with_number(df).select(
        "n", "want", "literal", S.trigger_holds(*args).alias("got"),
        S.trigger_holds(*args, literal=True).alias("got_literal"),
    )
    wrong = [r for r in out.collect() if (r.got, r.got_literal) != (r.want, r.literal)]
    assert wrong == []


def test_rows_without_time_or_status(spark):
    df = status(spark, [("k", 0, "0"), ("k", 1, "0"), ("k", 20, None)])
    lost = df.limit(1).withColumns({"ts": F.lit(None).cast("timestamp"),
                                    "event_id": F.lit(99).cast("long")})
    out = Q.off_count_alarms(df.unionByName(lost), F.lit(10), F.lit(2)).collect()
    assert sorted((r.emit_us // US, r.status) for r in out) == [(1, "0"), (20, "1")]
