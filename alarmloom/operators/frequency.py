"""How often a gateway goes off within a window anchored at the first time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alarmloom.functions import scalars as S
from alarmloom.operators.alarms import chunk_of, micros, seconds
from alarmloom.operators.hotkeys import DEFAULT_POLICY, SplitPolicy
from alarmloom.operators.timeline import OPEN, PASS, Timeline, prev


def off_count_alarms(
    status: DataFrame,
    window: Column,
    limit: Column,
    *,
    key: str = "sn",
    ts: str = "ts",
    tie: str = "event_id",
    literal: bool = False,
    policy: SplitPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Alarm when a gateway is reported off ``limit`` times within ``window`` s.

    The first "off" row outside any window opens one; further "off" rows count
    up, and the one that reaches the limit alarms, once per window (the row that
    opens a window never alarms).  An "on" row outside any window recovers.

    ``literal`` keeps the slip of the studied job: the count is never stored, so
    each further "off" row counts as the second.
    """
    off = F.coalesce(F.col("status") == S.STATUS_OFF, F.lit(False))
    rows = Timeline(status, [key], ts, tie, policy).windows(
        kind=F.when(off, OPEN).otherwise(PASS),
        due=micros(ts) + seconds(window),
    )
    if literal:
        reached = (F.col("w_pos") >= 2) & (limit <= 2)
    else:
        reached = F.col("w_pos") == F.greatest(limit, F.lit(2))
    alarm = off & reached
    clear = ~off & F.col("w_due").isNull()
    return rows.filter(alarm | clear).select(
        key,
        F.lit(S.OFF_COUNT_RULE_ID).alias("rule_id"),
        F.when(off, S.OFFLINE_ALARM_TEXT)
        .otherwise(S.OFF_COUNT_RECOVERY_TEXT).alias("msg"),
        micros(ts).alias("emit_us"),
        F.when(off, S.ALARM).otherwise(S.RECOVERED).alias("status"),
        F.col(tie),
    )


def disconnects(
    status: DataFrame,
    *,
    key: str = "sn",
    ts: str = "ts",
    tie: str = "event_id",
    policy: SplitPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """An "on" row directly followed by an "off" row of the same gateway."""
    before = F.struct(F.col("status"), F.col(ts))
    rows = Timeline(status, [key], ts, tie, policy).scan(__before=prev(before))
    return rows.filter(
        (F.col("__before")["status"] == S.STATUS_ON)
        & (F.col("status") == S.STATUS_OFF)
    ).select(
        key,
        F.col("__before")[ts].alias("online_ts"),
        F.col(ts).alias("offline_ts"),
        tie,
        *chunk_of(status),
    )


def disconnect_frequency(
    events: DataFrame,
    window: Column,
    limit: Column,
    *,
    key: str = "sn",
    tie: str = "event_id",
    horizon: Column,
    policy: SplitPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Alarm when a gateway disconnects more than ``limit`` times in a window.

    ``events`` are rows of :func:`disconnects`.  A window starts at the *online*
    time of its first disconnect and lasts ``window`` seconds.  Every disconnect
    after the first ``limit`` in it alarms; its end always recovers, up to ``horizon``
    (the end of the status rows, which the disconnects do not tell).
    """
    rows = Timeline(events, [key], "offline_ts", tie, policy).windows(
        kind=F.lit(OPEN),
        due=micros("online_ts") + seconds(window),
    )
    alarm = F.col("w_pos") > limit
    closes = F.coalesce(F.col("w_next") > F.col("w_due"), F.col("w_due") <= horizon)
    outcomes = F.array(
        F.when(
            alarm,
            F.struct(
                micros("offline_ts").alias("emit_us"),
                F.lit(S.DISCONNECT_ALARM_TEXT).alias("msg"),
                F.lit(S.ALARM).alias("status"),
            ),
        ),
        F.when(
            closes,
            F.struct(
                F.col("w_due").alias("emit_us"),
                F.lit(S.DISCONNECT_RECOVERY_TEXT).alias("msg"),
                F.lit(S.RECOVERED).alias("status"),
            ),
        ),
    )
    emitted = rows.select(key, tie, F.explode(outcomes).alias("o"))
    return emitted.filter(F.col("o").isNotNull()).select(
        key,
        F.lit(S.DISCONNECT_RULE_ID).alias("rule_id"),
        "o.msg",
        "o.emit_us",
        "o.status",
        tie,
    )


def latest_per_key(
    df: DataFrame, keys: Sequence[str], ts: str, tie: str
) -> DataFrame:
    """The latest row of every key; aggregated before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    latest = F.max_by(F.struct(*rest), F.struct(ts, tie)).alias("__l")
    return df.groupBy(*keys).agg(latest).select(*keys, "__l.*")
