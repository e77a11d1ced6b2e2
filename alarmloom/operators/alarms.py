"""Alarms that must hold for a while, and reminders while they last.

The batch forms here give the rows that the streaming forms in
``alarmloom.streaming`` give over the same input.  A row at exactly a due time is
processed before the timer.  A run that is still open at the end of the input
fires the timers due up to ``horizon`` (the last event time unless given).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alarmloom.functions import scalars as S
from alarmloom.operators.hotkeys import CHUNK, DEFAULT_POLICY, SplitPolicy
from alarmloom.operators.timeline import OPEN, RESET, Timeline, nxt, prev

SECOND = 1_000_000
REMINDERS_PER_BLOCK = 10_000


def micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts))


def chunk_of(df: DataFrame) -> list[str]:
    """The chunk column, to be carried on where there is one."""
    return [CHUNK] if CHUNK in df.columns else []


def seconds(duration: Column) -> Column:
    """A duration in whole seconds as microseconds."""
    return duration.cast("bigint") * SECOND


def end_of(df: DataFrame, ts: str) -> Column:
    """Last event time of a frame in microseconds, as a scalar subquery."""
    return df.select(F.max(micros(ts))).scalar()


def delayed_alarms(
    df: DataFrame,
    keys: Sequence[str],
    holds: str,
    delay: Column,
    *,
    ts: str = "ts",
    tie: str = "event_id",
    horizon: Column | None = None,
    recover_on_every_clear: bool = False,
    policy: SplitPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Alarm when a condition holds for ``delay`` seconds; recover when it ends.

    The first true row starts a timer, later true rows only replace the row the
    alarm will carry.  When the timer is due the alarm is emitted, and the next
    true row starts another timer, so a lasting condition alarms again and again.
    The first false row after an alarm emits one recovery; a false row before the
    timer is due cancels it.  With ``recover_on_every_clear`` each false row emits
    a recovery.

    Output: the alarm's row (the latest true row) or the clearing row, with
    ``emit_us`` (due time or time of the clearing row), ``recover`` and
    ``storage``.
    """
    horizon = end_of(df, ts) if horizon is None else horizon
    true = F.coalesce(F.col(holds), F.lit(False))
    labelled = Timeline(df, keys, ts, tie, policy).windows(
        kind=F.when(true, OPEN).otherwise(RESET),
        due=micros(ts) + seconds(delay),
    )
    # Only the last true row of a window sees its follower after the due time.
    fires = true & F.coalesce(F.col("w_next") > F.col("w_due"), F.col("w_due") <= horizon)
    clears = ~true
    if not recover_on_every_clear:
        clears = clears & F.coalesce(F.col("w_first") < micros(ts), F.lit(False))
    return labelled.filter(fires | clears).select(
        *df.columns,
        F.when(true, F.col("w_due")).otherwise(micros(ts)).alias("emit_us"),
        (~true).alias("recover"),
        F.lit(True).alias("storage"),
    )


def first_alarms(
    df: DataFrame,
    keys: Sequence[str],
    holds: str,
    delay: Column,
    *,
    ts: str = "ts",
    tie: str = "event_id",
    horizon: Column | None = None,
    policy: SplitPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Only the first alarm of every run of true rows, with its recovery time.

    Needs no sequential labelling: window functions over one shuffle.  Output:
    keys, ``run_start_us``, ``due_us``, ``recover_us`` (null while open).
    """
    horizon = end_of(df, ts) if horizon is None else horizon
    true = F.coalesce(F.col(holds), F.lit(False))
    edges = (
        Timeline(df, keys, ts, tie, policy)
        .scanned(__was=prev(true))
        .filter(true != F.coalesce(F.col("__was"), F.lit(False)))
        .scanned(recover_us=nxt(micros(ts)))
        .rows()
        .filter(true)
    )
    due = micros(ts) + seconds(delay)
    return edges.filter(
        F.coalesce(F.col("recover_us") > due, due <= horizon)
    ).select(
        *keys, micros(ts).alias("run_start_us"), due.alias("due_us"), "recover_us"
    )


def offline_alarms(
    status: DataFrame,
    delay: Column,
    *,
    key: str = "sn",
    ts: str = "ts",
    tie: str = "event_id",
    horizon: Column | None = None,
    policy: SplitPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Gateways off for longer than ``delay`` seconds; every "on" row recovers."""
    off = status.withColumn("__off", F.col("status") == S.STATUS_OFF)
    out = delayed_alarms(
        off, [key], "__off", delay, ts=ts, tie=tie, horizon=horizon,
        recover_on_every_clear=True, policy=policy,
    )
    return out.select(
        key,
        F.lit(S.OFFLINE_RULE_ID).alias("rule_id"),
        F.when(F.col("recover"), S.OFFLINE_RECOVERY_TEXT)
        .otherwise(S.OFFLINE_ALARM_TEXT).alias("msg"),
        "emit_us",
        F.when(F.col("recover"), S.RECOVERED).otherwise(S.ALARM).alias("status"),
        tie,
        *chunk_of(status),
    )


def expand_range(df: DataFrame, lo: Column, hi: Column, name: str) -> DataFrame:
    """One row per whole number from lo to hi; rows with hi < lo vanish.

    Exploded in two steps, so that no array holds a whole long range.
    """
    step = REMINDERS_PER_BLOCK
    blocks = (
        df.withColumns({"__lo": lo.cast("long"), "__hi": hi.cast("long")})
        .filter(F.col("__lo") <= F.col("__hi"))
        .withColumn("__b", F.explode(F.sequence("__lo", "__hi", F.lit(step))))
    )
    last = F.least(F.col("__b") + (step - 1), F.col("__hi"))
    return blocks.withColumn(name, F.explode(F.sequence(F.col("__b"), last))).drop(
        "__lo", "__hi", "__b"
    )


def repeat_reminders(
    alarms: DataFrame,
    keys: Sequence[str],
    in_alarm: str,
    interval: Column,
    *,
    horizon: Column,
    ts: str = "ts",
    tie: str = "event_id",
    policy: SplitPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """A reminder every ``interval`` seconds from an alarm until it recovers.

    The interval is the one of the row that starts the episode.  ``horizon`` is the end
    of the rows that the alarms come from.  Output: keys, ``start_us``, ``n`` (1, 2,
    ...), ``due_us``.
    """
    on = F.coalesce(F.col(in_alarm), F.lit(False))
    episodes = (
        Timeline(alarms, keys, ts, tie, policy)
        .scanned(__was=prev(on))
        .filter(on != F.coalesce(F.col("__was"), F.lit(False)))
        .scanned(__end=nxt(micros(ts)))
        .rows()
        .filter(on)
        .select(
            *keys,
            micros(ts).alias("start_us"),
            "__end",
            seconds(interval).alias("__i"),
            horizon.alias("__horizon"),
        )
    )
    # A recovery at exactly a due time comes first and cancels that reminder.
    count = F.expr("(coalesce(__end - 1, __horizon) - start_us) div __i")
    return expand_range(episodes, F.lit(1), count, "n").select(
        *keys,
        "start_us",
        "n",
        (F.col("start_us") + F.col("n") * F.col("__i")).alias("due_us"),
    )


def once_reminders(alarms: DataFrame, status: str = "status") -> DataFrame:
    """One reminder per alarm row, at once."""
    return alarms.filter(F.col(status) == S.ALARM)

