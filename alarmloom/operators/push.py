"""Notifications for alarms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alarmloom.operators.alarms import expand_range, seconds
from alarmloom.operators.hotkeys import DEFAULT_POLICY, SplitPolicy
from alarmloom.operators.timeline import Timeline, last_seen, nxt, prev, running_max

PUSH_ACTION = "3"
ONCE = 0


def needs_push(alarms: DataFrame) -> DataFrame:
    return alarms.filter(F.col("action_type") == PUSH_ACTION)


def push_messages(
    alarms: DataFrame,
    keys: Sequence[str],
    tie: str,
    horizon: Column,
    policy: SplitPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """All notifications of an alarm frame, from one pass over it.

    ``alarms`` holds keys, ``emit_us``, ``recover``, ``action_type``,
    ``push_interval`` (seconds) and ``push_frequency``.

    Rules with an interval notify every interval after the first alarm of an episode,
    with the latest alarm at the due time.  The due times that fall between an alarm
    row and the row after it belong to that alarm row, so they come from the row itself
    and nothing is joined by time.  Rules without one and with frequency "once" notify
    of the first alarm of a key, at once.
    """
    repeats = F.coalesce(F.col("push_interval") > 0, F.lit(False))
    rows = needs_push(alarms).withColumns(
        {"__at": F.timestamp_micros("emit_us"), "__repeats": repeats}
    )
    single = ~F.col("__repeats") & (F.col("push_frequency") == ONCE) & ~F.col("recover")
    starts = ~F.col("recover") & F.coalesce(F.col("__was"), F.lit(True))
    line = (
        Timeline(rows, [*keys, "__repeats"], "__at", tie, policy)
        .scanned(
            __was=prev(F.col("recover")),
            __next=nxt(F.col("emit_us")),
            __single=running_max(F.when(single, 1)),
        )
        .scanned(
            __start=last_seen(F.when(starts, F.col("emit_us"))),
            __before=prev(F.col("__single")),
        )
        .rows()
        .filter(F.when(F.col("__repeats"), ~F.col("recover")).otherwise(
            single & F.col("__before").isNull()
        ))
        .withColumns(
            {"__i": seconds(F.col("push_interval")), "__horizon": horizon}
        )
    )
    # Due times in [emit, next): a row at exactly a due time comes before it.
    lo = F.expr("if(__repeats, greatest(1, (emit_us - __start + __i - 1) div __i), 0)")
    hi = F.expr("if(__repeats, (coalesce(__next - 1, __horizon) - __start) div __i, 0)")
    due = F.col("__start") + F.col("__k") * F.col("__i")
    return expand_range(line, lo, hi, "__k").select(
        *alarms.columns,
        F.when(F.col("__repeats"), due).otherwise(F.col("emit_us")).alias("push_us"),
    )
