"""What a batch over the past leaves behind for the streaming job that goes on from it.

The past are the rows before a cut, the stream has the rest.  The batch operators give
the alarms of the past (with a horizon just before the cut); the states here are those in
which the streaming operators would have been at the cut.  So both results together are
those of one batch, or one stream, over everything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alarmloom.operators.alarms import SECOND, micros, seconds
from alarmloom.operators.hotkeys import DEFAULT_POLICY, SplitPolicy
from alarmloom.operators.timeline import OPEN, RESET, Timeline, last_seen


def hold_states(
    rows: DataFrame,
    keys: Sequence[str],
    cut: Column,
    *,
    ts: str = "ts",
    tie: str = "event_id",
    carry: Sequence[str] = (),
    policy: SplitPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """The state of jobs.hold_alarms at ``cut`` (microseconds), for its ``start``.

    ``rows`` are what hold_alarms takes, ``carry`` what it carries; rows from the cut on
    are left out.  One row per key that has a state: keys and the fields of
    processors.HoldProcessor.  What has happened since a key's last false row decides, so
    runs are reduced first, within the shuffle of the labels, and then the last is taken.
    """
    true = F.coalesce(F.col("holds"), F.lit(False))
    at = F.struct(ts, tie)
    past = rows.filter(micros(ts) < cut).withColumn(
        "about", F.to_json(F.struct(tie, *carry))
    )
    labelled = (
        Timeline(past, keys, ts, tie, policy)
        .scanned(__run=last_seen(F.when(~true, at)))
        .windows(
            kind=F.when(true, OPEN).otherwise(RESET),
            due=micros(ts) + seconds(F.col("delay")),
        )
    )
    every = F.when(F.col("push_interval") > 0, F.col("push_interval") * SECOND)
    fired = true & F.coalesce(F.col("w_next") > F.col("w_due"), F.col("w_due") < cut)
    pushing = fired & every.isNotNull()
    once = F.coalesce(F.col("push_once"), F.lit(False))
    runs = labelled.groupBy(*keys, "__run").agg(
        F.max_by(
            F.struct("w_due", "about", every.alias("every"), once.alias("once")),
            F.when(true, at),
        ).alias("last"),
        F.max(fired).alias("alarmed"),
        F.min_by(
            F.struct(F.col("w_due").alias("at"), every.alias("every")),
            F.when(pushing, F.col("w_due")),
        ).alias("first"),
        F.max_by("about", F.when(pushing, F.col("w_due"))).alias("push_kept"),
        F.max(fired & every.isNull() & once).alias("pushed"),
    )
    now = F.struct("last", "alarmed", "first", "push_kept")
    # a run without a false row before it is the key's first one
    began = F.struct(F.col("__run").isNotNull(), F.col("__run"))
    latest = runs.groupBy(*keys).agg(
        F.max_by(now, began).alias("s"), F.max("pushed").alias("pushed")
    )
    latest = latest.withColumns({
        "__cut": cut,
        "__every": F.col("s.first.every"),
        "__first": F.col("s.first.at") + F.col("s.first.every"),
    })
    missed = F.expr("greatest(__cut - __first + __every - 1, 0L) div __every")
    waits, yes = F.col("s.last.w_due") >= F.col("__cut"), F.lit(True)
    states = latest.select(
        *keys,
        F.when(waits, F.col("s.last.w_due")).alias("due"),
        F.when(waits, F.col("s.last.about")).alias("kept"),
        F.when(F.col("s.alarmed"), yes).alias("alarmed"),
        (F.col("__first") + missed * F.col("__every")).alias("push_due"),
        F.col("s.push_kept").alias("push_kept"),
        F.col("__every").alias("push_every"),
        F.when(F.col("pushed"), yes).alias("pushed"),
        F.col("s.last.every").alias("every"),
        F.when(F.col("s.last.once"), yes).alias("once"),
    )
    return states.dropna("all", subset=[c for c in states.columns if c not in keys])
