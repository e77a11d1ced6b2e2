"""Streaming jobs: from messages to alarms, notifications and commands."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from alarmloom.functions import scalars as S
from alarmloom.operators import control as K
from alarmloom.operators import rules as R
from alarmloom.operators.changes import TEMPLATE_POINT, UNIQUE_POINT
from alarmloom.streaming import processors as P
from alarmloom.streaming import tables

# Executors need not have the package installed to run the processors.
cloudpickle.register_pickle_by_value(P)


def _keyed(rows: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    timed = rows.withWatermark(ts, delay) if delay else rows
    return timed.withColumn("ts_us", F.unix_micros(F.col(ts)))


BUCKETS_OF_DELAY = 8


HEARTBEAT = "__heartbeat"


def with_heartbeat(
    source: DataFrame, ticks: DataFrame, idle: str, delay: str, ts: str = "ts"
) -> DataFrame:
    """A source whose watermark goes on while it is silent.

    ``ticks`` (a column named like ``ts``) tell the time; a tick says that no row older
    than ``idle`` before it is still to come from this source.  So of several sources
    none has to lead: each keeps its own watermark, the slowest counts, and a source that
    lags by less than ``idle`` loses nothing.  Use it on every source of a union; the
    ticks themselves go no further.
    """
    beats = ticks.select(
        (F.col(ts) - F.expr(f"INTERVAL {idle}")).alias(ts), F.lit(True).alias(HEARTBEAT)
    )
    both = source.withColumn(HEARTBEAT, F.lit(False)).unionByName(
        beats, allowMissingColumns=True
    )
    # reads the time, or it would be applied before the watermark has seen the ticks
    own = ~F.col(HEARTBEAT) | (F.col(ts) == F.timestamp_micros(F.lit(-(2**62))))
    return both.withWatermark(ts, delay).filter(own).drop(HEARTBEAT)


def _bucket_us(delay: str) -> int:
    """Width of the buckets in which rows wait: a part of the watermark delay."""
    ms = int(pd.Timedelta(delay).total_seconds() * 1000) // BUCKETS_OF_DELAY
    return 1000 * max(1, ms)


def _mode(event_time: bool) -> str:
    return "EventTime" if event_time else "ProcessingTime"


def _columns(rows: DataFrame, names: Sequence[str]) -> T.StructType:
    return T.StructType([rows.schema[n] for n in names])


def _schema(rows: DataFrame, keys: Sequence[str], extra: str, tie: str) -> T.StructType:
    fields = [rows.schema[k] for k in keys]
    parsed = T.StructType.fromDDL(extra).fields
    return T.StructType(fields + parsed + [rows.schema[tie]])


def hold_alarms(
    rows: DataFrame,
    keys: Sequence[str],
    *,
    ts: str = "ts",
    tie: str = "event_id",
    carry: Sequence[str] = (),
    delay: str = "1 second",
    recover_on_every_clear: bool = False,
    event_time: bool = True,
    bucket_delay: str = "",
    start: DataFrame | None = None,
) -> DataFrame:
    """Delayed alarms, recoveries and notifications of a stream.

    ``rows``: keys, ts, tie, ``holds``, ``delay``, ``push_interval``,
    ``push_once``.  ``carry`` names more columns of the alarm's row to put out.
    ``delay`` is the watermark delay; leave it empty for rows that have a watermark, and
    say in ``bucket_delay`` how late they may be.  ``start`` is what a batch over earlier
    rows has left behind (handover.hold_states); it counts in the job's first micro-batch.
    """
    told = [tie, *carry]
    keyed = _keyed(rows, keys, ts, delay).withColumn("about", F.to_json(F.struct(*told)))
    needed = ["ts_us", tie, "holds", "delay", "push_interval", "push_once", "about"]
    processor = P.HoldProcessor(
        _columns(keyed, needed), list(keys), recover_on_every_clear,
        tie=tie, event_time=event_time, bucket_us=_bucket_us(bucket_delay or delay),
    )
    out = T.StructType(
        [rows.schema[k] for k in keys]
        + T.StructType.fromDDL("kind string, emit_us bigint, about string").fields
    )
    emitted = keyed.groupBy(*keys).transformWithState(
        processor, out, "append", _mode(event_time),
        initialState=None if start is None else start.groupBy(*keys),
    )
    about = F.from_json("about", T.StructType([rows.schema[c] for c in told]))
    return emitted.select(*keys, "kind", "emit_us", about.alias("a")).select(
        *keys, "kind", "emit_us", "a.*"
    )


def offline_watch(
    status: DataFrame,
    delay: Column,
    reminder: Column | None = None,
    *,
    ts: str = "ts",
    tie: str = "event_id",
    watermark: str = "1 second",
    event_time: bool = True,
    bucket_delay: str = "",
    start: DataFrame | None = None,
) -> DataFrame:
    """Gateways off for longer than ``delay``, with reminders while they stay off."""
    return hold_alarms(
        offline_rows(status, delay, reminder, ts=ts, tie=tie), ["sn"], ts=ts, tie=tie,
        delay=watermark, recover_on_every_clear=True, event_time=event_time,
        bucket_delay=bucket_delay, start=start,
    )


def offline_rows(
    status: DataFrame, delay: Column, reminder: Column | None = None, *,
    ts: str = "ts", tie: str = "event_id",
) -> DataFrame:
    """What the alarm state needs of status rows."""
    return status.select(
        "sn", ts, tie,
        (F.col("status") == S.STATUS_OFF).alias("holds"),
        delay.cast("bigint").alias("delay"),
        (F.lit(None) if reminder is None else reminder).cast("bigint").alias(
            "push_interval"
        ),
        F.lit(False).alias("push_once"),
    )


def off_count_watch(
    status: DataFrame, width: Column, limit: Column, *, ts: str = "ts",
    tie: str = "event_id", watermark: str = "1 second", event_time: bool = True,
) -> DataFrame:
    """Gateways off too often within a window."""
    rows = _keyed(status, ["sn"], ts, watermark).withColumns(
        {"width": width.cast("bigint"), "limit": limit.cast("bigint")}
    )
    out = _schema(status, ["sn"], "status string, emit_us bigint", tie)
    return rows.groupBy("sn").transformWithState(
        P.OffCountProcessor(
            _columns(rows, ["ts_us", tie, "status", "width", "limit"]),
            tie=tie, event_time=event_time, bucket_us=_bucket_us(watermark),
        ),
        out, "append", _mode(event_time),
    )


def disconnect_watch(
    status: DataFrame, width: Column, limit: Column, *, ts: str = "ts",
    tie: str = "event_id", watermark: str = "1 second",
) -> DataFrame:
    """Disconnects and gateways that disconnect too often."""
    rows = _keyed(status, ["sn"], ts, watermark).withColumns(
        {"width": width.cast("bigint"), "limit": limit.cast("bigint")}
    )
    out = _schema(
        status, ["sn"], "kind string, online_us bigint, emit_us bigint", tie
    )
    return rows.groupBy("sn").transformWithState(
        P.DisconnectProcessor(
            _columns(rows, ["ts_us", tie, "status", "width", "limit"]),
            tie=tie, bucket_us=_bucket_us(watermark),
        ),
        out, "append", "EventTime",
    )


def disconnect_pairs(
    status: DataFrame, *, ts: str = "ts", tie: str = "event_id",
    watermark: str = "1 second",
) -> DataFrame:
    """Disconnects of a stream, as a step that others can follow.

    Output: sn, ``online_us``, ``offline_us``, tie and ``told``, a time that carries the
    watermark on (see processors.PairProcessor); the disconnect itself is at ``offline_us``.
    """
    rows = _keyed(status, ["sn"], ts, watermark)
    extra = "online_us bigint, offline_us bigint"
    out = _schema(status, ["sn"], extra, tie).add("told", T.TimestampType())
    return rows.groupBy("sn").transformWithState(
        P.PairProcessor(
            _columns(rows, ["ts_us", tie, "status"]), tie=tie,
            bucket_us=_bucket_us(watermark),
        ),
        out, "append", "EventTime", eventTimeColumnName="told",
    )


def frequency_watch(
    pairs: DataFrame, width: Column, limit: Column, *, tie: str = "event_id",
    watermark: str = "1 second",
) -> DataFrame:
    """Gateways that disconnect too often, from :func:`disconnect_pairs` in one query.

    ``watermark`` is that of the first step.  In order of ``offline_us``, whatever
    micro-batch a disconnect was told in.
    """
    rows = pairs.withColumns({"width": width.cast("bigint"), "limit": limit.cast("bigint")})
    out = _schema(pairs, ["sn"], "kind string, online_us bigint, emit_us bigint", tie)
    needed = ["offline_us", tie, "online_us", "width", "limit"]
    return rows.groupBy("sn").transformWithState(
        P.FrequencyProcessor(
            _columns(rows, needed), ts="offline_us", tie=tie,
            bucket_us=_bucket_us(watermark),
        ),
        out, "append", "EventTime",
    )


LATE_PARTS = 1024


def mark_late(
    windowed: DataFrame, *, ts: str = "ts", delay: str = "1 second",
    parts: int = LATE_PARTS,
) -> DataFrame:
    """Rows of windows (``end``) with ``late``: their window was closed when they came.

    The stream form of windows.drop_late, with the late rows kept and marked, so that a
    sink can route them.  A window is closed when the watermark, the latest time of the
    micro-batches before less ``delay``, has reached its end.  Rows are dealt over
    ``parts`` groups by a hash of all their columns; no key is ever hot.
    """
    known = windowed.withWatermark(ts, delay)
    # as expressions, the columns go on without the watermark that Spark drops rows by
    told = [
        (F.col(c) + F.expr("INTERVAL 0 SECOND")).alias(c) if c == ts else F.col(c)
        for c in windowed.columns
    ]
    spread = F.pmod(F.xxhash64(F.to_json(F.struct(*windowed.columns))), F.lit(parts))
    rows = known.select(
        *told, F.unix_micros("end").alias("until_us"), spread.alias("__part")
    )
    out = T.StructType(
        [T.StructField(f.name, f.dataType) for f in windowed.schema]
        + [T.StructField("late", T.BooleanType())]
    )
    return rows.groupBy("__part").transformWithState(
        P.LateProcessor(_columns(windowed, windowed.columns)), out, "append", "EventTime"
    )


def arrival_windows(rows: DataFrame, keys: Sequence[str], size: str) -> DataFrame:
    """Every row with ``start`` and ``end`` of the tumbling window it arrives in.

    A window is told when the wall clock has passed its end, also if no row comes after
    it.  The query needs a processing-time trigger.
    """
    processor = P.ArrivalWindowProcessor(
        _columns(rows, rows.columns), int(pd.Timedelta(size).total_seconds() * 1000)
    )
    out = T.StructType(
        [*rows.schema, *T.StructType.fromDDL("start_ms bigint, end_ms bigint")]
    )
    told = rows.groupBy(*keys).transformWithState(processor, out, "append", "ProcessingTime")
    return told.select(
        *rows.columns,
        F.timestamp_millis("start_ms").alias("start"),
        F.timestamp_millis("end_ms").alias("end"),
    )


def keys_in_alarm(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Keys that are in alarm in the state of a job (hold_alarms), as a table.

    Reads the last complete micro-batch from the job's checkpoint; the job may be running.
    """
    state = (
        spark.read.format("statestore")
        .option("path", checkpoint)
        .option("stateVarName", "record")
        .load()
    )
    return state.filter("value.alarmed").select("key.*")


def latest_per_key(
    rows: DataFrame,
    keys: Sequence[str],
    ts: str = "ts",
    tie: str = "event_id",
    ttl_ms: int | None = None,
    start: DataFrame | None = None,
) -> DataFrame:
    """The latest row of every key, whenever it changes, with its time in ``ts_us``.

    With ``ttl_ms`` a key is forgotten that long after its last row.  State that
    expires goes by the wall clock, so such a query keeps running batches and needs
    a processing-time trigger.  ``start`` holds the latest rows known before the stream
    begins (frequency.latest_per_key of earlier rows); they are not told again.
    """
    known = None if start is None else _keyed(start, keys, ts, "").drop(ts).groupBy(*keys)
    keyed = _keyed(rows, keys, ts, "").drop(ts)
    told = [c for c in keyed.columns if c not in keys]
    processor = P.LatestProcessor(
        list(keys), _columns(keyed, told), tie=tie, ttl_ms=ttl_ms
    )
    return keyed.groupBy(*keys).transformWithState(
        processor, _columns(keyed, [*keys, *told]), "update",
        "ProcessingTime" if ttl_ms else "None", initialState=known,
    )


def latest_by_name(
    rows: DataFrame, keys: Sequence[str], name: str, ts: str = "ts"
) -> DataFrame:
    """The latest time of every name within a key, whenever it changes."""
    keyed = _keyed(rows, keys, ts, "")
    out = T.StructType(
        [rows.schema[k] for k in keys]
        + [T.StructField("name", T.StringType()),
           T.StructField("latest_us", T.LongType())]
    )
    return keyed.groupBy(*keys).transformWithState(
        P.LatestByNameProcessor(list(keys), name), out, "update", "None"
    )


# -- changes beside data ---------------------------------------------------------


def _beside(
    data: DataFrame, changes: DataFrame, keys: Sequence[str], ts: str, tie: str,
    told: dict[str, Column], watermark: str,
) -> DataFrame:
    """Both streams as one, with one watermark: the later of the two leads.

    ``told`` are the columns of a change beside its keys, time and tie.
    """
    dropped = [f.name for f in changes.schema if f.name in told]
    log = changes.drop(*[c for c in dropped if c not in (*keys, ts, tie)]).select(
        *keys, ts, tie, F.lit(P.CHANGE).alias("side"),
        *[value.alias(name) for name, value in told.items()],
    )
    both = data.withColumn("side", F.lit(P.DATA)).unionByName(
        log, allowMissingColumns=True
    )
    return _keyed(both, keys, ts, watermark)


def as_of_watch(
    rows: DataFrame,
    changes: DataFrame,
    key: str,
    value: Column,
    name: str,
    *,
    ts: str = "ts",
    tie: str = "event_id",
    watermark: str = "1 second",
) -> DataFrame:
    """Streaming rows with the latest streaming change of their key at their time.

    The stream form of changes.as_of_changes.  Rows and changes meet in the state of
    their key, in the order of their times, so the result does not depend on which
    micro-batch either arrives in, as long as neither is later than the watermark delay
    behind the other.
    """
    boxed = {"__change": F.struct(value.alias("v"))}
    both = _beside(rows, changes, [key], ts, tie, boxed, watermark)
    both = both.withColumnRenamed("__change", "change")
    change = both.schema["change"].dataType
    told = _columns(rows, rows.columns)
    processor = P.AsOfProcessor(
        _columns(both, [*dict.fromkeys([*rows.columns, tie, "ts_us", "side", "change"])]),
        told, change, tie=tie, bucket_us=_bucket_us(watermark),
    )
    out = T.StructType([*told.fields, T.StructField("version", change)])
    seen = both.groupBy(key).transformWithState(processor, out, "append", "EventTime")
    return seen.select(*rows.columns, F.col("version")["v"].alias(name))


def mapped_points(
    points: DataFrame,
    changes: DataFrame,
    *,
    kind: str = UNIQUE_POINT,
    point: str = "unique_data_point_id",
    ts: str = "ts",
    tie: str = "event_id",
    watermark: str = "1 second",
) -> DataFrame:
    """Streaming data points with the rules of a streaming change log at their time.

    ``changes`` are parsed rule changes (type, id, action, rule_ids) with ts and tie;
    only those of ``kind`` count.  A row per point and rule; points without a rule go.
    The mapping lives in the state of the point, not in a table that is read once per
    micro-batch.
    """
    rules = F.filter(
        F.transform("rule_ids", lambda x: F.trim(x).try_cast("bigint")),
        lambda x: x.isNotNull(),
    )
    of_kind = changes.filter(F.col("type") == kind).select(
        F.col("id").cast(points.schema[point].dataType).alias(point), ts, tie,
        F.col("action").alias("__action"), rules.alias("__rules"),
    )
    told = {"action": F.col("__action"), "change": F.col("__rules")}
    both = _beside(points, of_kind, [point], ts, tie, told, watermark)
    columns = _columns(points, points.columns)
    processor = P.RuleMappingProcessor(
        _columns(both, [*dict.fromkeys([*points.columns, tie, "ts_us", "side", *told])]),
        columns, tie=tie, bucket_us=_bucket_us(watermark),
    )
    out = T.StructType([*columns.fields, T.StructField("rule_id", T.LongType())])
    return both.groupBy(point).transformWithState(processor, out, "append", "EventTime")


# -- the rule job --------------------------------------------------------------


def tag_stream(
    points: DataFrame, unique_watch: DataFrame, template_watch: DataFrame
) -> DataFrame:
    """Streaming data points with the rules that watch them, in one join each."""
    return R.tag_points(S.with_number(points), unique_watch, template_watch)


def hold_rows(tagged: DataFrame, ts: str, tie: str) -> DataFrame:
    """What the alarm state needs of tagged points."""
    wants_push = F.col("action_type") == "3"
    interval = F.col("action")["pushInterval"]
    return R.alarm_path(tagged).select(
        "unique_data_point_id", "rule_id", ts, tie, "sn", "datapoint_id",
        S.trigger_holds(F.col("text"), F.col("number"), F.col("trigger")).alias("holds"),
        F.col("delay").cast("bigint").alias("delay"),
        F.when(wants_push, interval).cast("bigint").alias("push_interval"),
        F.coalesce(
            wants_push
            & (F.coalesce(interval, F.lit(0)) <= 0)
            & (F.col("action")["pushFrequency"] == 0),
            F.lit(False),
        ).alias("push_once"),
    )


def rule_alarm_stream(
    tagged: DataFrame, *, ts: str = "ts", tie: str = "event_id",
    watermark: str = "1 second", event_time: bool = True,
) -> DataFrame:
    """Alarms, recoveries and notifications per (point, rule)."""
    return hold_alarms(
        hold_rows(tagged, ts, tie), ["unique_data_point_id", "rule_id"], ts=ts, tie=tie,
        carry=["sn", "datapoint_id"], delay=watermark, event_time=event_time,
    )


def write_alarms(
    stream: DataFrame, checkpoint: str, sinks: dict[str, Callable[[DataFrame, int], None]]
) -> DataStreamWriter:
    """Each kind of output to its own sink, all from one stateful query.

    A sink is called with the rows and the batch number.  A batch may be written
    again after a failure, so a sink should overwrite by batch number; see
    :func:`batch_folder`.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            for kind, sink in sinks.items():
                sink(batch.filter(F.col("kind") == kind), number)
        finally:
            batch.unpersist()

    return (
        stream.writeStream.foreachBatch(write)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )


def batch_once(folder: str) -> Callable[[DataFrame, int], None]:
    """A sink that another stream reads: a batch once written is not written again.

    The folder must be on storage that all executors share.
    """

    def write(rows: DataFrame, number: int) -> None:
        path = f"{folder}/batch={number}"
        if not _exists(rows.sparkSession, f"{path}/_SUCCESS"):
            rows.write.mode("overwrite").parquet(path)

    return write


def _exists(spark: SparkSession, name: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def batch_folder(folder: str) -> Callable[[DataFrame, int], None]:
    """A sink that keeps one folder per batch, so that a repeat overwrites it."""

    def write(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return write


def alarm_commands(
    alarms: DataFrame,
    details: DataFrame,
    alarm_controls: DataFrame,
    elements: DataFrame,
    point_relation: DataFrame,
    machine_relation: DataFrame,
) -> DataFrame:
    """Control commands of a batch of alarms and recoveries; for use in a sink.

    ``alarms`` carry an ``uuid`` beside what rule_alarm_stream puts out.
    """
    kinds = details.select("rule_id", "trigger_type")
    driven = K.alarm_driven_rows(alarms.join(kinds, "rule_id"), alarm_controls)
    rows = driven.join(details.select("rule_id", "trigger_json", "action"), "rule_id")
    return K.control_commands(
        K.match_elements(rows, elements), point_relation, machine_relation
    )


def maintain_table(
    changes: DataFrame,
    checkpoint: str,
    folder: str,
    apply: Callable[[DataFrame, DataFrame], DataFrame],
    keep_for_s: float = tables.DAY_S,
) -> DataStreamWriter:
    """A mapping table kept up to date from a change stream (see streaming.tables).

    Every micro-batch rewrites the buckets that its changes touch, starting from the
    version before it, so a repeated batch gives the same table.  Write the first version
    with tables.write_table.  Data streams read the version that is current when their
    own micro-batch starts, see :func:`tag_batches`; older ones stay for ``keep_for_s``,
    which must be longer than a micro-batch can last.
    """

    def update(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            tables.update_table(folder, batch, apply, number)
        finally:
            batch.unpersist()
        tables.expire(batch.sparkSession, folder, keep_for_s)

    return (
        changes.writeStream.foreachBatch(update)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )


# -- the whole rule job, with mappings that change under it ----------------------


def watch_lists(mapping: DataFrame, details: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two watch lists of a mapping (type, id, rule_id)."""

    def watching(kind: str, name: str) -> DataFrame:
        rows = mapping.filter(F.col("type") == kind)
        return R.watch_list(
            rows.select(F.col("id").cast("bigint").alias(name), "rule_id"), details
        )

    return (
        watching(UNIQUE_POINT, "unique_data_point_id"),
        watching(TEMPLATE_POINT, "datapoint_id"),
    )


def tag_batches(
    points: DataFrame,
    dimensions: Callable[[SparkSession], object],
    mapping: str,
    folder: str,
    checkpoint: str,
    *,
    ts: str = "ts",
    tie: str = "event_id",
) -> DataStreamWriter:
    """First half of the rule job: data points meet their rules.

    Every micro-batch reads the current version of the mapping (the folder that
    maintain_table keeps) and the rule tables anew (``dimensions`` gives them, with the
    attributes of monitor.Dimensions), so a rule that is added, changed or deleted
    counts from the next batch on.  ``folder`` gets the rows for the alarm state under
    ``tagged`` and the commands that need no alarm under ``direct``.

    A row without keys tells the alarm state how far time has gone in batches whose
    points no rule watches.
    """
    keep_tagged = batch_once(f"{folder}/tagged")
    keep_direct = batch_folder(f"{folder}/direct")

    def tag(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        version = tables.read_table(spark, mapping)
        if version is None:
            raise ValueError(f"no first version under {mapping}")
        dims = dimensions(spark)
        details = R.rule_details(dims.rules, dims.elements, dims.actions)
        batch.persist()
        try:
            tagged = tag_stream(batch, *watch_lists(version, details))
            rows = hold_rows(tagged, ts, tie)
            time = batch.agg(
                F.max(ts).alias(ts), F.lit(False).alias("holds"),
                F.lit(False).alias("push_once"), F.max(tie).alias(tie),
            ).filter(F.col(ts).isNotNull())
            keep_tagged(rows.unionByName(time, allowMissingColumns=True), number)
            uuid = S.row_id(F.col(tie), F.col("rule_id"), F.col("mapping"))
            direct = R.direct_controls(tagged).withColumn("uuid", uuid)
            keep_direct(
                K.control_commands(
                    K.match_elements(direct, dims.elements),
                    dims.point_relation, dims.machine_relation,
                ),
                number,
            )
        finally:
            batch.unpersist()

    return points.writeStream.foreachBatch(tag).option("checkpointLocation", checkpoint)


def alarm_batches(
    spark: SparkSession,
    dimensions: Callable[[SparkSession], object],
    folder: str,
    checkpoint: str,
    *,
    ts: str = "ts",
    tie: str = "event_id",
    watermark: str = "1 second",
    event_time: bool = True,
    include_recover: bool = True,
    max_files_per_trigger: int = 1000,
) -> DataStreamWriter:
    """Second half: alarms, recoveries, notifications and the commands they drive.

    Reads what tag_batches has written (start that first) and writes a folder per kind:
    ``alarm``, ``recover``, ``push`` (with message, push way and trigger of the rule)
    and ``commands``.  The rows of a trigger are bounded by ``max_files_per_trigger``.
    """
    source = f"{folder}/tagged"
    schema = spark.read.parquet(source).drop("batch").schema
    rows = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(source)
    )
    emitted = hold_alarms(
        rows, ["unique_data_point_id", "rule_id"], ts=ts, tie=tie,
        carry=["sn", "datapoint_id"], delay=watermark, event_time=event_time,
    )

    def complete(push: DataFrame, details: DataFrame) -> DataFrame:
        texts = details.select(
            "rule_id", F.col("alarm_msg").alias("msg"),
            F.col("action.pushWay").alias("push_way"), "trigger_json",
        )
        return push.join(texts, "rule_id")

    def commands(alarms: DataFrame, dims, details: DataFrame) -> DataFrame:
        mapping = R.controls_of_alarms(
            dims.rules.filter(F.col("rely_rule_id").isNotNull()),
            dims.rules.select(F.col("id").alias("alarm_id")),
        )
        uuid = S.row_id(F.col(tie), F.col("rule_id"))
        return alarm_commands(
            alarms.withColumn("uuid", uuid), details, mapping, dims.elements,
            dims.point_relation, dims.machine_relation,
        )

    def write(batch: DataFrame, number: int) -> None:
        dims = dimensions(batch.sparkSession)
        details = R.rule_details(dims.rules, dims.elements, dims.actions)
        batch.persist()
        details.persist()
        try:
            kinds = {k: batch.filter(F.col("kind") == k) for k in ("alarm", "recover")}
            for kind, found in kinds.items():
                batch_folder(f"{folder}/{kind}")(found, number)
            pushes = batch.filter(F.col("kind") == "push")
            batch_folder(f"{folder}/push")(complete(pushes, details), number)
            driving = kinds["alarm"]
            if include_recover:
                driving = driving.unionByName(kinds["recover"])
            batch_folder(f"{folder}/commands")(
                commands(driving, dims, details), number
            )
        finally:
            batch.unpersist()
            details.unpersist()

    return (
        emitted.writeStream.foreachBatch(write)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
