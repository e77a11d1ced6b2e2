"""Tumbling windows, watermarks and late rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WINDOWS_AT_ONCE = 10_000


def tumbling(df: DataFrame, ts: str, size: str) -> DataFrame:
    """Every row with ``start`` and ``end`` of its window; nothing is aggregated.

    Over event time or, given a column of arrival times, processing time.
    """
    w = F.window(F.col(ts), size)
    return (
        df.withColumn("__w", w)
        .withColumns({"start": F.col("__w.start"), "end": F.col("__w.end")})
        .drop("__w")
    )


def window_label(df: DataFrame) -> DataFrame:
    """The window of a row as text, in epoch milliseconds."""
    # The words of the text
    text = F.concat(
        F.lit("-----start:--"),
        F.unix_millis("start").cast("string"),
        F.lit("----end:--"),
        F.unix_millis("end").cast("string"),
    )
    return df.withColumn("window", text)


def json_event_time(lines: DataFrame, value: str = "value") -> DataFrame:
    """JSON rows with the event time (column ``ts``) of their ``time`` field."""
    millis = F.get_json_object(F.col(value), "$.time").try_cast("bigint")
    return lines.withColumn("ts", F.timestamp_millis(millis))


def drop_late(
    windowed: DataFrame, ts: str, arrival: str, tie: str, delay_ms: int
) -> DataFrame:
    """Windowed rows that arrive before the watermark passes their window.

    A row is late if some row before it in arrival order has an event time at or after
    the end of the row's window plus the delay.  The first such arrival is aggregated
    per window, before any shuffle, and carried back over the windows: over buckets of
    WINDOWS_AT_ONCE windows' time first, then within each bucket, from the arrival that
    the later buckets give; rows meet it in a join by their window.  Neither rows nor
    windows are ever put into one order, only buckets are.
    """
    end, start = F.unix_micros("end"), F.unix_micros("start")
    size, at = end - start, F.struct(F.col(arrival), F.col(tie))
    # the last window end that a row's event time closes
    ahead = F.unix_micros(F.col(ts)) - delay_ms * 1000 - start
    closes = F.floor(ahead / size) * size + start
    bucket = F.floor(F.col("__end") / (F.col("__size") * WINDOWS_AT_ONCE))
    # one pass: the window that a row closes, and its own without an arrival
    met_by_row = F.array(
        F.struct(closes.alias("__end"), size.alias("__size"), at.alias("__at")),
        F.struct(end.alias("__end"), size.alias("__size"), F.lit(None).alias("__at")),
    )
    windows = (
        windowed.select(F.inline(met_by_row))
        .groupBy(bucket.alias("__bucket"), "__end")
        .agg(F.min("__at").alias("__at"))
    )
    later = Window.orderBy(F.desc("__bucket")).rowsBetween(Window.unboundedPreceding, -1)
    beyond = (
        windows.groupBy("__bucket")
        .agg(F.min("__at").alias("__at"))
        .select("__bucket", F.min("__at").over(later).alias("__beyond"))
    )
    within = Window.partitionBy("__bucket").orderBy(F.desc("__end"))
    own = windows.select("__bucket", "__end", F.min("__at").over(within).alias("__own"))
    first = own.join(beyond, "__bucket").select(
        "__end", F.least("__own", "__beyond").alias("__closed")
    )
    met = windowed.withColumn("__end", end).join(first, "__end", "left")
    in_time = F.col("__closed").isNull() | (at <= F.col("__closed"))
    return met.filter(in_time).select(*windowed.columns)
