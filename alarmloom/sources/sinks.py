"""Where alarms, notifications and commands go."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def as_json(df: DataFrame) -> DataFrame:
    """Rows as one JSON text column ``value``, the form a topic takes."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def to_console(df: DataFrame, checkpoint: str | None = None) -> DataStreamWriter:
    writer = df.writeStream.format("console").outputMode("append")
    return writer.option("checkpointLocation", checkpoint) if checkpoint else writer


def to_files(df: DataFrame, folder: str, checkpoint: str) -> DataStreamWriter:
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
    )


def to_topic(
    df: DataFrame, servers: str, topic: str, checkpoint: str
) -> DataStreamWriter:
    return (
        as_json(df)
        .writeStream.format("kafka")
        .outputMode("append")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
