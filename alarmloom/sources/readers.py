"""Where telemetry, change messages and dimension tables come from.

Every message source gives a frame with a text column ``value``; the parsers in
``alarmloom.functions.parsing`` do the rest, so the jobs do not care whether the
messages come from Kafka or from files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from alarmloom.functions import parsing


@dataclass(frozen=True)
class Topics:
    """Topic names; give those of your deployment."""

    data_points: str = "data-points"
    rule_changes: str = "rule-changes"
    gateway_point_changes: str = "gateway-point-changes"
    gateway_machine_changes: str = "gateway-machine-changes"
    alarm_control_changes: str = "alarm-control-changes"
    prototype: str = "nested-points"

    @property
    def machine_mapper_changes(self) -> str:
        """The machine mapper reads the rule change topic."""
        return self.rule_changes


@dataclass(frozen=True)
class MessageSource:
    """Kafka topics, or one folder per topic when ``servers`` is not given.

    The Kafka form needs the Spark Kafka connector on the class path.
    """

    spark: SparkSession
    servers: str | None = None
    group: str | None = None
    folder: str | None = None
    streaming: bool = True
    starting_offsets: str = "latest"
    ending_offsets: str = "latest"
    max_offsets_per_trigger: int | None = None
    max_files_per_trigger: int | None = None

    def topic_options(self, topic: str) -> dict[str, str]:
        """Options of the topic source; offsets may be given as JSON per partition.

        ``max_offsets_per_trigger`` bounds the rows of a micro-batch, and so what one
        key can bring into one call of a state processor.  A bounded read covers
        everything up to ``ending_offsets`` unless ``starting_offsets`` says otherwise.
        """
        start = self.starting_offsets
        options = {
            "kafka.bootstrap.servers": str(self.servers),
            "subscribe": topic,
            "startingOffsets": start
            if self.streaming or start != "latest"
            else "earliest",
        }
        if self.group:
            options["kafka.group.id"] = self.group
        if self.streaming and self.max_offsets_per_trigger:
            options["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        if not self.streaming:
            options["endingOffsets"] = self.ending_offsets
        return options

    def read(self, topic: str) -> DataFrame:
        reader = self.spark.readStream if self.streaming else self.spark.read
        if self.servers:
            options = self.topic_options(topic)
            frame = reader.format("kafka").options(**options).load()
            return frame.selectExpr("cast(value as string) as value")
        if self.streaming and self.max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", self.max_files_per_trigger)
        return reader.text(f"{self.folder}/{topic}")

    def data_points(self, topics: Topics = Topics()) -> DataFrame:
        return parsing.parse_messages(self.read(topics.data_points))

    def prototype_points(self, topics: Topics = Topics()) -> DataFrame:
        return parsing.parse_nested_messages(self.read(topics.prototype))

    def rule_changes(self, topics: Topics = Topics()) -> DataFrame:
        return parsing.parse_rule_changes(self.read(topics.rule_changes))

    def machine_mapper_changes(self, topics: Topics = Topics()) -> DataFrame:
        return parsing.parse_rule_changes(self.read(topics.machine_mapper_changes))

    def gateway_point_changes(self, topics: Topics = Topics()) -> DataFrame:
        return parsing.parse_device_point_changes(
            self.read(topics.gateway_point_changes)
        )

    def gateway_machine_changes(self, topics: Topics = Topics()) -> DataFrame:
        return parsing.parse_device_machine_changes(
            self.read(topics.gateway_machine_changes)
        )

    def alarm_control_changes(self, topics: Topics = Topics()) -> DataFrame:
        return parsing.parse_alarm_control_changes(
            self.read(topics.alarm_control_changes)
        )

    def lines(self, topic: str) -> DataFrame:
        """Plain text lines, the form the early jobs read."""
        return self.read(topic)


DIMENSIONS = (
    "rule",
    "rule_monitor_element",
    "rule_action",
    "device_template_point_rel",
    "machine_device_rel",
)


def dimension(
    spark: SparkSession,
    name: str,
    *,
    folder: str | None = None,
    jdbc: dict[str, str] | None = None,
) -> DataFrame:
    """A dimension table from Parquet files or from a database over JDBC.

    For a large table give partitionColumn, lowerBound, upperBound and
    numPartitions among the JDBC options; the filters and columns a job uses are
    pushed into the database.
    """
    if name not in DIMENSIONS:
        raise ValueError(f"unknown dimension table: {name}")
    if jdbc:
        return spark.read.format("jdbc").options(**jdbc, dbtable=name).load()
    return spark.read.parquet(f"{folder}/{name}")
