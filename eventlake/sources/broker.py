"""Broker streams: options for Spark's readers, start positions, offline stand-ins."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.schemas import BROKER_SCHEMA

# Client settings of a broker with IAM authentication.
IAM_OPTIONS = {
    "kafka.security.protocol": "SASL_SSL",
    "kafka.sasl.mechanism": "AWS_MSK_IAM",
    "kafka.sasl.jaas.config": "software.amazon.msk.auth.iam.IAMLoginModule required;",
    "kafka.sasl.client.callback.handler.class":
        "software.amazon.msk.auth.iam.IAMClientCallbackHandler",
}

# Rows per micro-batch of the order and click jobs.
ORDERS_PER_TRIGGER = 50_000
CLICKS_PER_TRIGGER = 100_000
# Rows per micro-batch of the other jobs; they bound what one key brings at once.
TXNS_PER_TRIGGER = 100_000
ARCHIVE_PER_TRIGGER = 500_000


@dataclass(frozen=True)
class BrokerSource:
    """A topic subscription. Exactly one of ``topics`` and ``topic_pattern`` is set."""

    bootstrap_servers: str
    topics: tuple[str, ...] = ()
    topic_pattern: str | None = None
    starting_offsets: str | dict = "latest"
    starting_timestamp_ms: int | None = None
    max_offsets_per_trigger: int | None = None
    iam: bool = True
    consumer_group: str | None = None
    fail_on_data_loss: bool = True
    extra: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        if bool(self.topics) == bool(self.topic_pattern):
            raise ValueError("give either topics or topic_pattern")
        start = self.starting_offsets
        out = {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "startingOffsets": json.dumps(start) if isinstance(start, dict) else start,
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
        }
        if self.topics:
            out["subscribe"] = ",".join(self.topics)
        else:
            out["subscribePattern"] = self.topic_pattern
        if self.starting_timestamp_ms is not None:
            out["startingTimestamp"] = str(self.starting_timestamp_ms)
        if self.max_offsets_per_trigger:
            out["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        if self.iam:
            out.update(IAM_OPTIONS)
        if self.consumer_group:
            out["kafka.group.id"] = self.consumer_group
        return {**out, **self.extra}

    def read_stream(self, spark: SparkSession) -> DataFrame:
        return spark.readStream.format("kafka").options(**self.options()).load()

    def read_batch(self, spark: SparkSession) -> DataFrame:
        """The same topics as a table, for backfills (a batch reader starts at earliest)."""
        options = self.options()
        for name in ("maxOffsetsPerTrigger", "kafka.group.id"):
            options.pop(name, None)
        if options["startingOffsets"] == "latest":
            options["startingOffsets"] = "earliest"
        return spark.read.format("kafka").options(**options).load()


def file_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None, schema=BROKER_SCHEMA,
    consume: bool = False,
) -> DataFrame:
    """Broker-shaped (or other) parquet files as a stream.

    With ``consume`` the files of a micro-batch are removed once it is committed; one query only may read them.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if consume:
        reader = reader.option("cleanSource", "delete")
    return reader.parquet(path)


def from_position(
    rows: DataFrame, position: str = "earliest",
    offsets: dict[str, dict[int, int]] | None = None, timestamp: Column | None = None,
) -> DataFrame:
    """Rows of a stored topic from a start position on.

    ``TRIM_HORIZON``/``earliest`` keeps all, ``LATEST``/``latest`` none of the
    stored rows, ``AT_TIMESTAMP`` those from ``timestamp`` on. ``offsets`` gives
    the first offset per topic and partition (-2 earliest, -1 latest); partitions
    it does not name start at the earliest.
    """
    if offsets is not None:
        start = F.lit(None).cast("long")
        for topic, parts in offsets.items():
            for number, first in parts.items():
                here = (F.col("topic") == topic) & (F.col("partition") == int(number))
                start = F.when(here, F.lit(first).cast("long")).otherwise(start)
        return rows.where(
            start.isNull() | (start == -2) | ((start >= 0) & (F.col("offset") >= start))
        )
    if position.upper() in ("EARLIEST", "TRIM_HORIZON"):
        return rows
    if position.upper() == "LATEST":
        return rows.where(F.lit(False))
    if position.upper() == "AT_TIMESTAMP":
        if timestamp is None:
            raise ValueError("AT_TIMESTAMP requires a timestamp")
        return rows.where(F.col("timestamp") >= timestamp)
    raise ValueError(f"Unknown start position: {position}")


def matching_topics(rows: DataFrame, pattern: str = r"^cdc\..*") -> DataFrame:
    """Rows of all topics whose name matches ``pattern``."""
    return rows.where(F.col("topic").rlike(pattern))


def stored_positions(rows: DataFrame) -> DataFrame:
    """First and next offset per topic and partition of stored broker rows."""
    return rows.groupBy("topic", "partition").agg(
        F.min("offset").alias("first_offset"), (F.max("offset") + 1).alias("end_offset")
    )
