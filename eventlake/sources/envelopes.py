"""Writing change envelopes and JSON messages as broker rows (stand-in for capture)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.envelope import parsed_once


def envelope(
    op: Column, ts_ms: Column, lsn: Column, before: Column, after: Column,
    db: str = "analytics", schema: str = "public", table: Column | str = "orders",
) -> Column:
    """Change envelope as JSON text."""
    table = F.lit(table) if isinstance(table, str) else table
    source = F.struct(
        F.lit(db).alias("db"), F.lit(schema).alias("schema"), table.alias("table"),
        lsn.alias("lsn"), ts_ms.alias("ts_ms"),
    )
    return F.to_json(F.struct(
        op.alias("op"), ts_ms.alias("ts_ms"), source.alias("source"),
        before.alias("before"), after.alias("after"),
    ))


def broker_rows(
    df: DataFrame, key: Column, value: Column, topic: Column, partition: Column,
    offset: Column, timestamp: Column,
) -> DataFrame:
    """Broker-shaped rows; a message is built once.

    It is built in a projection below the generator, as a generator's own
    expressions are interpreted: no code is compiled for them, and parts that
    several of them share are computed again.
    """
    return df.withColumn("__value", value.cast("binary")).select(
        key.cast("string").cast("binary").alias("key"),
        parsed_once(F.col("__value")).alias("value"),
        topic.alias("topic"), partition.cast("int").alias("partition"),
        offset.cast("long").alias("offset"), timestamp.alias("timestamp"),
    )
