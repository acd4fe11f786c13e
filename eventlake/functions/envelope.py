"""Decoding of broker messages: change envelopes and plain JSON."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.schemas import ALL_OPS, UPSERT_OPS, envelope_schema

Decoder = Callable[[Column, T.StructType], Column]

_CORRUPT = "_corrupt_record"


def json_decoder(value: Column, schema: T.StructType) -> Column:
    """Message bytes as JSON. Pass another decoder (Avro, say) where topics need one."""
    return F.from_json(value.cast("string"), schema)


def event_id(lsn: Column, topic: Column, partition: Column, offset: Column) -> Column:
    """Source log position as text, else ``topic:partition:offset``."""
    fallback = F.concat_ws(":", topic, partition.cast("string"), offset.cast("string"))
    return F.coalesce(lsn.cast("string"), fallback)


def _flat(
    decoded: DataFrame, *extra: Column, images: tuple[str, ...] = ("before", "after")
) -> DataFrame:
    return decoded.select(
        event_id(
            F.col("env.source.lsn"), F.col("raw_topic"),
            F.col("raw_partition"), F.col("raw_offset"),
        ).alias("event_id"),
        F.timestamp_millis("env.ts_ms").alias("event_time"),
        F.col("env.op").alias("cdc_op"),
        F.col("env.source.db").alias("source_db"),
        F.col("env.source.schema").alias("source_schema"),
        F.col("env.source.table").alias("source_table"),
        F.col("env.source.lsn").alias("source_lsn"),
        *[F.col(f"env.{image}").alias(image) for image in images],
        "raw_offset", "raw_partition", "raw_topic", "kafka_ts",
        *extra,
    )


def parsed_once(parsed: Column) -> Column:
    """A parsed message that is parsed once.

    As a plain column its text would be parsed again in every filter that the
    optimizer moves below the projection; filters stay above a generator.
    """
    return F.explode(F.array(parsed))


def _broker_columns(rows: DataFrame, env: Column, *extra: Column) -> DataFrame:
    return rows.select(
        F.col("topic").alias("raw_topic"),
        F.col("partition").alias("raw_partition"),
        F.col("offset").alias("raw_offset"),
        F.col("timestamp").alias("kafka_ts"),
        parsed_once(env).alias("env"),
        *extra,
    )


def decode_changes(
    rows: DataFrame, row_schema: T.StructType, decoder: Decoder = json_decoder,
    images: tuple[str, ...] = ("before", "after"),
) -> DataFrame:
    """Flat change rows from broker rows; messages without a value are dropped.

    Only the row ``images`` named are parsed; for figures about the changes
    themselves none are needed.

    Works on batch and streaming input. A message that is not valid JSON stays
    as a row of nulls, since permissive decoding yields an empty struct; use
    ``decode_or_reject`` to set such messages aside.
    """
    decoded = _broker_columns(rows, decoder(F.col("value"), envelope_schema(row_schema, images)))
    return _flat(decoded.where(F.col("env").isNotNull()), images=images)


def _judged(rows: DataFrame, row_schema: T.StructType) -> tuple[DataFrame, Column]:
    """Parsed messages with their raw text, and why one is no change (null when it is)."""
    schema = T.StructType([
        *envelope_schema(row_schema).fields, T.StructField(_CORRUPT, T.StringType()),
    ])
    text = F.col("value").cast("string")
    env = F.from_json(text, schema, {"columnNameOfCorruptRecord": _CORRUPT})
    # Only a missing value gives a null struct; any text gives a struct.
    reason = (
        F.when(F.col("env").isNull(), "tombstone")
        .when(F.col(f"env.{_CORRUPT}").isNotNull(), "malformed")
        .when(~F.coalesce(F.col("env.op").isin(*ALL_OPS), F.lit(False)), "unknown_op")
    )
    return _broker_columns(rows, env, text.alias("raw_value")), reason


def decode_or_reject(rows: DataFrame, row_schema: T.StructType) -> DataFrame:
    """Flat change rows plus ``reject_reason`` (null when good) and the raw text.

    One pass over the input: the same frame feeds the good path and the
    dead-letter path.
    """
    decoded, reason = _judged(rows, row_schema)
    return _flat(decoded, F.col("raw_value"), reason.alias("reject_reason"))


def decode_good(rows: DataFrame, row_schema: T.StructType) -> DataFrame:
    """Flat change rows of the messages that are changes; what is left out, ``dead_letters`` has."""
    return good_changes(decode_or_reject(rows, row_schema))


def good_changes(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reject_reason").isNull()).drop("reject_reason", "raw_value")


def dead_letters(decoded: DataFrame, ignore_tombstones: bool = True) -> DataFrame:
    """Rejected messages with their error context, ready for a dead-letter table."""
    bad = F.col("reject_reason").isNotNull()
    if ignore_tombstones:
        bad = bad & (F.col("reject_reason") != "tombstone")
    return decoded.where(bad).select(
        "raw_topic", "raw_partition", "raw_offset", "kafka_ts", "reject_reason", "raw_value"
    )


def changelog(
    rows: DataFrame, row_schema: T.StructType, watermark: str = "10 seconds",
) -> DataFrame:
    """Changes as a table of rows: payload columns, ``op``, source time, event time.

    The event time is the commit time at the source database (the envelope's own
    time where that is missing) and carries the watermark. A delete shows the row
    it removed. Messages that are no changes are left to ``dead_letters``.
    """
    decoded, reason = _judged(rows, row_schema)
    gone = F.col("env.after").isNull()
    image = [
        F.when(gone, F.col(f"env.before.{f.name}")).otherwise(F.col(f"env.after.{f.name}"))
        .alias(f.name)
        for f in row_schema.fields
    ]
    ms = F.col("env.source.ts_ms")
    flat = decoded.where(reason.isNull()).select(
        *image, F.col("env.op").alias("op"), ms.alias("source_ts_ms"),
        F.timestamp_millis(F.coalesce(ms, F.col("env.ts_ms"))).alias("event_time"),
        F.col("env.source.lsn").alias("source_lsn"),
        "raw_topic", "raw_partition", "raw_offset",
    )
    return flat.withWatermark("event_time", watermark)


def as_stream_events(changes: DataFrame, ingestion_time: Column) -> DataFrame:
    """Decoded changes in the canonical event shape of all sources."""
    key = F.concat_ws(":", "raw_topic", F.col("raw_partition").cast("string"))
    return changes.select(
        "event_id", F.lit("cdc_debezium").alias("source_type"),
        F.col("raw_topic").alias("source_topic"), F.col("raw_partition").alias("partition"),
        F.col("raw_offset").alias("offset"), "event_time",
        ingestion_time.alias("ingestion_time"), key.alias("key"),
        F.create_map(F.lit("table"), F.col("source_table")).alias("payload"),
        F.create_map().cast("map<string,string>").alias("headers"),
        "cdc_op", F.col("before").alias("cdc_before"), F.col("after").alias("cdc_after"),
    )


def upserts(changes: DataFrame) -> DataFrame:
    """Only creates, updates and snapshot reads."""
    return changes.where(F.col("cdc_op").isin(*UPSERT_OPS))


def flatten_after(changes: DataFrame, row_schema: T.StructType, *keep: str) -> DataFrame:
    """Fields of the new row image as top-level columns, after the ``keep`` columns."""
    return changes.select(
        *keep, *[F.col(f"after.{f.name}").alias(f.name) for f in row_schema.fields]
    )


def decode_json(
    rows: DataFrame,
    schema: T.StructType,
    time_col: str = "event_time",
    decoder: Decoder = json_decoder,
) -> DataFrame:
    """Payload columns of plain JSON messages; rows without an event time are dropped."""
    return (
        rows.select(parsed_once(decoder(F.col("value"), schema)).alias("m"))
        .select("m.*")
        .where(F.col(time_col).isNotNull())
    )


def topic_parts(topic: Column) -> tuple[Column, Column, Column]:
    """(prefix, schema, table) of a change topic ``<prefix>.<schema>.<table>``."""
    parts = F.split(topic, r"\.")
    return F.get(parts, 0), F.get(parts, 1), F.get(parts, 2)


def is_cdc(source_type: Column) -> Column:
    return source_type == "cdc_debezium"


def lag_ms(event_time: Column, ingestion_time: Column, whole_seconds: bool = False) -> Column:
    """Ingestion minus event time in ms; ``whole_seconds`` truncates both sides first."""
    if whole_seconds:
        return (ingestion_time.cast("long") - event_time.cast("long")) * 1000
    # The microsecond difference is truncated towards zero, like an int conversion.
    diff = F.unix_micros(ingestion_time) - F.unix_micros(event_time)
    return (diff / 1000).cast("long")
