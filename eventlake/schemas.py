"""Declared row shapes. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

# Change operations of the envelope.
OP_CREATE, OP_UPDATE, OP_DELETE, OP_SNAPSHOT, OP_TRUNCATE = "c", "u", "d", "r", "t"
ALL_OPS = ("c", "u", "d", "r", "t")
UPSERT_OPS = ("c", "u", "r")

# Kinds of event source.
SOURCE_TYPES = ("kafka", "kinesis", "cdc_debezium")

BROKER_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])


def order_schema(decimal_amounts: bool = False) -> T.StructType:
    """Order payload; amounts as double, or as NUMERIC(12,2) like the source table."""
    amount = T.DecimalType(12, 2) if decimal_amounts else T.DoubleType()
    return T.StructType([
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("qty", T.LongType()),
        T.StructField("total_amount", amount),
        T.StructField("currency", T.StringType()),
        T.StructField("order_ts", T.TimestampType()),
    ])


ORDER_SCHEMA = order_schema()

CLICK_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("page_url", T.StringType()),
    T.StructField("referrer", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("page_load_ms", T.IntegerType()),
])

TXN_SCHEMA = T.StructType([
    T.StructField("txn_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("merchant", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
])


def envelope_schema(
    row_schema: T.StructType, images: tuple[str, ...] = ("before", "after")
) -> T.StructType:
    """Change envelope {op, ts_ms, source, before, after} around ``row_schema``, with the named images."""
    source = T.StructType([
        T.StructField("db", T.StringType()),
        T.StructField("schema", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("lsn", T.LongType()),
        T.StructField("ts_ms", T.LongType()),
    ])
    return T.StructType([
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("source", source),
        *[T.StructField(image, row_schema) for image in images],
    ])


def stream_event_schema(row_schema: T.StructType) -> T.StructType:
    """Canonical event row: any source, with change images where there are any."""
    text_map = T.MapType(T.StringType(), T.StringType())
    return T.StructType([
        T.StructField("event_id", T.StringType()),
        T.StructField("source_type", T.StringType()),
        T.StructField("source_topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("ingestion_time", T.TimestampType()),
        T.StructField("key", T.StringType()),
        T.StructField("payload", text_map),
        T.StructField("headers", text_map),
        T.StructField("cdc_op", T.StringType()),
        T.StructField("cdc_before", row_schema),
        T.StructField("cdc_after", row_schema),
    ])
