from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.functions import envelope as env
from eventlake.functions.tokens import field_text, idempotency_token, index_name
from eventlake.schemas import envelope_schema, order_schema, stream_event_schema

ROW = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
])


def broker(spark, values):
    rows = [
        ("cdc.public.orders", i % 3, i, None if v is None else v.encode(), datetime(2026, 4, 22, 10))
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(
        rows, "topic string, partition int, offset long, value binary, timestamp timestamp"
    )


def message(op="c", lsn=100, amount=100.0, **extra):
    return json.dumps({
        "op": op, "ts_ms": 1234567890000,
        "source": {"db": "analytics", "schema": "public", "table": "orders", "lsn": lsn},
        "before": None, "after": {"order_id": "O-1", "customer_id": "C-1", "amount": amount},
        **extra,
    })


def test_schema_fields():
    assert [f.name for f in envelope_schema(ROW).fields] == [
        "op", "ts_ms", "source", "before", "after"]
    assert order_schema(decimal_amounts=True)["total_amount"].dataType == T.DecimalType(12, 2)
    assert "cdc_after" in stream_event_schema(ROW).fieldNames()


def test_insert(spark):
    rows = env.decode_changes(broker(spark, [message()]), ROW).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.cdc_op, row.source_table, row.event_id) == ("c", "orders", "100")
    assert row.after.order_id == "O-1" and row.before is None
    assert row.event_time == datetime(2009, 2, 13, 23, 31, 30)


def test_tombstones_go_and_broken_messages_stay(spark):
    rows = env.decode_changes(broker(spark, [None, "{oops", message()]), ROW)
    assert [r.cdc_op for r in rows.orderBy("raw_offset").collect()] == [None, "c"]


def test_reject_reasons(spark):
    values = [
        message(), None, '{"op": "invalid json"}', "{oops", message(op="x"), message(amount="much"),
        message(op="t"),
    ]
    rows = env.decode_or_reject(broker(spark, values), ROW).orderBy("raw_offset")
    assert [r.reject_reason for r in rows.collect()] == [
        None, "tombstone", "unknown_op", "malformed", "unknown_op", "malformed", None]
    assert env.good_changes(rows).count() == 2
    dead = env.dead_letters(rows).collect()
    assert len(dead) == 4 and all(d.raw_value for d in dead)


def test_event_id_falls_back_to_the_offset(spark):
    row = env.decode_changes(broker(spark, [message(lsn=None)]), ROW).first()
    assert row.event_id == "cdc.public.orders:0:0"


def test_message_is_parsed_once(spark):
    rows = env.upserts(env.decode_changes(broker(spark, [message()]), ROW))
    rows = rows.where(F.col("event_time").isNotNull())
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(StructField(op") == 1


def test_plain_json_drops_rows_without_time(spark):
    schema = T.StructType([
        T.StructField("user_id", T.StringType()), T.StructField("event_time", T.TimestampType())])
    values = ['{"user_id":"u1","event_time":"2026-01-01T00:00:00Z"}', '{"user_id":"u2"}', "no"]
    assert [r.user_id for r in env.decode_json(broker(spark, values), schema).collect()] == ["u1"]


def test_other_decoders_can_be_given(spark):
    upper = lambda value, schema: F.from_json(
        F.unbase64(value.cast("string")).cast("string"), schema)
    import base64

    coded = base64.b64encode(message().encode()).decode()
    assert env.decode_changes(broker(spark, [coded]), ROW, upper).first().cdc_op == "c"


@pytest.mark.parametrize("event,seen,exact,whole", [
    ("2026-01-01 00:00:00.900", "2026-01-01 00:00:01.400", 500, 1000),
    ("2026-01-01 00:00:00.100", "2026-01-01 00:00:00.600", 500, 0),
    ("2026-01-01 00:00:01.0005", "2026-01-01 00:00:01.000", 0, 0),
])
def test_lag(spark, event, seen, exact, whole):
    at, to = F.lit(event).cast("timestamp"), F.lit(seen).cast("timestamp")
    row = spark.range(1).select(env.lag_ms(at, to), env.lag_ms(at, to, True)).first()
    assert tuple(row) == (exact, whole)


def test_is_cdc(spark):
    df = spark.createDataFrame([("cdc_debezium",), ("kafka",)], "s string")
    assert [r[0] for r in df.select(env.is_cdc(F.col("s"))).collect()] == [True, False]


def test_tokens(spark):
    df = spark.createDataFrame(
        [(5, "e", "t", 0, 1), (0, "e", "t", 0, 1), (None, "", "t", 0, 1), (None, None, None, None, 1)],
        "lsn long, event_id string, raw_topic string, raw_partition int, raw_offset long",
    )
    assert [r[0] for r in df.select(idempotency_token(df)).collect()] == [
        "lsn:5", "eid:e", "koffset:t:0:1", "koffset:?:?:1"]
    bare = spark.createDataFrame([(1,)], "x int")
    assert bare.select(idempotency_token(bare)).first()[0] == "koffset:?:?:?"


def test_index_names(spark):
    df = spark.createDataFrame([(datetime(2026, 4, 2),), (None,)], "ts timestamp")
    names = df.select(
        index_name("orders-{yyyy_mm_dd}", F.col("ts")), index_name("{yyyy_mm}-{yyyy}", F.col("ts")))
    assert [tuple(r) for r in names.collect()] == [
        ("orders-2026.04.02", "2026.04-2026"), ("orders-1970.01.01", "1970.01-1970")]


def test_field_text_of_numbers(spark):
    values = [100.0, 0.5, 12345678.9, 1e16, 1.5e-7, 0.0005, 123456789012.25, None, 1e300, -2.5e17]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(field_text(df, "v")).collect()]
    assert got == [None if v is None else str(v) for v in values]


def test_field_text_of_other_types(spark):
    df = spark.createDataFrame([(True, 3, datetime(2026, 1, 2, 3, 4, 5, 678000))],
                               "b boolean, n long, t timestamp")
    row = df.select(*[field_text(df, c) for c in df.columns]).first()
    assert tuple(row) == ("True", "3", "2026-01-02T03:04:05.678Z")
