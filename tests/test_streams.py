"""Streaming runs over split files: equal to batch, exact once, late rows set aside."""

from __future__ import annotations

import glob
import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventlake.operators import dedup, joins, windows
from eventlake.operators.metrics import completeness
from eventlake.plans import activity, operations, orders
from eventlake.schemas import BROKER_SCHEMA, TXN_SCHEMA
from eventlake.sinks.base import Sink
from eventlake.sinks.broadcast import BroadcastSink
from eventlake.sinks.columnar import ColumnarSink, newest_version
from eventlake.sinks.lake import LakeSink
from eventlake.sources.broker import file_stream
from eventlake.streaming import progress, runs
from test_sinks import folder_client, stored

T0 = datetime(2026, 1, 1)


def write_files(spark, path, batches, schema):
    """One file per batch, in arrival order (the source reads the oldest file first)."""
    for i, rows in enumerate(batches):
        one = spark.createDataFrame(rows, schema).coalesce(1)
        one.write.mode("append").parquet(path)
        newest = max(glob.glob(f"{path}/*.parquet"), key=os.path.getmtime)
        os.utime(newest, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))


def txn(i, user, minutes, amount=1.0):
    return (str(i), user, float(amount), "m", T0 + timedelta(minutes=minutes))


def txn_stream(spark, path, batches):
    write_files(spark, path, batches, TXN_SCHEMA)
    return file_stream(spark, path, 1, TXN_SCHEMA)


def messages(spark, path, values, topic="cdc.public.orders", batches=1):
    rows = [
        (None, None if v is None else v.encode(), topic, i % 3, i, T0 + timedelta(seconds=i))
        for i, v in enumerate(values)]
    size = -(-len(rows) // batches)
    write_files(spark, path, [rows[k:k + size] for k in range(0, len(rows), size)], BROKER_SCHEMA)
    return file_stream(spark, path, 1)


def order_message(i, op="c", product="p1", day=1):
    ts = int((T0 + timedelta(days=day - 1, minutes=i) - datetime(1970, 1, 1)).total_seconds() * 1000)
    row = {"order_id": f"o{i}", "customer_id": "c", "product_id": product, "qty": 2,
           "total_amount": 10.0, "currency": "EUR", "order_ts": f"2026-01-{day:02d}T00:00:00Z"}
    image = {"before": row, "after": None} if op == "d" else {"before": None, "after": row}
    return json.dumps({"op": op, "ts_ms": ts, "source": {"table": "orders", "lsn": i + 1}, **image})


@pytest.fixture
def products(spark):
    return spark.createDataFrame(
        [("p1", "lamp", "home", "b", 3.0)],
        "product_id string, product_name string, category string, brand string, unit_cost double")


def test_tumbling_stream_equals_batch_on_closed_windows(spark, shared):
    batches = [[txn(f"{b}-{i}", f"u{i % 3}", b * 60 + i) for i in range(50)] for b in range(4)]
    stream = txn_stream(spark, f"{shared}/in", batches)
    spec = [("*", "count", "n"), ("amount", "sum", "s")]
    args = ("event_time", "5 minutes", ["user_id"], spec)
    got = runs.drain(windows.tumbling_window(stream, *args), f"{shared}/out", f"{shared}/cp")
    assert got.select("batch_id").distinct().count() > 1
    batch = windows.tumbling_window(spark.read.schema(TXN_SCHEMA).parquet(f"{shared}/in"), *args)
    closed = batch.where(F.col("window_end") <= F.lit(T0 + timedelta(minutes=229 - 10)))
    got = got.drop("batch_id")
    assert got.exceptAll(closed).count() == 0 and closed.exceptAll(got).count() == 0


def test_interval_join_streams(spark, shared):
    left = txn_stream(spark, f"{shared}/l", [[txn(1, "u", 60), txn(2, "u", 200)], [txn(3, "u", 260)]])
    right = txn_stream(spark, f"{shared}/r", [[txn(8, "u", 0), txn(9, "u", 199)], [txn(7, "u", 261)]])
    inner = joins.interval_join(left, right, "user_id", "event_time", "event_time")
    got = runs.drain(inner.select("txn_id", "r_txn_id"), f"{shared}/out", f"{shared}/cp")
    assert sorted((r.txn_id, r.r_txn_id) for r in got.collect()) == [("1", "8"), ("2", "9")]


def test_left_interval_join_stream_emits_unmatched(spark, shared):
    far = txn("flush", "x", 10_000)
    left = txn_stream(spark, f"{shared}/l", [[txn(1, "u", 60), txn(2, "u", 200)], [far], [far]])
    right = txn_stream(spark, f"{shared}/r", [[txn(8, "u", 0)], [far], [far]])
    outer = joins.interval_join(left, right, "user_id", "event_time", "event_time", how="left")
    got = runs.drain(outer.select("txn_id", "r_txn_id"), f"{shared}/out", f"{shared}/cp")
    pairs = {(r.txn_id, r.r_txn_id) for r in got.collect() if r.txn_id != "flush"}
    assert pairs == {("1", "8"), ("2", None)}


def audited(spark, shared, stream, *args):
    for query in activity.run_dedup_audit(
            stream, f"{shared}/kept", f"{shared}/audit", f"{shared}/cp", *args, trigger=None):
        query.awaitTermination()
    schema = stream.schema.add("batch_id", "long")
    return [spark.read.schema(schema).parquet(f"{shared}/{n}") for n in ("kept", "audit/on_time", "audit/late")]


def test_dedup_and_late_rows(spark, shared):
    stream = txn_stream(spark, f"{shared}/in", [
        [txn("a", "1", 0), txn("a", "2", 30), txn("b", "3", 0), txn("z", "0", 1)],
        [txn("a", "4", 59), txn("b", "5", 600)],
        # The latest time is 600 minutes: one hour behind it is the limit.
        [txn("a", "6", 539), txn("c", "7", 540), txn("a", "8", 570), txn("b", "9", 660), txn("a", "10", -90_000)],
    ])
    kept, on_time, late = audited(spark, shared, stream)
    assert sorted(r.user_id for r in kept.collect()) == ["0", "1", "3", "5", "7", "8", "9"]
    # Rows a long way behind are in the audit as well.
    assert sorted((r.txn_id, r.user_id) for r in late.collect()) == [("a", "10"), ("a", "6")]
    assert on_time.count() + late.count() == 11
    assert kept.schema["event_time"].dataType == TXN_SCHEMA["event_time"].dataType


def test_dedup_stream_equals_batch(spark, shared):
    rows = [txn(f"k{i % 7}", str(i), i * 11) for i in range(400)]
    stream = txn_stream(spark, f"{shared}/in", [rows[:150], rows[150:290], rows[290:]])
    kept, _, late = audited(spark, shared, stream, "3 hours", "24 hours")
    batch = dedup.first_per_window(spark.createDataFrame(rows, TXN_SCHEMA), "txn_id", "event_time", "3 hours")
    kept = kept.drop("batch_id")
    assert late.count() == 0
    assert kept.exceptAll(batch).count() == 0 and batch.exceptAll(kept).count() == 0


def test_built_in_dedup(spark, shared):
    stream = txn_stream(spark, f"{shared}/in", [[txn("a", "1", 0), txn("b", "2", 1)], [txn("a", "3", 5)]])
    rows = dedup.dedup_within_watermark(stream, ["txn_id"], "event_time")
    got = runs.drain(rows, f"{shared}/out", f"{shared}/cp")
    assert sorted(r.txn_id for r in got.collect()) == ["a", "b"]


def test_lost_commit_is_replayed_without_doubling(spark, shared):
    rows = [txn(str(i), "u", i) for i in range(90)]
    stream = txn_stream(spark, f"{shared}/in", [rows[:30], rows[30:60], rows[60:]])
    out, cp = f"{shared}/out", f"{shared}/cp"
    runs.drain(stream, out, cp)
    before = {p: os.path.getmtime(p) for p in glob.glob(f"{out}/**/*.parquet", recursive=True)}
    last = max(glob.glob(f"{cp}/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    os.replace(last, f"{shared}/lost-commit")
    crc = f"{cp}/commits/.{os.path.basename(last)}.crc"
    if os.path.exists(crc):
        os.replace(crc, f"{shared}/lost-crc")
    again = runs.drain(stream, out, cp)
    after = {p: os.path.getmtime(p) for p in glob.glob(f"{out}/**/*.parquet", recursive=True)}
    assert before != after
    assert tuple(completeness(again, "txn_id").first()) == (90, 90, 0, 0)


class Collect(Sink):
    """Stores batches and fails once."""

    def __init__(self, path, fail_at=None):
        super().__init__("collect")
        self.path, self.fail_at = path, fail_at

    def write(self, batch, batch_id):
        runs.batch_table(self.path)(batch, batch_id)
        if batch_id == self.fail_at:
            return 0, batch.count()
        return batch.count(), 0


def test_breach_stops_the_stream_and_a_restart_goes_on(spark, shared):
    rows = [txn(str(i), "u", i) for i in range(40)]
    stream = txn_stream(spark, f"{shared}/in", [rows[:20], rows[20:]])
    bad = runs.start_query(stream, Collect(f"{shared}/out", 1).foreach_batch(), f"{shared}/cp")
    with pytest.raises(Exception, match="100.00%"):
        bad.awaitTermination()
    runs.start_query(stream, Collect(f"{shared}/out").foreach_batch(), f"{shared}/cp").awaitTermination()
    assert tuple(completeness(spark.read.parquet(f"{shared}/out"), "txn_id").first()) == (40, 40, 0, 0)


def test_progress_and_dropped_rows(spark, shared):
    batches = [[txn(1, "u", 0)], [txn(2, "u", 600)], [txn(3, "u", 601)], [txn(4, "u", 1)]]
    stream = txn_stream(spark, f"{shared}/in", batches)
    listener = progress.ProgressListener()
    spark.streams.addListener(listener)
    counts = windows.tumbling_window(stream, "event_time", "5 minutes", ["user_id"], {"*": "count"})
    try:
        query = runs.start_query(counts, runs.batch_table(f"{shared}/out"), f"{shared}/cp", name="drops")
        query.awaitTermination()
        reports = [json.loads(p.json) for p in query.recentProgress]
        table = progress.progress_table(spark, "drops", reports)
        assert progress.dropped_rows(table).first().dropped == 1
        assert table.agg(F.sum("records_in")).first()[0] == 4
        for _ in range(100):
            if len(listener.rows) >= len(reports):
                break
            import time

            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    listener.flush(spark, f"{shared}/metrics")
    stored_rows = spark.read.parquet(f"{shared}/metrics")
    assert stored_rows.where("job = 'drops'").agg(F.sum("records_in")).first()[0] == 4
    metrics = progress.batch_metrics(stored_rows.where("job = 'drops'"))
    assert {r.metric for r in metrics.collect()} == {
        "RecordsIn", "RecordsOut", "BatchDurationMs", "LagMs", "BatchId"}


def test_committed_offsets_give_the_lag(spark, tmp_path):
    from eventlake.operators.metrics import consumer_lag

    for folder, files in {
        "offsets": {"4": '{"t":{"0":10}}', "5": '{"t":{"0":20,"1":7},"u":{"0":1}}', "6": '{"t":{"0":99}}'},
        "commits": {"4": '{"nextBatchWatermarkMs":0}', "5": '{"nextBatchWatermarkMs":0}'},
    }.items():
        os.makedirs(tmp_path / folder)
        for number, body in files.items():
            (tmp_path / folder / number).write_text(f"v1\n{{\"batchWatermarkMs\":0}}\n{body}")
    done = progress.committed_offsets(spark, str(tmp_path))
    assert sorted(tuple(r) for r in done.collect()) == [("t", 0, 20), ("t", 1, 7), ("u", 0, 1)]
    ends = spark.createDataFrame([("t", 0, 0, 25), ("t", 1, 0, 7), ("t", 2, 3, 5)],
                                 "topic string, partition int, first_offset long, end_offset long")
    lags = consumer_lag(ends, done)
    assert {r.partition: r.lag for r in lags.collect()} == {0: 5, 1: 0, 2: 2}


def test_progress_row_lag():
    row = progress.progress_row("j", {
        "batchId": 3, "timestamp": "2026-01-01T00:00:10.000Z", "numInputRows": 5, "batchDuration": 500,
        "eventTime": {"max": "2026-01-01T00:00:04.000Z"}, "sink": {"numOutputRows": 5}})
    assert row[:7] == ("j", 3, "2026-01-01T00:00:10.000Z", 5, 5, 500, 6_500)


def test_enrichment_with_one_query_per_sink(spark, shared, tmp_path, products):
    values = [order_message(i, "d" if i % 5 == 0 else "c", "p1" if i % 2 else "p2", 1 + i % 3) for i in range(30)]
    raw = messages(spark, f"{shared}/in", [*values, None, "junk"], batches=2)
    hot, search = str(tmp_path / "hot"), str(tmp_path / "search")
    sinks = orders.order_sinks(folder_client(hot), folder_client(search), f"{shared}/lake", f"{shared}/metrics")
    queries = orders.run_enrichment(raw, products, sinks, f"{shared}/cp", None)
    assert len(queries) == 3
    for query in queries:
        query.awaitTermination()
    cold = spark.read.parquet(f"{shared}/lake")
    assert cold.count() == 24 and cold.select("event_date").distinct().count() == 3
    assert {(r.product_id, r.margin_amount) for r in cold.collect()} == {("p1", 4.0), ("p2", None)}
    assert len({r["key"] for r in stored(hot)}) == 24 and len(stored(search)) == 24
    totals = spark.read.parquet(f"{shared}/metrics").groupBy("sink_name").agg(F.sum("records_written").alias("n"))
    assert {r.sink_name: r.n for r in totals.collect()} == {
        "orders-hot": 24, "orders-search": 24, "orders-cold": 24}


def test_versioned_enrichment(spark, shared, tmp_path):
    versions = spark.createDataFrame(
        [("p1", "lamp", "home", 3.0, T0), ("p1", "lamp", "home", 4.0, T0 + timedelta(minutes=5))],
        "product_id string, product_name string, category string, unit_cost double, _updated_at timestamp")
    raw = messages(spark, f"{shared}/in", [order_message(i) for i in range(10)])
    orders.run_versioned(raw, versions, folder_client(str(tmp_path / "s")), f"{shared}/lake",
                         f"{shared}/cp", None).awaitTermination()
    costs = spark.read.parquet(f"{shared}/lake").groupBy("unit_cost").count()
    assert {r.unit_cost: r["count"] for r in costs.collect()} == {3.0: 5, 4.0: 5}


def test_dimension_is_read_anew_for_every_batch(spark, shared, products):
    raw = messages(spark, f"{shared}/in", [order_message(i) for i in range(4)], batches=2)
    reads = []

    def read_products():
        reads.append(1)
        return products.withColumn("unit_cost", F.lit(float(len(reads))))

    callback = orders.refreshing_products(read_products, runs.batch_table(f"{shared}/out"))
    runs.start_query(orders.order_rows(raw), callback, f"{shared}/cp").awaitTermination()
    costs = spark.read.parquet(f"{shared}/out").groupBy("unit_cost").count()
    assert {r.unit_cost: r["count"] for r in costs.collect()} == {1.0: 2, 2.0: 2}


def test_stages_by_day(spark, shared, products):
    values = [order_message(i, "c", "p1", 1 + i % 2) for i in range(8)] + [order_message(8, "d")]
    raw = messages(spark, f"{shared}/in", values, batches=2)
    orders.run_stages(spark, raw, products, f"{shared}/base")
    gold = spark.read.parquet(f"{shared}/base/gold")
    assert gold.count() == 8 and gold.select("event_date").distinct().count() == 2
    assert spark.read.parquet(f"{shared}/base/bronze").count() == 9


def test_clickstream(spark, shared):
    rows = [json.dumps({"user_id": f"u{i % 2}", "page_url": "/", "country": "DE", "device_type": "web",
                        "event_time": (T0 + timedelta(minutes=i)).isoformat() + "Z", "page_load_ms": i})
            for i in range(200)]
    raw = messages(spark, f"{shared}/in", rows, "app.clickstream", batches=3)
    win = ColumnarSink("win", path=f"{shared}/win")
    ses = ColumnarSink("ses", path=f"{shared}/ses")
    for query in activity.run_clickstream(raw, win, ses, f"{shared}/cp", triggered=False):
        query.awaitTermination()
    newest = newest_version(spark.read.parquet(f"{shared}/win"), ["window_start", "country", "device_type"])
    assert newest.agg(F.sum("page_view_count")).first()[0] == 200 * 5
    batch = activity.user_sessions(activity.clicks(spark.read.schema(BROKER_SCHEMA).parquet(f"{shared}/in")))
    assert batch.count() == 2
    assert spark.read.schema("user_id string").parquet(f"{shared}/ses").count() == 0  # still open


def test_alerting(spark, shared):
    amounts = [10.0, 11.0, 9.0, 10.5, 9.5, 10.0, 500.0, 10.0, 10.0]
    rows = [json.dumps({"txn_id": str(i), "user_id": "u", "amount": a, "merchant": "m",
                        "event_time": (T0 + timedelta(minutes=6 * i)).isoformat() + "Z"})
            for i, a in enumerate([*amounts, 10.0, 10.0, 10.0])]
    raw = messages(spark, f"{shared}/in", rows, "app.transactions", batches=3)
    sink = BroadcastSink("alerts", {"path": f"{shared}/out"}, fmt="parquet")
    activity.run_alerting(raw, sink, f"{shared}/cp", None).awaitTermination()
    sent = [json.loads(r.value) for r in spark.read.parquet(f"{shared}/out").collect()]
    assert [(m["payload"]["txn_id"], m["user_targets"]) for m in sent] == [("6", ["u", "ops-team"])]


def test_raw_archive(spark, shared):
    values = [order_message(i, day=1 + i % 2) for i in range(6)] + ["junk", None]
    raw = messages(spark, f"{shared}/in", values, batches=2)
    operations.run_raw_archive(raw, f"{shared}/a", f"{shared}/dlq", f"{shared}/cp", None).awaitTermination()
    assert spark.read.parquet(f"{shared}/a").count() == 6
    assert spark.read.parquet(f"{shared}/dlq").count() == 1
    assert len(glob.glob(f"{shared}/a/year=2026/month=01/day=0?/hour=00")) == 2


def test_registered_streams_run_several_batches(spark):
    from eventlake.queries import streams

    clicks = streams._clicks(spark, "/root/testdata/sf0.001")
    drained = streams._drain(clicks, "check")
    assert drained.select("batch_id").distinct().count() == 4


def test_dead_letters_of_the_order_job(spark, shared, tmp_path, products):
    values = [order_message(1), "junk", None, order_message(2).replace('"op": "c"', '"op": "x"')]
    raw = messages(spark, f"{shared}/in", values, batches=2)
    queries = orders.run_lake_copy(raw, products, ColumnarSink("olap", path=f"{shared}/olap"), f"{shared}/cp", None,
                                   f"{shared}/dead")
    for query in queries:
        query.awaitTermination()
    assert spark.read.parquet(f"{shared}/olap").count() == 1
    reasons = [r.reject_reason for r in spark.read.parquet(f"{shared}/dead").collect()]
    assert sorted(reasons) == ["malformed", "unknown_op"]


def test_a_shared_plan_parses_a_message_once(spark, shared, products):
    values = [order_message(1), "junk", None, order_message(2).replace('"op": "c"', '"op": "x"'), order_message(3)]
    raw = messages(spark, f"{shared}/in", values, batches=2)
    sinks = [LakeSink("cold", path=f"{shared}/lake"), ColumnarSink("olap", path=f"{shared}/olap")]
    [query] = orders.run_enrichment(raw, products, sinks, f"{shared}/cp", None, shared=True, dead_letter_path=f"{shared}/dead")
    query.awaitTermination()
    table = spark.read.schema(raw.schema).parquet(f"{shared}/in")
    want = orders.enriched_orders(table, products)
    for path in ("lake", "olap"):
        got = spark.read.parquet(f"{shared}/{path}").select(*want.columns)
        assert got.count() == want.count() == 2 and got.exceptAll(want).count() == 0
    dead = spark.read.parquet(f"{shared}/dead").collect()
    assert sorted((r.reject_reason, r.raw_value == "junk") for r in dead) == [("malformed", True), ("unknown_op", False)]
    assert all(r.raw_value for r in dead)


def test_native_table_writer(spark, shared):
    stream = txn_stream(spark, f"{shared}/in", [[txn(1, "u", 0)], [txn(2, "u", 1)]])
    runs.start_table(stream, f"{shared}/out", f"{shared}/cp", trigger=None).awaitTermination()
    assert spark.read.parquet(f"{shared}/out").count() == 2
    query = runs.start_table(stream, "txn_table", f"{shared}/cp2", trigger=None)
    query.awaitTermination()
    assert spark.read.table("txn_table").count() == 2
    spark.sql("DROP TABLE txn_table")
