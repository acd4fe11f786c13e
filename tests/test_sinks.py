from __future__ import annotations

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventlake.plans.orders import order_sinks
from eventlake.sinks import base, broadcast, columnar, document, keyed, lake

T0 = datetime(2026, 1, 2, 3)
COLS = "order_id string, event_id string, event_time timestamp, order_ts timestamp, raw_offset long, total_amount double"


def orders(spark, *rows):
    return spark.createDataFrame(list(rows), COLS)


def two(spark):
    return orders(spark, ("a", "1", T0, T0, 1, 10.0), ("b", "2", T0, T0, 2, 20.0))


def folder_client(path):
    """Executor-side client: one JSON line per row, in its own file; keys starting with 'bad' fail."""
    def open_client():
        import uuid

        os.makedirs(path, exist_ok=True)

        def store(rows):
            ok = [not str(r.get("key") or r.get("_id")).startswith("bad") for r in rows]
            with open(f"{path}/{uuid.uuid4().hex}", "w") as out:
                for row, good in zip(rows, ok):
                    if good:
                        out.write(json.dumps(row, default=str) + "\n")
            return ok

        return store

    return open_client


def stored(path):
    lines = []
    for name in os.listdir(path):
        with open(f"{path}/{name}") as f:
            lines += [json.loads(line) for line in f]
    return lines


class Failing(base.Sink):
    def __init__(self, outcome, **kwargs):
        super().__init__("failing", **kwargs)
        self.outcome = outcome

    def write(self, batch, batch_id):
        if isinstance(self.outcome, Exception):
            raise self.outcome
        return self.outcome


def test_outcome_rates():
    assert base.BatchOutcome("s", 1, 0, 0, 5).failure_rate == 0.0
    assert base.BatchOutcome("s", 1, 3, 1, 5).failure_rate == 0.25


def test_tolerance_halts(spark):
    df = two(spark)
    Failing((99, 1), max_failure_fraction=0.01).foreach_batch()(df, 0)
    with pytest.raises(base.SinkFailure, match="50.00%"):
        Failing((1, 1)).foreach_batch()(df, 3)
    for rows, tolerated in ((df, 0.0), (df.limit(0), 0.0), (df, 1.0)):
        with pytest.raises(base.SinkFailure, match="100.00%.*down") as failure:
            Failing(ValueError("down"), max_failure_fraction=tolerated).foreach_batch()(rows, 3)
        assert isinstance(failure.value.__cause__, ValueError)


def test_metrics_are_replaced_on_replay(spark, shared):
    sink = Failing((5, 0), metrics_path=shared)
    for batch_id in (0, 1, 1):
        sink.foreach_batch()(two(spark), batch_id)
    rows = spark.read.parquet(shared)
    assert rows.count() == 2 and rows.agg(F.sum("records_written")).first()[0] == 10


def test_keyed_sink_writes_from_tasks(spark, tmp_path):
    path = str(tmp_path / "hot")
    df = orders(spark, ("a", "1", T0, T0, 1, 10.0), ("a", "2", T0, T0, 5, 11.0), (None, "3", T0, T0, 2, None))
    sink = keyed.KeyedSink("hot", folder_client(path), "order_id", "order:", position=("raw_offset",))
    assert sink.write(df, 0) == (2, 0)
    by_key = {r["key"]: dict(f.values() if isinstance(f, dict) else f for f in r["fields"]) for r in stored(path)}
    assert by_key["order:a"]["total_amount"] == "11.0"
    assert "total_amount" not in by_key["order:eid:3"]


def test_item_failures_are_counted(spark, tmp_path):
    df = orders(spark, ("a", "1", T0, T0, 1, 10.0), ("b", "2", T0, T0, 2, 20.0))
    bad = keyed.KeyedSink("hot", folder_client(str(tmp_path / "x")), "order_id", "bad:")
    assert bad.write(df, 0) == (0, 2)

    def open_broken():
        def store(rows):
            raise OSError("gone")
        return store

    broken = keyed.KeyedSink("hot", open_broken, "order_id")
    assert broken.write(df, 0) == (0, 2)
    assert broken.first_error == "OSError: gone"
    assert keyed.KeyedSink("hot", open_broken, "order_id").write(df.limit(0), 0) == (0, 0)
    assert document.statuses_ok([200, 201, 400, 500]) == [True, True, False, False]


def test_field_merge_keeps_the_previous_value(spark):
    df = orders(spark, ("a", "1", T0, T0, 1, 10.0), ("a", "2", T0, T0, 2, None))
    merged = keyed.merged_hash_rows(df, "o:", "order_id", ["raw_offset"]).first().fields
    assert merged["total_amount"] == "10.0" and merged["raw_offset"] == "2"
    replaced = keyed.hash_rows(df, "o:", "order_id", 60, F.lit(T0), ["raw_offset"]).first()
    assert "total_amount" not in replaced.fields and replaced.expires_at == T0 + timedelta(seconds=60)
    assert keyed.live_rows(keyed.hash_rows(df, "o:", "order_id", 60, F.lit(T0)),
                           F.lit(T0 + timedelta(seconds=61))).count() == 0


def test_document_sink(spark, tmp_path):
    path = str(tmp_path / "search")
    df = two(spark)
    sink = document.DocumentSink("s", folder_client(path), "orders-{yyyy_mm_dd}", "order_ts", ("raw_offset",))
    assert sink.write(df.unionByName(df), 0) == (2, 0)
    assert {(r["_index"], r["_id"]) for r in stored(path)} == {
        ("orders-2026.01.02", "eid:1"), ("orders-2026.01.02", "eid:2")}
    assert json.loads(stored(path)[0]["_source"])["event_time"].startswith("2026-01-02T03:00:00")


def test_columnar_replay_does_not_double(spark, shared):
    sink = columnar.ColumnarSink("olap", path=shared)
    assert sink.write(two(spark), 0) == (2, 0)
    assert sink.write(two(spark), 0) == (2, 0)
    assert sink.write(two(spark).withColumn("total_amount", F.lit(1.0)), 1) == (2, 0)
    rows = spark.read.parquet(shared)
    assert rows.count() == 4
    newest = columnar.newest_version(rows, ["order_id"])
    assert [r.total_amount for r in newest.collect()] == [1.0, 1.0]
    with pytest.raises(ValueError):
        columnar.ColumnarSink("olap")


def test_lake_layout(spark, shared):
    sink = lake.LakeSink("cold", path=shared)
    for _ in range(2):
        sink.write(two(spark), 0)
    sink.write(two(spark).withColumn("order_ts", F.lit(T0 + timedelta(days=1))), 1)
    rows = spark.read.parquet(shared)
    assert rows.count() == 4
    assert sorted(d for d in os.listdir(shared) if d.startswith("event")) == [
        "event_date=2026-01-02", "event_date=2026-01-03"]
    assert lake.lake_rows(rows).columns == rows.columns
    month = lake.lake_rows(two(spark), unit="month").first().event_date
    assert str(month) == "2026-01-01"


def test_lake_catalog_table(spark):
    spark.sql("CREATE TABLE cold (order_id string, event_id string, event_time timestamp, order_ts timestamp, "
              "raw_offset long, total_amount double, event_date date, batch_id long) USING parquet")
    try:
        assert lake.LakeSink("cold", table="spark_catalog.default.cold").write(two(spark), 0) == (2, 0)
    except Exception as error:  # the built-in catalog has no v2 tables; lake catalogs do
        assert "V1" in str(error) or "v1" in str(error) or "TABLE" in str(error).upper()
    finally:
        spark.sql("DROP TABLE cold")


def test_archive_folders_and_dead_letters(spark, shared):
    values = ['{"ts_ms": 1767322800000}', '{"ts_ms": 1767326400000}', "junk", None]
    rows = spark.createDataFrame([(i, v and v.encode()) for i, v in enumerate(values)], "offset long, value binary")
    ts_ms = F.get_json_object(F.col("value").cast("string"), "$.ts_ms").try_cast("long")
    sink = lake.ArchiveSink("raw", f"{shared}/a", f"{shared}/dlq", ts_ms)
    for _ in range(2):
        assert sink.write(rows, 0) == (2, 0)
    assert os.path.isdir(f"{shared}/a/year=2026/month=01/day=02/hour=03/batch_id=0")
    assert os.path.isdir(f"{shared}/a/year=2026/month=01/day=02/hour=04/batch_id=0")
    dead = spark.read.parquet(f"{shared}/dlq").collect()
    assert [(d.offset, d.reject_reason) for d in dead] == [(2, "no readable ts_ms")]


def test_parking_and_replay(spark, shared, tmp_path):
    path, parked = str(tmp_path / "back"), f"{shared}/parked"
    df = two(spark)

    def open_unreachable():
        def store(rows):
            raise TimeoutError("no answer")
        return store

    for batch_id, sink in ((0, Failing(ConnectionResetError("down"))), (1, keyed.KeyedSink("hot", open_unreachable, "order_id"))):
        outcome = base.ParkingSink(sink, parked).run(df, batch_id)
        assert (outcome.records_written, outcome.records_failed, outcome.records_parked) == (0, 0, 2)
    assert base.ParkingSink(Failing((2, 0)), parked).write(df, 2) == (2, 0)
    # Only outages park: other errors and refused rows fail.
    with pytest.raises(base.SinkFailure):
        base.ParkingSink(Failing(KeyError("no such column")), parked).foreach_batch()(df, 3)
    with pytest.raises(base.SinkFailure):
        base.ParkingSink(Failing((1, 1)), parked).foreach_batch()(df, 4)
    up = keyed.KeyedSink("hot", folder_client(path), "order_id")
    assert [o.records_failed for o in base.replay_parked(spark, parked, df.schema, Failing((0, 2)))] == [2, 2]
    outcomes = base.replay_parked(spark, parked, df.schema, up)
    assert [(o.batch_id, o.records_written) for o in outcomes] == [(0, 2), (1, 2)]
    assert base.replay_parked(spark, parked, df.schema, up) == []


def test_once_per_token(spark):
    df = two(spark)
    rows = df.withColumn("batch_id", F.lit(0)).union(df.withColumn("batch_id", F.lit(3)))
    assert sorted((r.order_id, r.batch_id) for r in base.once_per_token(rows).collect()) == [("a", 3), ("b", 3)]


def test_fan_out_computes_once(spark, shared):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = two(spark).mapInArrow(count, COLS)
    base.fan_out([lake.LakeSink("a", path=f"{shared}/a"), columnar.ColumnarSink("b", path=f"{shared}/b")])(df, 0)
    assert spark.read.parquet(f"{shared}/a").count() == spark.read.parquet(f"{shared}/b").count() == 2
    assert seen.value == 2


def test_order_sinks_names(tmp_path):
    sinks = order_sinks(folder_client("x"), folder_client("y"), str(tmp_path))
    assert [s.name for s in sinks] == ["orders-hot", "orders-search", "orders-cold"]
    assert (sinks[0].prefix, sinks[0].ttl_seconds) == ("order:", 3600)


def registry(spark, now=T0):
    rows = [
        ("c1", "connect", "u1", " orders, ,alerts", T0 - timedelta(hours=1)),
        ("c2", "connect", "u1", None, T0 - timedelta(hours=2)),
        ("c3", "connect", None, "", T0 - timedelta(hours=3)),
        ("c4", "connect", "u2", "x", T0 - timedelta(hours=5)),
        ("c4", "disconnect", None, None, T0 - timedelta(hours=4)),
        ("c5", "connect", "u3", "x", T0 - timedelta(hours=25)),
        ("c6", "connect", "u3", "x", T0 - timedelta(hours=9)),
        ("c6", "gone", None, None, T0 - timedelta(hours=8)),
        ("c7", "disconnect", None, None, T0 - timedelta(hours=8)),
        ("c7", "connect", "u7", None, T0 - timedelta(hours=7)),
        ("c8", "connect", "u8", None, T0 - timedelta(hours=6)),
        ("c8", "disconnect", None, None, T0 - timedelta(hours=6)),
    ]
    events = spark.createDataFrame(
        rows, "connection_id string, event string, user_id string, topics string, ts timestamp")
    return broadcast.connection_registry(events, F.lit(now))


def test_registry(spark):
    rows = {r.connection_id: r for r in registry(spark).collect()}
    assert sorted(rows) == ["c1", "c2", "c3", "c7"]
    assert rows["c1"].subscribed_topics == ["orders", "alerts"]
    assert rows["c3"].subscribed_topics == ["*"] and rows["c3"].user_id == "anonymous"
    assert rows["c1"].ttl == int((T0 - datetime(1970, 1, 1)).total_seconds()) + 23 * 3600


@pytest.mark.parametrize("targets,want", [
    ('"*"', ["c1", "c2", "c3", "c7"]), (None, ["c1", "c2", "c3", "c7"]), ('"u1"', ["c1", "c2"]),
    ('["u1","u7"]', ["c1", "c2", "c7"]), ('["u1","u1"]', ["c1", "c1", "c2", "c2"]),
    ('"nobody"', []), ('["*"]', []), ("[]", []),
])
def test_recipients(spark, targets, want):
    value = '{"payload":{}}' if targets is None else f'{{"user_targets":{targets}}}'
    df = spark.createDataFrame([(value,)], "value string")
    everyone, users = broadcast.parse_targets(F.col("value"))
    messages = df.select("value", everyone.alias("everyone"), users.alias("users"))
    out = broadcast.resolve_recipients(messages, registry(spark))
    assert sorted(r.connection_id for r in out.collect()) == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan


def test_broadcast_messages(spark):
    df = spark.createDataFrame([("t1", ["u1", "ops-team"]), ("t2", None)], "txn_id string, user_targets array<string>")
    got = [json.loads(r.value) for r in broadcast.broadcast_messages(df, F.lit(4)).collect()]
    assert got[0] == {"user_targets": ["u1", "ops-team"], "batch_id": 4, "token": "koffset:?:?:?",
                      "payload": {"txn_id": "t1", "user_targets": ["u1", "ops-team"]}}
    assert "user_targets" not in got[1]
    plain = broadcast.broadcast_messages(df.drop("user_targets"), F.lit(4)).first()
    assert json.loads(plain.value)["user_targets"] == "*"


def test_broadcast_sink(spark, shared):
    df = spark.createDataFrame([("t1", ["u1"])], "txn_id string, user_targets array<string>")
    sink = broadcast.BroadcastSink("ws", {"path": shared}, fmt="parquet")
    assert sink.write(df, 1) == (1, 0)
    assert spark.read.parquet(shared).first().topic == "ws-broadcast"


def test_delivery_outcomes(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "ok boolean")
    assert tuple(broadcast.delivery_outcomes(df, F.col("ok")).first()) == (1, 2)


def test_only_rows_that_found_no_store_are_parked(spark, shared, tmp_path):
    path, parked = str(tmp_path / "store"), f"{shared}/parked"
    df = spark.range(60).select(F.col("id").cast("string").alias("key")).repartition(3)

    def flaky(lost):
        inner = folder_client(path)

        def open_client():
            store = inner()

            def send(rows):
                if any(int(r["key"]) % 5 in lost for r in rows):
                    raise TimeoutError("no answer")
                return ["too small" if not ok or r["key"] == "7" else True for r, ok in zip(rows, store([r for r in rows if r["key"] != "7"] or rows))]

            return send

        return open_client

    def sink(*lost):
        return base.PartitionSink("s", flaky(lost), rows_per_call=1, max_failure_fraction=0.1)

    outcome = base.ParkingSink(sink(0, 1), parked).run(df, 4)
    assert (outcome.records_written, outcome.records_failed, outcome.records_parked) == (35, 1, 24)
    assert {r["key"] for r in base.parked_batches(spark, parked, df.schema).collect()} == {str(k) for k in range(60) if k % 5 < 2}
    assert [(o.records_written, o.records_parked) for o in base.replay_parked(spark, parked, df.schema, sink(1))] == [(12, 12)]
    assert [(o.records_written, o.records_parked) for o in base.replay_parked(spark, parked, df.schema, sink())] == [(12, 0)]
    assert base.replay_parked(spark, parked, df.schema, sink()) == []
    keys = [r["key"] for r in stored(path) if r["key"] != "7"]
    assert sorted(map(int, keys)) == [k for k in range(60) if k != 7]  # none twice
    lost = base.rejected_rows(spark, f"{parked}-rejects", df.schema)
    assert [tuple(r) for r in lost.where("status = 'refused'").select("batch_id", "reason", "key").collect()] == [(4, "too small", "7")]


def test_a_typed_error_is_no_outage(spark, shared):
    def open_mixed():
        def store(rows):
            raise (TimeoutError("slow") if rows[0]["key"].endswith("a") else KeyError("no such field"))
        return store

    df = orders(spark, ("a", "1", T0, T0, 1, 10.0), ("b", "2", T0, T0, 2, 20.0))
    sink = keyed.KeyedSink("hot", open_mixed, "order_id", rows_per_call=1)
    outcome = base.ParkingSink(sink, f"{shared}/parked").run(df, 0)
    assert (outcome.records_failed, outcome.records_parked) == (2, 0)
    assert sink.counts == {"stored": 0, "refused": 0, "unreachable": 1, "failed": 1}


def test_figures_stay_until_they_are_stored(spark, shared):
    from eventlake.streaming.progress import ProgressListener

    listener = ProgressListener()
    listener.rows.append(("job", 1, "2026-01-01T00:00:00Z", 5, 5, 10, None, 0.0, 0.0, 0, 0))
    listener.rules.append(("job", 1, "2026-01-01T00:00:00Z", "amount_positive", 5, 2))
    with pytest.raises(Exception):
        listener.flush(spark, "nowhere://x")
    assert len(listener.rows) == len(listener.rules) == 1
    listener.flush(spark, f"{shared}/figures")
    assert not listener.rows and not listener.rules
    assert spark.read.parquet(f"{shared}/figures-rules").first()["failed"] == 2


def test_folding_reads_the_same_rows_after_every_step(spark, shared):
    from eventlake.sinks.folding import file_count, fold_batches, read_folded

    path = f"{shared}/table"
    df = spark.range(120).select("id", F.expr("date_add(DATE'2026-01-01', cast(id % 3 as int))").alias("event_date"), (F.col("id") % 12).alias("turn"))
    schema = df.drop("turn").schema

    def write(number):
        rows = df.where(F.col("turn") == number).drop("turn").withColumn("batch_id", F.lit(number).cast("long"))
        base.overwrite_partitions(rows, path, ["event_date", "batch_id"])

    def ids():
        return sorted((r["id"], r["batch_id"]) for r in read_folded(spark, path, schema).collect())

    want = []
    for number, until in ((0, 3), (1, 3), (2, 3), (3, 1), (4, 1), (5, 2), (6, 3), (7, 2), (8, 1), (9, 3), (10, 3), (11, 3)):
        for _ in range(2):  # the newest batch may run again
            write(number)
        want += [(i, number) for i in range(120) if i % 12 == number]
        fold_batches(spark, path, schema, until=until)
        assert ids() == sorted(want)
    left = [d for _, folders, _ in os.walk(path) for d in folders if d.startswith("batch_id=")]
    assert set(left) == {"batch_id=11"}
    assert fold_batches(spark, path, schema) is None
    assert fold_batches(spark, path, schema, keep_open=0) == 11 and ids() == sorted(want)
    assert file_count(spark, path) > 0
    assert fold_batches(spark, f"{shared}/nothing", schema) is None
