"""Stateful streams against their batch forms, over several micro-batches and restarts."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from test_streams import write_files

from eventlake.operators import anomaly, joins
from eventlake.operators.changes import latest_state_with_truncate
from eventlake.sources.broker import file_stream
from eventlake.streaming import retractions, runs
from eventlake.streaming.temporal import asof_join_streams
from eventlake.streaming.trailing import trailing_alerts_stream, trailing_stats_stream

T0 = datetime(2026, 1, 1)
ROWS = "id long, product string, at timestamp, odd double"
VERSIONS = "product string, since timestamp, cost double, label string"


def minute(k):
    return T0 + timedelta(minutes=k)


def in_batches(spark, path, batches, schema):
    write_files(spark, path, batches, schema)
    return file_stream(spark, path, 1, schema)


def same(got, want):
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


@pytest.mark.parametrize("salts", [1, 3])
def test_rows_wait_for_versions_that_come_later(spark, shared, salts):
    rows = [
        [(1, "p", minute(10), float("nan")), (2, "p", minute(12), None), (3, "q", minute(11), 1.0), (4, None, minute(11), 2.0), (5, "p", None, 3.0)],
        [(6, "p", minute(5), 0.1), (7, "p", minute(30), 0.2), (8, "r", minute(31), 0.3)],
        [(9, "p", minute(300), 0.4)], [(10, "p", minute(310), 0.5)],
    ]
    versions = [
        [("p", minute(0), 1.0, "a")],
        [("p", minute(11), 2.0, "b"), ("p", minute(12), 3.0, None), (None, minute(12), 9.0, "x"), ("q", None, 9.0, "x")],
        [("q", minute(1), 4.0, "c"), ("p", minute(40), 5.0, "d")],
        [("p", minute(305), 6.0, "e"), ("z", minute(400), 7.0, "f")],
    ]
    left = in_batches(spark, f"{shared}/rows", rows, ROWS)
    right = in_batches(spark, f"{shared}/versions", versions, VERSIONS)
    joined = asof_join_streams(left, right, "product", "at", "since", ["cost", "label"], "10 minutes", "60 minutes", "1 second", salts)
    got = runs.drain(joined, f"{shared}/out", f"{shared}/cp")
    assert got.select("batch_id").distinct().count() > 1
    table = spark.read.schema(ROWS).parquet(f"{shared}/rows")
    want = joins.asof_join(table, spark.read.schema(VERSIONS).parquet(f"{shared}/versions"), "product", "at", "since", ["cost", "label"])
    # Both watermarks end at minute 300: id 9 lies in the tick that ends a second later.
    same(got.drop("batch_id"), want.where("id not in (9, 10)"))
    assert got.where("id = 3").first()["cost"] == 4.0  # its version came two batches later


def test_a_stopped_run_goes_on_from_its_checkpoint(spark, shared):
    rng = random.Random(4)
    rows = [[(b * 100 + i, rng.choice("pq"), minute(60 * b + rng.randrange(60)), 1.0) for i in range(40)] for b in range(5)]
    versions = [[(p, minute(60 * b + rng.randrange(60)), float(b), "v") for p in "pq"] for b in range(5)]
    left = in_batches(spark, f"{shared}/rows", rows, ROWS)
    right = in_batches(spark, f"{shared}/versions", versions, VERSIONS)
    joined = asof_join_streams(left, right, "product", "at", "since", ["cost"], "1 hour", "1 hour")
    write = runs.batch_table(f"{shared}/out")

    def stops(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 3:
            raise RuntimeError("power cut")

    with pytest.raises(StreamingQueryException):
        runs.start_query(joined, stops, f"{shared}/cp").awaitTermination()
    runs.start_query(joined, write, f"{shared}/cp").awaitTermination()
    got = spark.read.parquet(f"{shared}/out").drop("batch_id")
    table, dims = spark.read.schema(ROWS).parquet(f"{shared}/rows"), spark.read.schema(VERSIONS).parquet(f"{shared}/versions")
    passed = min(table.agg(F.max("at")).first()[0], dims.agg(F.max("since")).first()[0]) - timedelta(hours=1, seconds=1)
    want = joins.asof_join(table, dims, "product", "at", "since", ["cost"]).where(F.col("at") <= F.lit(passed))
    same(got, want)


def state_rows(query):
    """The most rows that the state of a finished query has held."""
    return max(op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"])


def test_many_keys_share_few_values_of_state(spark, shared):
    rng = random.Random(14)
    names = [f"p{i}" for i in range(1500)]
    rows = [[(b * 1500 + i, p, minute(60 * b + rng.randrange(60)), 1.0) for i, p in enumerate(names)] for b in range(3)]
    versions = [[(p, minute(60 * b + rng.randrange(60)), float(b), "v") for p in names] for b in range(3)]
    left, right = in_batches(spark, f"{shared}/rows", rows, ROWS), in_batches(spark, f"{shared}/versions", versions, VERSIONS)
    joined = asof_join_streams(left, right, "product", "at", "since", ["cost"], "1 hour", "1 hour", buckets=4)
    query = runs.start_query(joined, runs.batch_table(f"{shared}/out"), f"{shared}/cp")
    query.awaitTermination()
    table, dims = spark.read.schema(ROWS).parquet(f"{shared}/rows"), spark.read.schema(VERSIONS).parquet(f"{shared}/versions")
    passed = min(table.agg(F.max("at")).first()[0], dims.agg(F.max("since")).first()[0]) - timedelta(hours=1, seconds=1)
    want = joins.asof_join(table, dims, "product", "at", "since", ["cost"]).where(F.col("at") <= F.lit(passed))
    same(spark.read.parquet(f"{shared}/out").drop("batch_id"), want)
    assert state_rows(query) < 200


IMAGE = "struct<k: string, v: long, at: timestamp>"
CHANGES = f"source_table string, source_lsn long, raw_offset long, cdc_op string, before {IMAGE}, after {IMAGE}"


def change(lsn, op, key=None, value=None, table="t"):
    image = (key, value, T0) if key else None
    return (table, lsn, lsn or value, op, image if op == "d" else None, None if op in "dt" else image)


def test_retractions_follow_updates_deletes_truncates_and_stale_changes(spark, shared):
    batches = [
        [change(1, "c", "a", 10), change(2, "c", "b", 20), change(3, "u", "a", 11), change(1, "c", "a", 99, "other")],
        [change(2, "c", "b", 20), change(9, "d", "b", 20), change(5, "u", "b", 21), change(20, "c", "c", 5)],
        [change(10, "t"), change(4, "u", "a", 12)],                     # takes a, not c
        [change(8, "u", "d", 7), change(11, "c", "a", 13), change(30, "t", table="none"), (None, 1, 1, None, None, None)],
        [change(12, "u", "e", 1), change(13, "u", "e", 2), change(14, "d", "e", 2), change(1, "t")],
    ]
    stream = in_batches(spark, f"{shared}/in", batches, CHANGES)
    rows = retractions.retractions(stream, ["k"], ["source_lsn", "raw_offset"], buckets=4)
    callback = retractions.weighted_sums(f"{shared}/sums", ["k"], {"v": F.col("v")})
    runs.start_query(rows, callback, f"{shared}/cp", output_mode="update").awaitTermination()
    got = retractions.totals(spark.read.parquet(f"{shared}/sums"), ["k"])
    log = spark.read.schema(CHANGES).parquet(f"{shared}/in").where("cdc_op is not null").withColumn("k", F.coalesce("after.k", "before.k"))
    state = latest_state_with_truncate(log, "source_table", ["k"], ["source_lsn", "raw_offset"])
    want = state.groupBy("k").agg(F.count("*").alias("rows"), F.sum("after.v").alias("v"))
    same(got.select("k", "rows", "v"), want)
    assert {r["k"]: r["v"] for r in got.collect()} == {"a": 112, "c": 5}
    # Every stored sum is of one batch; a batch run again replaces its own.
    assert spark.read.parquet(f"{shared}/sums").where("rows < 0").count() >= 2


TXNS = "id long, user_id string, amount double, event_time timestamp"


def test_trailing_stream_equals_batch(spark, shared):
    rng = random.Random(8)
    batches, n = [], 0
    for b in range(5):
        rows = []
        for _ in range(120):
            at = minute(50 * b + rng.randrange(-20 if b else 0, 50)) + timedelta(seconds=rng.randrange(3) * 20)
            amount = None if rng.random() < 0.05 else 5.0 if rng.random() < 0.5 else round(rng.uniform(0, 1e7), 2)
            rows.append((n, rng.choice(["u", "v", None]), amount, at))
            n += 1
        rows.append((n, "u", 1.0, None))
        n += 1
        batches.append(rows)
    stream = in_batches(spark, f"{shared}/in", batches, TXNS)
    args = ("user_id", "amount", "event_time", "40 minutes")
    got = runs.drain(trailing_stats_stream(stream, *args, allowed="70 minutes"), f"{shared}/out", f"{shared}/cp")
    assert got.select("batch_id").distinct().count() > 2
    table = spark.read.schema(TXNS).parquet(f"{shared}/in")
    passed = table.agg(F.max("event_time")).first()[0] - timedelta(minutes=70)
    batch = anomaly.trailing_stats(table, *args)
    same(got.drop("batch_id"), batch.where(F.col("event_time") <= F.lit(passed)))


def test_first_per_window_holds_many_keys_in_few_values(spark, shared):
    from eventlake.operators.dedup import first_per_window
    from eventlake.streaming.dedup import first_per_window_stream

    rng = random.Random(16)
    batches = [[(b * 3000 + k, f"u{k % 1000}", 1.0, minute(60 * b + rng.randrange(60))) for k in range(3000)] for b in range(3)]
    stream = in_batches(spark, f"{shared}/in", batches, TXNS)
    kept = first_per_window_stream(stream, "user_id", "event_time", "50 minutes", "2 hours", ["id"], buckets=8)
    query = runs.start_query(kept, runs.batch_table(f"{shared}/out"), f"{shared}/cp")
    query.awaitTermination()
    want = first_per_window(spark.read.schema(TXNS).parquet(f"{shared}/in"), "user_id", "event_time", "50 minutes", ["id"])
    same(spark.read.parquet(f"{shared}/out").drop("batch_id"), want)
    assert state_rows(query) < 100


@pytest.mark.parametrize("salts", [1, 3])
def test_last_windows_of_a_stream_equal_batch(spark, shared, salts):
    """Many users in few values of state, one of them hot, and no window that no row needs."""
    rng = random.Random(15)
    batches, n = [], 0
    for b in range(4):
        rows = [(n, "u", 1.0, None), (n + 1, None, 1.0, minute(60 * b))]
        for k in range(1200):
            user = "hot" if k % 3 == 0 else f"u{k}"
            amount = None if rng.random() < 0.05 else round(rng.uniform(0, 1e10), 2)
            rows.append((n + 2 + k, user, amount, minute(60 * b + rng.randrange(60)) + timedelta(seconds=rng.randrange(3) * 20)))
        n += len(rows)
        batches.append(rows)
    stream = in_batches(spark, f"{shared}/in", batches, TXNS)
    args = {"size": "90 minutes", "slide": "10 minutes"}
    scores = anomaly.windowed_scores(stream, **args, watermark="7 minutes", salts=salts)
    query = runs.start_query(scores, runs.batch_table(f"{shared}/out"), f"{shared}/cp")
    query.awaitTermination()
    table = spark.read.schema(TXNS).parquet(f"{shared}/in")
    passed = table.agg(F.max("event_time")).first()[0] - timedelta(minutes=7)
    got = spark.read.parquet(f"{shared}/out").drop("batch_id")
    want = anomaly.windowed_scores(table, **args).where(F.col("window_end") <= F.lit(passed))
    assert got.columns == want.columns
    same(got, want.select(*got.columns))
    assert state_rows(query) < 512 * 4 * salts


def test_trailing_alerts_of_a_stream(spark, shared):
    rows = [[(b * 10 + i, "u", 10.0 + i % 2, minute(b * 10 + i)) for i in range(10)] for b in range(3)]
    rows[2][9] = (29, "u", 500.0, minute(29))
    rows.append([(30, "u", 10.0, minute(90))])
    alerts = trailing_alerts_stream(in_batches(spark, f"{shared}/in", rows, TXNS))
    got = runs.drain(alerts, f"{shared}/out", f"{shared}/cp").collect()
    assert [(r["id"], r["alert_type"], r["txn_count"]) for r in got] == [(29, "anomalous_amount", 29)]


POINTS = "metric string, dimension string, value double, ts timestamp"


def test_alarms_begin_and_end_while_the_stream_runs(spark, shared):
    from eventlake.operators.metrics import Alarm, evaluate_alarms
    from eventlake.streaming.alarms import alarm_stream

    alarms = [Alarm("high", "m", "max", "1 minute", 10.0, 2), Alarm("mean", "m", "avg", "2 minutes", 5.0, 1), Alarm("low", "n", "min", "1 minute", 0.0, 3)]
    rng = random.Random(2)
    batches = []
    for b in range(5):
        rows = []
        for _ in range(60):
            k = 30 * b + rng.randrange(30)
            if 40 <= k < 50:  # nobody reports
                continue
            rows.append((rng.choice("mn"), rng.choice(["d1", "d2"]), 20.0 if k % 7 < 4 else rng.uniform(-3, 9), minute(k) + timedelta(seconds=rng.randrange(60))))
        rows.append(("m", None, 99.0, minute(30 * b)))
        rows.append(("m", "d1", None, minute(30 * b)))
        batches.append(rows)
    batches.append([("other", "d1", 1.0, minute(170))])
    stream = in_batches(spark, f"{shared}/in", batches, POINTS)
    got = runs.drain(alarm_stream(stream, alarms, allowed="1 minute"), f"{shared}/out", f"{shared}/cp").drop("batch_id")
    table = spark.read.schema(POINTS).parquet(f"{shared}/in").where("value is not null")
    want = evaluate_alarms(table, alarms)
    ended = got.where("state = 'OK'").drop("state")
    rounded = [df.withColumn("worst_value", F.round("worst_value", 6)) for df in (ended, want)]
    same(*rounded)  # the last point has closed every period
    begun = got.where("state = 'ALARM'").select("alarm", "dimension", "breach_start")
    same(begun, want.select("alarm", "dimension", "breach_start"))


def test_lateness_is_counted_by_batch_and_advice_covers_it(spark, shared):
    from eventlake.streaming.lateness import LatenessHistogram, bucket_end, lateness_bucket, watermark_advice

    values = sorted({0, 1, 7, 8, 9, 15, 16, 17, 1000, 12345, 10**9, 10**12 + 7, *(2**k for k in range(50)), *(2**k - 1 for k in range(1, 50))})
    rows = spark.createDataFrame([(v,) for v in values], "v long").select("v", bucket_end(lateness_bucket(F.col("v"))).alias("e"), lateness_bucket(F.col("v")).alias("b")).orderBy("v").collect()
    assert all(r["v"] <= r["e"] <= r["v"] * 9 / 8 + 1 for r in rows)
    assert [r["b"] for r in rows] == sorted(r["b"] for r in rows)
    batches = [[(minute(0),), (minute(60),)], [(minute(50),), (minute(100),), (None,)], [(minute(99),)] * 7 + [(minute(40),)]]
    histogram = LatenessHistogram(f"{shared}/measured", "ts")
    frames = [spark.createDataFrame(b, "ts timestamp") for b in batches]
    for number in (0, 1, 1, 2, 2):  # batches that run again
        histogram(frames[number], number)
    counts = histogram.histogram(spark).collect()
    assert sum(r["n"] for r in counts) == 12 and {r["bucket"]: r["n"] for r in counts}[0] == 3
    advice = {r["share"]: (r["delay_us"], r["late_rows"]) for r in watermark_advice(histogram.histogram(spark), [0.0, 0.1, 0.5, 1.0]).collect()}
    hour = 3_600_000_000
    assert hour <= advice[0.0][0] <= hour * 9 / 8 and advice[0.0][1] == 0
    assert hour / 6 <= advice[0.1][0] <= hour / 6 * 9 / 8 and advice[0.1][1] == 1
    assert hour / 60 <= advice[0.5][0] <= hour / 60 * 9 / 8 and advice[1.0] == (0, 9)


def test_sketches_roll_up_within_their_bound(spark):
    from eventlake.operators import sketches

    rng = random.Random(3)
    rows = [(rng.choice("ab") if i % 3 else "a", int(rng.expovariate(0.01)), minute(rng.randrange(3000))) for i in range(30_000)] + [("a", None, minute(1)), ("b", 5, None)]
    df = spark.createDataFrame(rows, "k string, v long, ts timestamp").repartition(6)
    level = sketches.value_sketches(df, "v", "ts", ["k"], k=800)
    for width in sketches.LEVELS:
        level = sketches.rolled_up(level, ["k"], width)
        named = sketches.sketch_quantiles(level, {"low": 0.0, "p50": 0.5, "p99": 0.99, "top": 1.0})
        start = sketches._start(F.col("ts"), width)
        exact = df.where("v is not null and ts is not null").select("k", "v", start.alias("window_start")).join(named, ["k", "window_start"])
        checked = exact.groupBy("k", "window_start", "n", "low", "top", *("p50", "p99")).agg(
            F.count("*").alias("m"), F.min("v").alias("least"), F.max("v").alias("most"),
            *[F.sum((F.col("v") <= F.col(p)).cast("int")).alias(f"upto_{p}") for p in ("p50", "p99")],
            *[F.sum((F.col("v") < F.col(p)).cast("int")).alias(f"below_{p}") for p in ("p50", "p99")]).collect()
        assert len(checked) == level.count()
        for r in checked:
            assert (r["n"], r["low"], r["top"]) == (r["m"], r["least"], r["most"])
            for p, q in (("p50", 0.5), ("p99", 0.99)):
                assert r[f"below_{p}"] / r["m"] - 0.01 <= q <= r[f"upto_{p}"] / r["m"] + 0.01


def test_missing_keys_compares_only_cells_that_differ(spark):
    from eventlake.operators.sketches import missing_keys

    made = spark.range(20_000).select("id", (F.col("id") % 3).alias("t"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 5).alias("ts"))
    made = made.union(made.where("id < 50")).union(made.where("id = 1").select(F.lit(None).cast("long"), "t", "ts"))
    lost = F.col("id").isin(7, 8, 19_999) | F.col("id").between(5000, 5100)
    held = made.where(~lost | F.col("id").isNull())
    for entries, slices in ((12, 1), (12, 3), (4, 1)):  # the last holds no cell exactly
        got = [r["id"] for r in missing_keys(made, held, "id", "ts", ["t"], slices=slices, lg_entries=entries).collect()]
        assert sorted(got) == [7, 8, *range(5000, 5101), 19_999]
    assert missing_keys(made, made.union(made), "id", "ts", ["t"]).count() == 0
    assert missing_keys(made.where("id < 10"), made.limit(0), "id", "ts", ["t"]).count() == 10
