from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventlake.operators import metrics
from eventlake.sources.tables import recent, union_tracks

T0 = datetime(2026, 1, 1)


def points(spark, *values, metric="m", step=60):
    rows = [(metric, "d", float(v), T0 + timedelta(seconds=i * step))
            for i, v in enumerate(values) if v is not None]
    return spark.createDataFrame(rows, "metric string, dimension string, value double, ts timestamp")


def test_alarm_needs_consecutive_periods(spark):
    alarm = metrics.Alarm("a", "m", "max", "1 minute", 5.0, 2)
    # Breaches: minutes 1-2, 4 (alone), 6-8; minute 5 has no points and does not breach.
    df = points(spark, 0, 6, 7, 5, 9, None, 6, 8, 6)
    rows = metrics.alarm_runs(df, alarm).orderBy("breach_start").collect()
    assert [(r.breach_start, r.breach_end, r.periods, r.worst_value) for r in rows] == [
        (T0 + timedelta(minutes=1), T0 + timedelta(minutes=3), 2, 7.0),
        (T0 + timedelta(minutes=6), T0 + timedelta(minutes=9), 3, 8.0)]


def test_platform_and_rate_alarms(spark):
    df = points(spark, *[400] * 3, metric="EstimatedMaxTimeLag").unionByName(
        points(spark, *[501] * 5, metric="backPressuredTimeMsPerSecond")).unionByName(
        points(spark, *[90] * 11, metric="KafkaDataLogsDiskUsed")).unionByName(
        points(spark, *[11_000] * 10, metric="BatchDurationMs"))
    alarms = [*metrics.PLATFORM_ALARMS, *metrics.RATE_ALARMS, metrics.slow_batch_alarm(5_000)]
    got = {r.alarm: r.periods for r in metrics.evaluate_alarms(df, alarms).collect()}
    assert got == {"consumer-lag": 3, "backpressure": 5, "disk-usage": 3, "slow-batches": 10}


def test_growing_lag(spark):
    hour = 3_600_000
    df = points(spark, hour, hour * 2, hour * 2, hour * 3, 100, 200, metric="LagMs")
    assert [r.lag_value for r in metrics.growing_lag(df).orderBy("period_start").collect()] == [
        hour * 2, hour * 3]


@pytest.mark.parametrize("chunk", [2, 5, 1000])
def test_falling_behind_across_chunks(spark, chunk):
    slow = {3, 4, 5, 6, 8, 9, 11, 12, 13}
    rows = [("j", i, 10.0, 5.0 if i in slow else 10.0) for i in range(15) if i != 12]
    df = spark.createDataFrame(
        rows, "job string, batch_id long, input_per_second double, processed_per_second double")
    out = metrics.falling_behind(df, batches=3, chunk=chunk)
    assert sorted(r.batch_id for r in out.collect()) == [5, 6]


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_exact_percentiles_equal_sorting(spark, width):
    rnd = random.Random(4)
    values = {"a": [rnd.randrange(500) for _ in range(999)], "b": [7], "c": [3, 3, 3, 9]}
    df = spark.createDataFrame([(g, v) for g, vs in values.items() for v in vs], "g string, v long")
    got = {(r.g, r.percentile): r.value for r in metrics.exact_percentiles(df, "g", "v", width=width).collect()}
    for g, vs in values.items():
        for p in (0.5, 0.9, 0.95, 0.99):
            rank = max(1, -(-round(p * len(vs) * 10 ** 6) // 10 ** 6))
            assert got[g, p] == sorted(vs)[rank - 1]


def test_failure_rates(spark):
    df = spark.createDataFrame(
        [("s", 1, 0, 0, 5), ("s", 2, 9, 1, 7)],
        "sink_name string, batch_id long, records_written long, records_failed long, duration_ms long")
    rates = df.select(metrics.failure_rate(F.col("records_written"), F.col("records_failed")))
    assert [r[0] for r in rates.collect()] == [0.0, 0.1]
    assert [r.batch_id for r in metrics.breached_batches(df).collect()] == [2]
    assert metrics.breached_batches(df, 0.1).count() == 0
    total = metrics.sink_totals(df).first()
    assert (total.written, total.failed, total.failure_rate) == (9, 1, 0.1)


def test_published_costs(spark):
    rows = spark.createDataFrame([(0.44, 8500.0), (0.71, 9200.0), (0.44, 11000.0), (1.0, 0.0)],
                                 "cost double, eps double")
    cost = rows.select(F.round(metrics.cost_per_million(F.col("cost"), F.col("eps")), 3))
    assert [r[0] for r in cost.collect()] == [0.014, 0.021, 0.011, None]


def test_completeness(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    assert tuple(metrics.completeness(df, "k").first()) == (3, 2, 1, 1)
    assert [tuple(r) for r in metrics.repeated_keys(df.where("k is not null"), "k").collect()] == [("a", 2)]


def test_approx_completeness(spark):
    row = metrics.approx_completeness(spark.range(50_000).unionAll(spark.range(50_000)), "id").first()
    assert row.row_count == 100_000 and abs(row.distinct_keys - 50_000) < 2_500


def test_consumer_lag(spark):
    ends = spark.createDataFrame([("t", 0, 0, 10), ("t", 1, 5, 20)],
                                 "topic string, partition int, first_offset long, end_offset long")
    done = spark.createDataFrame([("t", 0, 12)], "topic string, partition int, committed_offset long")
    lags = metrics.consumer_lag(ends, done)
    assert sorted(r.lag for r in lags.collect()) == [0, 15]
    assert tuple(metrics.lag_summary(lags).first()) == ("t", 2, 15, 15)


def test_retention(spark):
    now = F.lit(T0)
    df = spark.createDataFrame(
        [("hot", T0 - timedelta(minutes=59)), ("hot", T0 - timedelta(minutes=61)),
         ("lake", T0 - timedelta(days=91)), ("lake", T0 - timedelta(days=89)),
         ("other", T0 - timedelta(days=9999))], "tier string, ts timestamp")
    policy = spark.createDataFrame(list(metrics.TIER_POLICY),
                                   "tier string, keep_days double, move_days double")
    out = metrics.retention_actions(df, policy, now, "ts").groupBy("tier", "action").count()
    assert sorted(tuple(r) for r in out.collect()) == [
        ("hot", "expire", 1), ("hot", "keep", 1), ("lake", "keep", 1), ("lake", "move", 1),
        ("other", "keep", 1)]


def test_recent_rows_prune_the_scan(spark, shared):
    spark.range(10).select(F.lit(T0).alias("event_time"), "id").write.parquet(shared)
    df = recent(spark.read.parquet(shared), F.lit("2026-01-01 12:00:00").cast("timestamp"))
    assert df.count() == 10
    assert "GreaterThan(event_time" in df._jdf.queryExecution().executedPlan().toString()


def test_tracks_with_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id long, extra string")
    b = spark.createDataFrame([(2,)], "id long")
    rows = union_tracks({"a": a, "b": b}).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, "x", "a"), (2, None, "b")]


def test_percentiles_of_many_values_are_exact(spark):
    """More values than a sketch holds, a group without a name and a missing value."""
    from eventlake.plans.operations import runtime_comparison

    rnd = random.Random(6)
    values = {g: [rnd.randrange(10**9) for _ in range(30_000)] for g in ("a", None)}
    rows = [(g, v, T0 + timedelta(seconds=v % 600)) for g, vs in values.items() for v in vs] + [("a", None, T0), ("b", None, T0)]
    df = spark.createDataFrame(rows, "runtime string, end_to_end_latency_ms long, event_time timestamp").repartition(7)
    got = {r["runtime"]: r for r in metrics.exact_latency(df, "runtime", "end_to_end_latency_ms").collect()}
    for g, vs in values.items():
        vs = sorted(vs)
        assert (got[g].p50_ms, got[g].p95_ms, got[g].p99_ms, got[g].max_ms) == (vs[14_999], vs[28_499], vs[29_699], vs[-1])
    assert {g: r.events for g, r in got.items()} == {"a": 30_001, None: 30_000, "b": 1} and got["b"].p50_ms is None
    report = {r["runtime"]: r.p99_ms for r in runtime_comparison(df).collect()}
    assert report["a"] == sorted(values["a"])[29_699]


def test_rollup_of_large_windows_is_exact(spark, shared, monkeypatch):
    from eventlake.queries import operations

    rnd = random.Random(7)
    rows = [(i, T0 + timedelta(seconds=rnd.randrange(7200)), "t", rnd.randrange(10**8)) for i in range(20_000)]
    df = spark.createDataFrame(rows, "event_id long, event_time timestamp, runtime string, end_to_end_latency_ms long")
    monkeypatch.setattr(operations, "_runs", lambda *_: df)
    day = operations.latency_rollup(spark, "").where("level = '1 day'").first()
    vs = sorted(r[3] for r in rows)
    assert (day.events, day.min_ms, day.p50_ms, day.p95_ms, day.p99_ms, day.max_ms) == (
        20_000, vs[0], vs[9_999], vs[18_999], vs[19_799], vs[-1])
