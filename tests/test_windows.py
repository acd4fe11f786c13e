from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventlake.functions.aggregates import aggregations
from eventlake.functions.durations import micros
from eventlake.operators import windows

T0 = datetime(2026, 4, 22, 10)


def rows(spark, *minutes, user="u1"):
    data = [(user, T0 + timedelta(minutes=m), int(m)) for m in minutes]
    return spark.createDataFrame(data, "user_id string, event_time timestamp, load long")


def hot(spark, n=6000):
    """A third of all rows on one user, bursts and silences included."""
    rnd = random.Random(7)
    data = []
    for i in range(n):
        user = "hot" if i % 3 == 0 else f"u{rnd.randrange(40)}"
        at = T0 + timedelta(seconds=rnd.randrange(5) * 40_000 + rnd.randrange(20_000))
        data.append((user, at, rnd.randrange(1000) if i % 7 else None))
    return spark.createDataFrame(data, "user_id string, event_time timestamp, load long")


def test_tumbling(spark):
    out = windows.tumbling_window(rows(spark, 0, 2, 6), "event_time", "5 minutes", ["user_id"],
                                  {"*": "count"}).orderBy("window_start")
    assert out.columns == ["window_start", "window_end", "user_id", "*_count"]
    assert [r["*_count"] for r in out.collect()] == [2, 1]


def test_sliding_covers_each_row_size_over_slide_times(spark):
    out = windows.sliding_window(rows(spark, 0), "event_time", "5 minutes", "1 minute",
                                 ["user_id"], {"load": "sum"})
    assert out.columns == ["window_start", "window_end", "user_id", "load_sum"]
    assert out.count() == 5
    df = hot(spark)
    total = windows.sliding_window(df, "event_time", "1 hour", "10 minutes", ["user_id"],
                                   [("*", "count", "n")]).agg(F.sum("n")).first()[0]
    assert total == df.count() * 6


def test_sliding_that_does_not_divide(spark):
    df = hot(spark, 300)
    out = windows.sliding_window(df, "event_time", "7 minutes", "3 minutes", ["user_id"],
                                 [("*", "count", "n")])
    want = df.groupBy(F.window("event_time", "7 minutes", "3 minutes"), "user_id").count()
    assert sorted(r.n for r in out.collect()) == sorted(r["count"] for r in want.collect())


def test_session_gap_is_inclusive(spark):
    def sessions(*minutes):
        out = windows.with_session_seconds(windows.session_window(
            rows(spark, *minutes), "event_time", "30 minutes", ["user_id"], {"load": "count"}))
        return [(r.load_count, r.session_duration_sec) for r in out.orderBy("session_start").collect()]

    assert sessions(0, 30) == [(2, 3600)]
    assert sessions(0, 30 + 1 / 60) == [(1, 1800), (1, 1800)]
    assert sessions(5) == [(1, 1800)]


@pytest.mark.parametrize("gap", ["10 seconds", "30 minutes", "4 hours"])
def test_sessions_equal_the_built_in_operator(spark, gap):
    df = hot(spark)
    spec = [("*", "count", "n"), ("load", "avg", "a"), ("load", "max", "hi"), ("load", "sum", "s")]
    got = windows.session_window(df, "event_time", gap, ["user_id"], spec)
    want = df.groupBy(F.session_window("event_time", gap).alias("w"), "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.avg("load").alias("a"), F.max("load").alias("hi"),
        F.sum("load").alias("s"),
    ).select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"),
             "user_id", "n", "a", "hi", "s")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_only_cells_reach_the_ordered_step(spark):
    """The per-user ordering must sit above a partial aggregation."""
    out = windows.session_window(hot(spark), "event_time", "30 minutes", ["user_id"], {"load": "sum"})
    plan = out._jdf.queryExecution().executedPlan().toString()
    window_at, partial_at = plan.index("+- Window"), plan.rindex("partial_min")
    assert window_at < partial_at


def test_hop_takes_slide_first(spark):
    df = rows(spark, 0, 2, 6)
    hop = windows.hop_window(df, "event_time", "1 minute", "5 minutes", [], {"*": "count"})
    slide = windows.sliding_window(df, "event_time", "5 minutes", "1 minute", [], {"*": "count"})
    assert hop.exceptAll(slide).count() == 0


def test_aggregations():
    with pytest.raises(ValueError, match="Unsupported aggregation"):
        aggregations({"load": "percentile_99"})
    with pytest.raises(ValueError):
        aggregations({"*": "sum"})
    assert [a.alias for a in aggregations({"load": "AVG", "*": "count"})] == ["load_avg", "*_count"]


def test_durations():
    assert micros("1 hour 30 minutes") == 5_400_000_000
    for bad in ("soon", "5", "5 fortnights"):
        with pytest.raises(ValueError):
            micros(bad)
