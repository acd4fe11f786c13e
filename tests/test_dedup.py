from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventlake.operators import dedup

T0 = datetime(2026, 1, 1)


def brute(rows, window):
    kept, last = set(), {}
    for key, at, i in sorted((r for r in rows if r[0] and r[1]), key=lambda r: (r[0], r[1], r[2])):
        if key not in last or at >= last[key] + window:
            last[key] = at
            kept.add(i)
    return kept


def cases():
    rnd = random.Random(11)
    yield "random", [
        ("hot" if i % 3 == 0 else f"k{rnd.randrange(300)}",
         T0 + timedelta(seconds=rnd.randrange(400_000)), i) for i in range(3000)]
    # Regular spacing: chains of different starts never meet.
    yield "regular", [("a", T0 + timedelta(minutes=7 * i), i) for i in range(2000)]
    yield "exact", [("a", T0 + timedelta(minutes=30 * i), i) for i in range(300)]
    yield "ties", [("a", T0 + timedelta(hours=i // 9), i) for i in range(200)]
    yield "sparse", [(f"k{i % 3}", T0 + timedelta(days=900 * i), i) for i in range(60)]
    yield "nulls", [(None, T0, 1), ("a", None, 2), ("a", T0, 3), ("a", T0, 4)]
    yield "before 1970", [("a", datetime(1969, 12, 30) + timedelta(minutes=11 * i), i) for i in range(900)]


@pytest.mark.parametrize("batch", [7, 10_000])
@pytest.mark.parametrize("name,rows", list(cases()), ids=[c[0] for c in cases()])
def test_first_per_window_equals_brute_force(spark, name, rows, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        df = spark.createDataFrame(rows, "k string, t timestamp, id long").repartition(4)
        for chunk in (2, 24):
            out = dedup.first_per_window(df, "k", "t", "1 hour", ["id"], windows_per_chunk=chunk)
            assert out.columns == df.columns
            got = [r.id for r in out.collect()]
            assert sorted(got) == sorted(brute(rows, timedelta(hours=1)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_all_column_types_come_back(spark):
    df = spark.createDataFrame(
        [("a", T0, 2 ** 60 + 1, [1, 2], {"x": "y"}, None)],
        "k string, t timestamp, big long, list array<int>, m map<string,string>, none int")
    assert dedup.first_per_window(df, "k", "t").collect() == df.collect()


def arrivals(n=2500):
    rnd = random.Random(2)
    return [
        (i % 3 if i % 2 else 0, i, T0 + timedelta(seconds=60 * i - rnd.choice([0, 0, 0, 2000, 9000])))
        for i in range(n)]


@pytest.mark.parametrize("chunk_rows", [10, 999, 10 ** 6])
def test_lateness_equals_a_running_maximum(spark, chunk_rows):
    rows = arrivals()
    df = spark.createDataFrame(rows, "part int, off long, t timestamp").repartition(4)
    out = dedup.with_lateness(df, "t", "part", ["off"], "1 hour", chunk_rows)
    want, top = {}, {}
    for part, off, at in rows:
        seen = top.get(part)
        want[off] = (seen, seen is not None and at < seen - timedelta(hours=1))
        top[part] = max(at, seen) if seen else at
    assert {r.off: (r.max_seen, r.is_late) for r in out.collect()} == want
    assert any(late for _, late in want.values())


def test_out_of_orderness_profile(spark):
    df = spark.createDataFrame(arrivals(), "part int, off long, t timestamp")
    rows = dedup.out_of_orderness(df, "t", "part", ["off"]).collect()
    assert len(rows) == 3
    for r in rows:
        assert 0 == r.p50_ms <= r.p95_ms <= r.p99_ms <= r.max_ms <= 9_000_000
    assert sum(r.row_count for r in rows) == df.count()


def test_repartitioning_does_not_change_the_result(spark):
    df = spark.createDataFrame(arrivals(), "part int, off long, t timestamp").withColumn(
        "k", F.col("part").cast("string"))
    one = dedup.first_per_window(df.repartition(1), "k", "t", "2 hours", ["off"])
    many = dedup.first_per_window(df.repartition(9), "k", "t", "2 hours", ["off"])
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0


def test_stretches_of_chunks_do_not_change_the_result(spark):
    """Few and many chunks, alone or composed, on random, regular and bursty keys."""
    rnd = random.Random(5)
    rows = [("r", rnd.randrange(40_000)) for _ in range(900)] + [("h", 10 * i) for i in range(900)]
    rows += [("b", 5_000 * (i // 50) + i % 50) for i in range(400)] + [("one", 7)]
    df = spark.createDataFrame([(k, T0 + timedelta(minutes=m), i) for i, (k, m) in enumerate(rows)], "k string, t timestamp, id long")
    want = []
    for key in ("r", "h", "b", "one"):
        last = None
        for m, i in sorted((m, i) for i, (k, m) in enumerate(rows) if k == key):
            if last is None or m >= last + 60:
                want.append(i)
                last = m
    for chunk, stretch in ((24, 64), (2, 3), (1, 2), (3, 1)):
        got = dedup.first_per_window(df, "k", "t", "1 hour", ["id"], chunk, stretch)
        assert sorted(r.id for r in got.collect()) == sorted(want)


def test_out_of_orderness_of_many_values_is_exact(spark):
    rnd = random.Random(5)
    top = T0 + timedelta(days=400)
    late = [rnd.randrange(10**10) for _ in range(30_000)]
    df = spark.createDataFrame([("s", 0, top)] + [("s", i + 1, top - timedelta(milliseconds=v)) for i, v in enumerate(late)],
                               "part string, off long, t timestamp").repartition(5)
    row = dedup.out_of_orderness(df, "t", "part", ["off"]).first()
    ms = sorted([0, *late])
    assert (row.row_count, row.p50_ms, row.p95_ms, row.p99_ms, row.max_ms) == (30_001, ms[15_000], ms[28_500], ms[29_700], ms[-1])
