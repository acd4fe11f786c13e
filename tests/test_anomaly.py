from __future__ import annotations

import random
import statistics
from datetime import datetime, timedelta

import pytest

from eventlake.operators import anomaly

T0 = datetime(2026, 1, 1)
SCHEMA = "txn_id long, user_id string, amount double, event_time timestamp"


def txns(n=1500, users=4, span=40_000, seed=5):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        user = "hot" if i % 3 == 0 else f"u{rnd.randrange(users)}"
        amount = round(rnd.expovariate(0.02), 2) if i % 40 else None
        # Whole seconds make equal times and exact frame borders frequent.
        out.append((i, user, amount, T0 + timedelta(seconds=rnd.randrange(span) // 30 * 30)))
    return out


def brute(rows, frame):
    out = {}
    for i, user, _, at in rows:
        frame_rows = [a for _, u, a, t in rows if u == user and at - frame <= t < at]
        known = [a for a in frame_rows if a is not None]
        out[i] = (
            round(statistics.fmean(known), 6) if known else None,
            round(statistics.stdev(known), 6) if len(known) > 1 else None, len(frame_rows))
    return out


@pytest.mark.parametrize("cells", [1, 12])
def test_trailing_stats_equal_brute_force(spark, cells):
    rows = txns()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = anomaly.trailing_stats(df, "user_id", "amount", "event_time", "1 hour", cells=cells)
    assert got.columns == [*df.columns, "avg_amount", "std_amount", "txn_count"]
    result = {
        r.txn_id: (None if r.avg_amount is None else round(r.avg_amount, 6),
                   None if r.std_amount is None else round(r.std_amount, 6), r.txn_count)
        for r in got.collect()}
    assert result == brute(rows, timedelta(hours=1))


def history(amounts, last, step=60):
    rows = [(i, "u", a, T0 + timedelta(seconds=i * step)) for i, a in enumerate(amounts)]
    return [*rows, (99, "u", last, T0 + timedelta(seconds=len(amounts) * step))]


@pytest.mark.parametrize("amounts,last,alerts", [
    ([10.0, 10.1, 10.2, 9.9, 9.8], 99.0, 1),
    ([10.0, 10.1, 10.2, 9.9], 99.0, 0),            # too little history
    ([0.1] * 50, 99.0, 0),                          # no spread: deviation is exactly zero
    ([10.0, 10.1, 10.2, 9.9, 9.8], -99.0, 1),       # both sides
    ([10.0, 10.1, 10.2, 9.9, 9.8], 10.2, 0),
])
def test_guards(spark, amounts, last, alerts):
    df = spark.createDataFrame(history(amounts, last), SCHEMA)
    out = anomaly.trailing_alerts(df).collect()
    assert len(out) == alerts
    if alerts:
        assert out[0].user_targets == ["u", "ops-team"] and out[0].severity == "WARNING"


def test_windowed_scores_use_the_last_closed_window(spark):
    df = spark.createDataFrame(history([10.0, 11.0, 12.0], 50.0, 400), SCHEMA)
    # t = 1200 s lies in (900, 1200]: its window ends at 900 s and holds 0, 400 and 800 s.
    row = anomaly.windowed_scores(df).where("txn_id = 99").first()
    assert row.window_end == T0 + timedelta(seconds=900)
    assert (row.avg_amount, row.txn_count) == (11.0, 3)


def test_windowed_scores_equal_all_windows(spark):
    """Hot users, rows exactly on window borders, and rows without an amount."""
    df = spark.createDataFrame(txns(900, span=20_000), SCHEMA).repartition(4)
    got = anomaly.windowed_scores(df, size="30 minutes", slide="5 minutes")
    stats = anomaly.windowed_stats(df, "user_id", "amount", "event_time", "30 minutes", "5 minutes")
    s = stats.drop("stats_time").withColumnRenamed("user_id", "u")
    at, end = df["event_time"], s["window_end"]
    want = df.join(s, (df["user_id"] == s["u"]) & (at > end)
                   & (at <= end + timedelta(minutes=5))).drop("u")
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_odd_frames(spark):
    """Frames that are no whole number of cells, and windows that are no whole number of slides."""
    df = spark.createDataFrame(history([1.0, 2.0, 4.0, 3.0], 1.0), SCHEMA)
    plain = anomaly.trailing_stats(df, "user_id", "amount", "event_time", "10 minutes", cells=1)
    odd = anomaly.trailing_stats(df, "user_id", "amount", "event_time", "10 minutes", cells=7)
    assert sorted(map(str, odd.collect())) == sorted(map(str, plain.collect()))
    assert anomaly.windowed_scores(df, size="7 minutes", slide="2 minutes").columns
