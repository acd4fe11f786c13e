from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventlake.operators import joins

T0 = datetime(2026, 1, 1)


def times(spark, data, names="k string, t timestamp, id long"):
    return spark.createDataFrame(data, names)


def skewed(rnd, n, tag):
    return [
        ("hot" if i % 3 == 0 else f"k{rnd.randrange(20)}",
         T0 + timedelta(minutes=rnd.randrange(3000)) if i % 50 else None, i + tag)
        for i in range(n)
    ]


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "left_semi", "left_anti",
                                 "left_outer", "full_outer"])
def test_interval_join_equals_the_plain_condition(spark, how):
    rnd = random.Random(1)
    left, right = times(spark, skewed(rnd, 600, 0)), times(spark, skewed(rnd, 600, 10_000))
    got = joins.interval_join(left, right, "k", "t", "t", "1 hour", how)
    plain = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns])
    on = (F.col("k") == F.col("r_k")) & (F.col("t") >= F.col("r_t")) & (
        F.col("t") <= F.col("r_t") + F.expr("INTERVAL 1 HOUR"))
    want = left.join(plain, on, how)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_interval_join_bounds(spark):
    left = times(spark, [("a", T0 + timedelta(hours=1), 1), ("a", T0, 2),
                         ("a", T0 + timedelta(hours=1, microseconds=1), 3)])
    right = times(spark, [("a", T0, 9)])
    assert sorted(r.id for r in joins.interval_join(left, right, "k", "t", "t").collect()) == [1, 2]


def test_unknown_join_type(spark):
    df = times(spark, [("a", T0, 1)])
    with pytest.raises(ValueError):
        joins.interval_join(df, df, "k", "t", "t", how="cross")


def test_enrich_leaves_the_strategy_to_the_optimizer(spark):
    facts = spark.range(100).withColumn("k", F.col("id") % 10)
    dim = spark.range(8).select(F.col("id").alias("k"), F.lit("x").alias("v"), F.lit(1).alias("w"))

    def plan(df):
        return df._jdf.queryExecution().toString()

    free, hinted = joins.enrich(facts, dim, "k", ["v"]), joins.enrich(facts, dim.hint("merge"), "k", ["v"])
    assert "broadcast" not in free._jdf.queryExecution().optimizedPlan().toString()
    assert "SortMergeJoin" in plan(hinted)
    assert free.columns == ["k", "id", "v"]
    assert free.exceptAll(hinted).count() == 0
    assert free.where("v is null").count() == 20
    assert joins.enrich(facts, dim, "k", ["v"], "inner").count() == 80


def test_margin_and_key_checks(spark):
    facts = spark.createDataFrame([("p1", 10.0, 2), ("p2", 10.0, 2)], "k string, total_amount double, qty long")
    dim = spark.createDataFrame([("p1", 3.0), ("p3", 1.0), ("p3", 2.0)], "k string, unit_cost double")
    rows = joins.with_margin(joins.enrich(facts, dim, "k", ["unit_cost"])).orderBy("k")
    assert [r.margin_amount for r in rows.collect()] == [4.0, None]
    assert [tuple(r) for r in joins.unmatched_keys(facts, dim, "k").collect()] == [("p2", 1)]
    assert [tuple(r) for r in joins.duplicate_keys(dim, "k").collect()] == [("p3", 2)]


@pytest.mark.parametrize("few_versions", [True, False])
def test_asof_boundaries(spark, few_versions):
    versions = spark.createDataFrame(
        [("a", T0, 1), ("a", T0 + timedelta(days=1), 2), ("a", T0 + timedelta(days=9, hours=5), 3),
         (None, T0, 4), ("a", None, 5), (None, None, 6)],
        "k string, updated timestamp, v long")
    facts = times(spark, [
        ("a", T0 - timedelta(microseconds=1), 1), ("a", T0, 2), ("a", T0 + timedelta(hours=23), 3),
        ("a", T0 + timedelta(days=1), 4), ("a", T0 + timedelta(days=9), 5),
        ("a", T0 + timedelta(days=9, hours=5), 6), ("b", T0, 7), ("a", None, 8), (None, T0, 9), (None, None, 10),
    ])
    out = joins.asof_join(facts, versions, "k", "t", "updated", ["v"], few_versions)
    assert out.columns == ["k", "t", "id", "v"]
    assert {r.id: r.v for r in out.collect()} == {
        1: None, 2: 1, 3: 1, 4: 2, 5: 2, 6: 3, 7: None, 8: None, 9: None, 10: None}


def test_asof_routes_agree_on_hot_keys(spark):
    rnd = random.Random(3)
    facts = times(spark, skewed(rnd, 3000, 0))
    seen = set()
    versions = []
    for i in range(900):
        key, at = "hot" if i % 3 else f"k{rnd.randrange(20)}", T0 + timedelta(minutes=rnd.randrange(3000))
        if (key, at) not in seen:
            seen.add((key, at))
            versions.append((key, at, i))
    versions = spark.createDataFrame(versions, "k string, updated timestamp, v long")
    spans = joins.asof_join(facts, versions, "k", "t", "updated", ["v"], few_versions=True)
    merged = joins.asof_join(facts, versions, "k", "t", "updated", ["v"], chunk="3 hours")
    assert spans.exceptAll(merged).count() == 0 and merged.exceptAll(spans).count() == 0


@pytest.mark.parametrize("chunk", ["1 hour", "1 day", "900 days"])
def test_version_intervals(spark, chunk):
    rnd = random.Random(8)
    rows = {("hot" if i % 3 else f"k{i % 5}", T0 + timedelta(minutes=rnd.randrange(9000))) for i in range(700)}
    df = spark.createDataFrame(sorted(rows), "k string, updated timestamp").repartition(3)
    got = {(r.k, r.updated): r.valid_to for r in joins.version_intervals(df, "k", "updated", chunk).collect()}
    want = {}
    for key, at in rows:
        later = [t for k, t in rows if k == key and t > at]
        want[key, at] = min(later) if later else None
    assert got == want


def test_refresh_dimension(spark):
    dim = spark.createDataFrame([(1, T0), (2, T0 + timedelta(days=1))], "k long, _loaded_at timestamp")
    assert joins.refresh_dimension(dim).count() == 2
    assert joins.refresh_dimension(dim, F.lit(T0)).count() == 1
