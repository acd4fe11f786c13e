from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.operators import changes, quality
from eventlake.operators.quality import Expectation
from eventlake.queries import changes as change_queries
from eventlake.queries import feeds

LOG = "table string, id string, source_lsn long, raw_offset long, cdc_op string, v long"


def log(spark, *rows):
    return spark.createDataFrame(list(rows), LOG).repartition(3)


def state(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_update_delete_and_insert_again(spark):
    df = log(
        spark, ("t", "a", 1, 1, "c", 10), ("t", "a", 2, 2, "u", 11), ("t", "b", 3, 3, "c", 20),
        ("t", "b", 4, 4, "d", None), ("t", "c", 5, 5, "c", 30), ("t", "c", 6, 6, "d", None),
        ("t", "c", 7, 7, "c", 31),
    )
    out = changes.latest_state(df, ["id"], ["source_lsn", "raw_offset"])
    assert out.columns == df.columns
    assert state(out, "id", "v") == [("a", 11), ("c", 31)]


def test_repeated_positions_and_missing_lsn(spark):
    # The same position twice: the later offset counts. No position: offsets decide.
    df = log(
        spark, ("t", "a", 1, 1, "c", 10), ("t", "a", 1, 9, "c", 10),
        ("t", "b", None, 2, "c", 1), ("t", "b", None, 5, "u", 2),
    )
    out = changes.latest_changes(df, ["id"], ["source_lsn", "raw_offset"])
    assert state(out, "id", "raw_offset", "v") == [("a", 9, 10), ("b", 5, 2)]


def test_truncate_clears_earlier_rows_of_its_table(spark):
    df = log(
        spark, ("t", "a", 1, 1, "c", 10), ("u", "a", 2, 2, "c", 20), ("t", None, 3, 3, "t", None),
        ("t", "b", 4, 4, "c", 30), ("t", None, 2, 2, "t", None),
    )
    out = changes.latest_state_with_truncate(df, "table", ["id"], ["source_lsn", "raw_offset"])
    assert state(out, "table", "id", "v") == [("t", "b", 30), ("u", "a", 20)]


def test_stale_changes_do_not_overwrite(spark):
    names = "id string, source_lsn long, raw_offset long, v string"
    target = spark.createDataFrame([("a", 5, 1, "old"), ("b", 5, 1, "old"), ("c", 5, 1, "old")], names)
    batch = spark.createDataFrame(
        [("a", 4, 9, "stale"), ("b", 5, 1, "same"), ("c", 6, 2, "new"), ("c", 7, 3, "newer"), ("d", 1, 4, "in")],
        names)
    once = changes.merge_guarded(target, batch, ["id"])
    assert state(once, "id", "v") == [("a", "old"), ("b", "old"), ("c", "newer"), ("d", "in")]
    again = changes.merge_guarded(once, batch, ["id"])
    assert state(again, "id", "v") == state(once, "id", "v")


def test_deleted_keys_stay_deleted(spark):
    empty = spark.createDataFrame([], LOG + ", event_time timestamp")
    target = empty
    for batch in (
        [("t", "a", 10, 1, "c", 1), ("t", "n", None, 1, "c", 1)],
        [("t", "a", 30, 3, "d", None), ("t", "n", None, 2, "u", 2)],
        [("t", "a", 20, 2, "u", 9), ("t", "n", None, 1, "c", 1)],  # late and repeated
    ):
        rows = spark.createDataFrame(batch, LOG).withColumn("event_time", F.lit(datetime(2026, 1, 1)))
        target = changes.merge_guarded(target, rows, ["id"])
    assert state(changes.live_rows(target), "id", "v") == [("n", 2)]
    old, new = F.lit(datetime(2025, 1, 1)), F.lit(datetime(2026, 2, 1))
    assert changes.drop_tombstones(target, old).count() == 2
    assert state(changes.drop_tombstones(target, new), "id", "v") == [("n", 2)]


def test_merge_into_a_table_without_row_changes_is_refused(spark):
    rows = spark.createDataFrame([("t", "a", 1, 1, "c", 1)], LOG)
    rows.write.saveAsTable("merge_target")
    try:
        with pytest.raises(Exception, match="(?i)merge"):
            changes.merge_into_table(rows, "merge_target", ["id"])
    finally:
        spark.sql("DROP TABLE merge_target")


def test_folding_combines_before_the_shuffle(spark):
    out = changes.latest_changes(
        spark.range(10).select((F.col("id") % 3).alias("k"), F.col("id").alias("v")), ["k"], ["v"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("partial_max_by")


def test_column_diff_compares_nulls(spark):
    row = T.StructType([T.StructField("x", T.LongType()), T.StructField("y", T.StringType())])
    schema = T.StructType([T.StructField("cdc_op", T.StringType()),
                           T.StructField("before", row), T.StructField("after", row)])
    df = spark.createDataFrame(
        [("u", (1, None), (1, "a")), ("u", (1, None), (1, None)), ("c", None, (1, "a")),
         ("u", (1, "a"), (2, None))], schema)
    assert sorted(r.changed for r in changes.column_diff(df, row).collect()) == [[], ["x", "y"], ["y"]]


def test_additive_columns(spark):
    old = spark.createDataFrame([("a", 1)], "id string, v long")
    new = spark.createDataFrame([("a", 2, "x")], "id string, v long, extra string")
    assert changes.snapshot_then_changes(old, new).columns == ["id", "v", "extra"]


def test_op_stats(spark):
    at = datetime(2026, 1, 1, 0, 0, 30)
    df = spark.createDataFrame([("o", at, "c"), ("o", at, "c"), ("o", at, "t")],
                               "source_table string, event_time timestamp, cdc_op string")
    row = changes.op_stats(df).first()
    assert (row.minute, row.creates, row.truncates, row.deletes) == (datetime(2026, 1, 1), 2, 1, 0)


RULES = (Expectation("known", "v IS NOT NULL", drop=True), Expectation("positive", "v > 0"))


def test_expectations(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "v int")
    seen = Observation()
    assert sorted(r.v for r in quality.enforce(df, RULES, seen).collect()) == [-1, 1]
    assert seen.get == {"rows": 3, "known": 1, "positive": 2}
    rows = [tuple(r) for r in quality.report(df, RULES).collect()]
    assert rows == [("known", "drop", 2, 1), ("positive", "warn", 1, 2)]


def test_report_of_nothing(spark):
    rows = [tuple(r) for r in quality.report(spark.createDataFrame([], "v int"), RULES).collect()]
    assert rows == [("known", "drop", 0, 0), ("positive", "warn", 0, 0)]


def test_shedding_is_repeatable(spark):
    df = spark.range(20_000).withColumn("severity", F.when(F.col("id") % 10 == 0, "CRITICAL"))
    keep = F.col("severity") == "CRITICAL"
    one = quality.shed_load(df, keep, F.col("id"))
    two = quality.shed_load(df.repartition(7), keep, F.col("id"))
    assert one.exceptAll(two).count() == 0
    assert one.where(keep).count() == 2_000
    assert 100 < one.where("severity is null").count() < 280


@pytest.mark.parametrize("make", [feeds.order_log, change_queries.cdc_truncate])
def test_order_messages_are_built_once(spark, make):
    """The log and its truncates come from decoded rows; nothing that reads them goes back to the orders."""
    files = make(spark, "/root/testdata/sf0.001").inputFiles()
    assert files and not any("orders.parquet" in f for f in files)
