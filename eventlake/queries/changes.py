"""State folded from order histories."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlake.functions import envelope as env
from eventlake.operators import changes as ops
from eventlake.queries import feeds
from eventlake.queries.feeds import HISTORY, plain_times
from eventlake.schemas import ORDER_SCHEMA

POSITION = ["source_lsn", "raw_offset"]


def _decoded(spark, sf_dir, table_col=None):
    rows = env.decode_changes(feeds.order_changes(spark, sf_dir, table_col), ORDER_SCHEMA)
    return rows.withColumn("order_id", ops.key_image("order_id"))


def cdc_latest_state(spark, sf_dir):
    state = ops.latest_state(_decoded(spark, sf_dir), ["order_id"], POSITION)
    return plain_times(state.select(
        "order_id", "cdc_op", "event_time", "source_lsn", F.col("after.qty").alias("qty"),
        F.col("after.total_amount").alias("total_amount"),
    ))


def cdc_truncate(spark, sf_dir):
    """Several tables in one log, some of them cleared along the way."""
    changes = feeds.decoded_once(_decoded(spark, sf_dir, F.col("o_orderpriority")), "source_table", "order_id",
                                 "source_lsn", "raw_offset", "event_time", "cdc_op")
    log = changes.unionByName(feeds.truncates(changes).drop("event_time"), allowMissingColumns=True)
    state = ops.latest_state_with_truncate(log, "source_table", ["order_id"], POSITION)
    return state.select("source_table", "order_id", "source_lsn", "cdc_op")


def cdc_merge_guarded(spark, sf_dir):
    """First versions, then three batches: later changes, stale ones also after deletes, the rest.

    Every third order comes from a source without log positions.
    """
    cols = ["order_id", "source_lsn", "raw_offset", "cdc_op", "total_amount"]
    unknown = F.substring("order_id", 3, 20).cast("long") % 3 == 0
    changes = _decoded(spark, sf_dir).select(
        "order_id", F.when(~unknown, F.col("source_lsn")).alias("source_lsn"), "raw_offset",
        "cdc_op", F.col("after.total_amount").alias("total_amount"),
    )
    seq = F.col("raw_offset") % 8
    first = (seq == 0) & (F.col("cdc_op") == "c")
    # Updates delivered once more, behind the deletes that followed them.
    stale = changes.where(seq == 1).withColumn("total_amount", F.lit(-1.0))
    state = changes.where(first)
    for batch in (changes.where((seq.isin(0, 1, 2)) & ~first), stale, changes.where(seq == 3)):
        state = ops.merge_guarded(state, batch.select(cols), ["order_id"])
    return ops.live_rows(state).select(cols)


def cdc_diff(spark, sf_dir):
    rows = ops.column_diff(_decoded(spark, sf_dir), ORDER_SCHEMA)
    return rows.select(
        "order_id", "source_lsn", F.array_join("changed", ",").alias("changed"),
        F.round(F.col("after.total_amount") - F.col("before.total_amount"), 2).alias("added"),
    )


def cdc_op_stats(spark, sf_dir):
    rows = env.decode_changes(feeds.order_changes(spark, sf_dir), ORDER_SCHEMA, images=())
    return plain_times(ops.op_stats(rows))


def snapshot_then_changes(spark, sf_dir):
    """Customers' first orders as a snapshot, then the live changes; current rows per currency."""
    changes = env.decode_changes(feeds.order_changes(spark, sf_dir), ORDER_SCHEMA)
    orders = feeds.table(spark, sf_dir, "orders")
    table = orders.select(
        F.concat(F.lit("O-"), "o_orderkey").alias("order_id"),
        F.concat(F.lit("C-"), "o_custkey").alias("customer_id"),
        F.concat(F.lit("P-"), F.col("o_orderkey") % 200).alias("product_id"),
        F.lit(1).alias("qty"), F.col("o_totalprice").alias("total_amount"),
        F.lit("OLD").alias("currency"), feeds.utc("o_orderdate").alias("order_ts"), "o_orderkey",
    )
    snapshot = ops.snapshot_as_changes(
        table, ORDER_SCHEMA, F.col("order_ts"), F.col("o_orderkey") * 8
    ).withColumn("raw_offset", F.lit(-1).cast("long"))
    live = changes.where(F.col("source_lsn") % 8 > 0).drop("event_id", "kafka_ts")
    feed = ops.snapshot_then_changes(snapshot, live)
    feed = feed.withColumn("order_id", ops.key_image("order_id"))
    state = ops.latest_state(feed, ["order_id"], POSITION)
    return state.groupBy(F.col("after.currency").alias("currency"), "cdc_op").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("after.qty").alias("qty"),
    )


QUERIES = {
    f.__name__: f for f in (
        cdc_latest_state, cdc_truncate, cdc_merge_guarded, cdc_diff, cdc_op_stats,
        snapshot_then_changes,
    )
}

_NEWEST = "row_number() OVER (PARTITION BY order_id ORDER BY lsn DESC)"

SQL = {
    "cdc_latest_state": f"""WITH {HISTORY}, ranked AS (SELECT *, {_NEWEST} AS rn FROM history)
SELECT order_id, op AS cdc_op, event_time, lsn AS source_lsn, qty, total_amount
FROM ranked WHERE rn = 1 AND op <> 'd'""",
    "cdc_truncate": f"""WITH {HISTORY}, cleared AS (
  SELECT priority, (max(lsn) // 16) * 8 + 7 AS upto FROM history
  WHERE substring(priority, 1, 1) IN ('2', '4') GROUP BY priority),
left_over AS (SELECT h.* FROM history h LEFT JOIN cleared c USING (priority)
  WHERE c.upto IS NULL OR h.lsn > c.upto),
ranked AS (SELECT *, {_NEWEST} AS rn FROM left_over)
SELECT priority AS source_table, order_id, lsn AS source_lsn, op AS cdc_op
FROM ranked WHERE rn = 1 AND op <> 'd'""",
    "cdc_merge_guarded": f"""WITH {HISTORY}, ranked AS (SELECT *, {_NEWEST} AS rn FROM history)
SELECT order_id, CASE WHEN CAST(substring(order_id, 3) AS BIGINT) % 3 <> 0 THEN lsn END AS source_lsn,
  lsn AS raw_offset, op AS cdc_op, total_amount
FROM ranked WHERE rn = 1 AND op <> 'd'""",
    "cdc_diff": f"""WITH {HISTORY}
SELECT order_id, lsn AS source_lsn, 'total_amount' AS changed,
  CAST(10.5 AS DOUBLE) AS added FROM history WHERE op = 'u'""",
    "cdc_op_stats": f"""WITH {HISTORY}
SELECT 'orders' AS source_table, date_trunc('minute', event_time) AS minute,
  count(*) FILTER (op = 'c') AS creates, count(*) FILTER (op = 'u') AS updates,
  count(*) FILTER (op = 'd') AS deletes, count(*) FILTER (op = 'r') AS snapshots,
  count(*) FILTER (op = 't') AS truncates
FROM history GROUP BY ALL""",
    "snapshot_then_changes": f"""WITH {HISTORY}, ranked AS (SELECT *, {_NEWEST} AS rn FROM history)
SELECT CASE seq WHEN 0 THEN 'OLD' ELSE currency END AS currency,
  CASE seq WHEN 0 THEN 'r' ELSE op END AS cdc_op, count(*) AS orders,
  CAST(sum(CASE seq WHEN 0 THEN 1 ELSE qty END) AS BIGINT) AS qty
FROM ranked WHERE rn = 1 AND op <> 'd' GROUP BY ALL""",
}
