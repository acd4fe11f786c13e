"""The operators as streaming queries over the same tables, drained and read back.

Each run writes to a fresh folder below ``spark.checkpoint.dir``. Windows and
sessions that the watermark has not closed yet are not part of append output.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from eventlake.operators import joins, windows
from eventlake.operators.anomaly import windowed_alerts
from eventlake.operators.joins import enrich, with_margin
from eventlake.operators.metrics import PLATFORM_ALARMS
from eventlake.plans import activity, orders
from eventlake.queries import feeds
from eventlake.queries.activity import _SCORED, _alert_columns, _dedup_sql, _pairs_sql, _sessions_sql
from eventlake.queries.activity import SQL as BATCH_SQL
from eventlake.queries.feeds import CLICKS, LATE_VERSIONS, LINES, TXNS, plain_times
from eventlake.queries.operations import SQL as OPERATIONS_SQL
from eventlake.queries.orders import _MARGIN
from eventlake.queries.orders import SQL as ORDER_SQL
from eventlake.session import prepare, shared_dir
from eventlake.sinks.base import (
    ParkingSink, PartitionSink, once_per_token, parked_batches, rejected_rows, replay_parked,
)
from eventlake.sinks.columnar import ColumnarSink, newest_version
from eventlake.sinks.folding import file_count, fold_batches, read_folded
from eventlake.sinks.lake import LakeSink
from eventlake.streaming import alarms as alarms_now
from eventlake.streaming import lateness, retractions, trailing
from eventlake.streaming.dedup import first_per_window_stream
from eventlake.streaming.progress import ProgressListener
from eventlake.streaming.runs import batch_table, drain, start_query


def _drain(df, name, output_mode="append"):
    base = shared_dir(df.sparkSession, name)
    return drain(df, f"{base}/out", f"{base}/checkpoint", output_mode)


def _clicks(spark, sf_dir):
    return activity.clicks(feeds.click_messages(spark, sf_dir, stream=True))


def tumbling_stream(spark, sf_dir):
    rows = windows.tumbling_window(
        _clicks(spark, sf_dir), "event_time", "1 hour", ["country"],
        [("*", "count", "rows"), ("page_load_ms", "sum", "load_sum")],
    )
    return plain_times(_drain(rows, "tumbling").drop("batch_id"))


def sliding_update_stream(spark, sf_dir):
    """Update mode into an append-only store; readers take the newest version per key."""
    rows = _drain(activity.page_views(_clicks(spark, sf_dir)), "sliding", "update")
    newest = newest_version(rows, ["window_start", "country", "device_type"])
    return plain_times(
        newest.drop("batch_id").withColumn("avg_page_load_ms", F.round("avg_page_load_ms", 6))
    )


def session_stream(spark, sf_dir):
    rows = activity.user_sessions(_clicks(spark, sf_dir))
    return plain_times(_drain(rows, "sessions").drop("batch_id"))


def interval_join_stream(spark, sf_dir):
    base = feeds.topic_table(spark, sf_dir, "events", stream=True)
    base = base.withColumn("ts", feeds.utc("ts")).select("event_id", "user_id", "event_type", "ts")
    left = base.where("event_type = 'purchase'").drop("event_type")
    right = base.where("event_type = 'click'").drop("event_type")
    pairs = joins.interval_join(left, right, "user_id", "ts", "ts", "12 hours")
    rows = _drain(pairs.select("event_id", "user_id", "ts", "r_event_id", "r_ts"), "pairs")
    return plain_times(rows.drop("batch_id"))


def asof_stream(spark, sf_dir):
    """Orders with the product version of their time; the versions are a stream too and come far behind the orders."""
    raw, versions = feeds.lines_and_late_versions(spark, sf_dir)
    joined = orders.versioned_orders(raw, versions, tick="1 hour", salts=2)
    rows = _drain(joined.select("raw_offset", "order_id", "product_id", "product_name", "unit_cost",
                                F.round("margin_amount", 2).alias("margin_amount"), "event_date"), "asof")
    return rows.drop("batch_id")


def zscore_alerts_stream(spark, sf_dir):
    """Alerts against the last window the watermark has closed."""
    txns = activity.transactions(feeds.txn_messages(spark, sf_dir, stream=True))
    rows = windowed_alerts(txns, size="24 hours", slide="1 hour")
    return _alert_columns(_drain(rows, "alerts"))


def trailing_stats_stream(spark, sf_dir):
    """The exact trailing statistics of every transaction, over several micro-batches."""
    txns = activity.transactions(feeds.txn_messages(spark, sf_dir, stream=True))
    rows = _drain(trailing.trailing_stats_stream(txns, "merchant", "amount", "event_time", "2 hours"), "trailing")
    return rows.select(
        "txn_id", F.round(F.col("avg_amount") + 1e-9, 6).alias("avg_amount"),
        F.round("std_amount", 6).alias("std_amount"), "txn_count",
    )


def margin_by_brand_stream(spark, sf_dir):
    """Margins that follow updates, deletes and truncates of several tables; every fifth update arrives after what came later."""
    base = shared_dir(prepare(spark), "retractions")
    log = feeds.order_log(spark, sf_dir)
    stale = (F.col("source_lsn") % 8 == 1) & (F.col("source_lsn") % 40 < 8)
    arrival = F.col("event_time") + F.when(stale, F.make_interval(days=F.lit(400))).otherwise(F.make_interval())
    arriving = feeds.sliced_stream(log, arrival)
    rows = retractions.retractions(arriving, ["order_id"], ["source_lsn", "raw_offset"], buckets=64)
    enriched = with_margin(enrich(rows, feeds.products(spark, sf_dir), "product_id", ["brand", "unit_cost"]))
    sums = {"revenue": F.col("total_amount").cast("decimal(18,2)"), "margin": F.round("margin_amount", 2).cast("decimal(18,2)")}
    callback = retractions.weighted_sums(f"{base}/sums", ["brand"], sums)
    start_query(enriched, callback, f"{base}/checkpoint", output_mode="update").awaitTermination()
    total = retractions.totals(spark.read.parquet(f"{base}/sums"), ["brand"])
    return total.select("brand", F.col("rows").alias("orders"), F.col("revenue").cast("double").alias("revenue"),
                        F.col("margin").cast("double").alias("margin"))


def dedup_stream(spark, sf_dir):
    """Exact first row per key and window from the stateful processor."""
    base = feeds.topic_table(spark, sf_dir, "events", stream=True)
    rows = base.select("event_id", feeds.utc("ts").alias("ts"), "user_id", "event_type", "value")
    kept = first_per_window_stream(rows, "user_id", "ts", "12 hours", "24 hours", ["event_id"])
    return plain_times(_drain(kept, "dedup").drop("batch_id"))


def late_stream(spark, sf_dir):
    """The audit of a stream in which every seventh event arrives five days after its time.

    A user counts once in 12 hours. Per verdict the number of rows and of
    events: kept, repeated and late make up the input.
    """
    base = shared_dir(prepare(spark), "audit")
    events = feeds.table(spark, sf_dir, "events")
    delay = F.expr("make_interval(0, 0, 0, CASE WHEN event_id % 7 = 0 THEN 5 ELSE 0 END)")
    arriving = feeds.sliced_stream(events, feeds.utc("ts") + delay)
    rows = arriving.select("event_id", "user_id", feeds.utc("ts").alias("ts"))
    for query in activity.run_dedup_audit(
        rows, f"{base}/kept", f"{base}/audit", f"{base}/checkpoint", "12 hours", "6 hours", None,
        key="user_id", time_col="ts", tie_cols=["event_id"],
    ):
        query.awaitTermination()
    on_time, late = (spark.read.parquet(f"{base}/audit/{n}") for n in ("on_time", "late"))
    kept = spark.read.parquet(f"{base}/kept")
    repeated = on_time.join(kept, "event_id", "left_anti")
    parts = [("kept", kept), ("repeated", repeated), ("late", late)]
    counts = [df.agg(F.lit(name).alias("verdict"), F.count(F.lit(1)).alias("rows"),
                     F.countDistinct("event_id").alias("events"), F.sum("event_id").alias("id_sum"))
              for name, df in parts]
    return counts[0].union(counts[1]).union(counts[2])


def sink_tolerance_stream(spark, sf_dir):
    """A store that refuses some rows: written, failed and parked rows of every micro-batch."""
    base = shared_dir(prepare(spark), "tolerance")
    events = feeds.topic_table(spark, sf_dir, "events", stream=True)
    sink = PartitionSink("store", _picky_store, max_failure_fraction=0.5, metrics_path=f"{base}/metrics")
    rows = events.select("event_id", "event_type")
    start_query(rows, sink.foreach_batch(), f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/metrics").select(
        "sink_name", F.col("batch_id").cast("long"), "records_written", "records_failed", "records_parked")


def _picky_store():
    return lambda rows: [row["event_id"] % 10 != 0 for row in rows]


def _strict_store():
    """Refuses some rows with a reason, and finds no store for others."""
    def store(rows):
        if any(row["event_id"] % 7 == 3 for row in rows):
            raise ConnectionError("no route to the store")
        return ["too old" if row["event_id"] % 10 == 0 else True for row in rows]

    return store


def sink_rejects_stream(spark, sf_dir):
    """Refused and parked rows as rows, and what a replay of the parked ones stores: by batch, reason and status."""
    base = shared_dir(prepare(spark), "rejects")
    events = feeds.topic_table(spark, sf_dir, "events", stream=True)
    rows = events.select("event_id", "event_type")
    sink = PartitionSink("store", _strict_store, rows_per_call=1, rejects_path=f"{base}/rejects", max_failure_fraction=0.5,
                         metrics_path=f"{base}/metrics")
    start_query(rows, ParkingSink(sink, f"{base}/parked").foreach_batch(), f"{base}/checkpoint").awaitTermination()
    again = PartitionSink("store", _picky_store, max_failure_fraction=0.5, rejects_path=f"{base}/rejects")
    replayed = spark.createDataFrame(
        [(o.batch_id, o.records_written) for o in replay_parked(spark, f"{base}/parked", rows.schema, again)], "batch_id long, n long")
    lost = rejected_rows(spark, f"{base}/rejects", rows.schema).unionByName(
        rejected_rows(spark, f"{base}/rejects-replayed", rows.schema).withColumn("status", F.lit("refused later")))
    found = lost.groupBy("batch_id", "status", "reason").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("id_sum"))
    written = spark.read.parquet(f"{base}/metrics").select("batch_id", F.lit("stored").alias("status"), F.col("records_written").alias("n"))
    written = written.union(replayed.select("batch_id", F.lit("stored later"), "n")).select(
        "batch_id", "status", F.lit(None).cast("string").alias("reason"), F.col("n").alias("rows"), F.lit(None).cast("long").alias("id_sum"))
    return found.union(written).withColumn("batch_id", F.col("batch_id").cast("long"))


def compacted_lake(spark, sf_dir):
    """A lake of 40 micro-batches folded in three goes, with a crash between the steps and the newest batch written again."""
    base = shared_dir(prepare(spark), "folding")
    path = f"{base}/lake"
    events = feeds.events(spark, sf_dir).select("event_id", "event_type", "ts", F.pmod("event_id", F.lit(40)).alias("turn")).persist()
    sink = LakeSink("lake", path=path, time_col="ts", unit="month")
    schema = events.drop("turn").schema.add("event_date", "date")
    try:
        for number in range(40):
            sink.write(events.where(F.col("turn") == number).drop("turn"), number)
            if number in (15, 29):
                fold_batches(spark, path, schema, until=1 if number == 15 else 2)  # the next fold takes it up
            elif number == 16:
                fold_batches(spark, path, schema)
        sink.write(events.where("turn = 39").drop("turn"), 39)
        fold_batches(spark, path, schema)
    finally:
        events.unpersist()
    rows = read_folded(spark, path, schema)
    months = rows.agg(F.countDistinct("event_date")).first()[0]
    counts = rows.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("batch_id").alias("batches"), F.sum("event_id").alias("id_sum"))
    # Three folds and the newest batch: at most four files for each month that are not large.
    return counts.withColumn("few_files", F.lit(file_count(spark, path) <= 4 * months))


def alarm_stream(spark, sf_dir):
    """The platform's alarms while points arrive: every run that has ended."""
    alarms = [replace(a, period="1 hour") for a in PLATFORM_ALARMS]
    rows = _drain(alarms_now.alarm_stream(feeds.metric_points(spark, sf_dir, stream=True), alarms), "alarms")
    ended = rows.where("state = 'OK'").drop("batch_id", "state")
    return plain_times(ended.withColumn("worst_value", F.round("worst_value", 6)))


def watermark_advice(spark, sf_dir):
    """Delays that leave half, a tenth and a hundredth of the rows late, from counts of four micro-batches."""
    base = shared_dir(prepare(spark), "lateness")
    delay = F.expr("make_interval(0, 0, 0, CASE WHEN event_id % 7 = 0 THEN event_id % 5 ELSE 0 END)")
    arriving = feeds.sliced_stream(feeds.events(spark, sf_dir), F.col("ts") + delay)
    measured = lateness.LatenessHistogram(base, "ts")
    start_query(arriving, measured, f"{base}/checkpoint").awaitTermination()
    return lateness.watermark_advice(measured.histogram(spark), [0.5, 0.1, 0.01, 0.001])


def dq_counts_stream(spark, sf_dir):
    """Violations of every quality rule as the silver stage counted them, batch by batch, stored and summed."""
    base = shared_dir(prepare(spark), "counts")
    raw = feeds.line_changes(spark, sf_dir, stream=True, consume=True)
    listener = ProgressListener()
    spark.streams.addListener(listener)
    try:
        queries = orders.run_stages(spark, raw, feeds.products(spark, sf_dir), base, gold_partition=("category",))
        listener.wait_for(queries)
    finally:
        spark.streams.removeListener(listener)
    listener.flush(spark, f"{base}/progress")
    rules = spark.read.parquet(f"{base}/progress-rules")
    return rules.groupBy("rule").agg((F.sum("rows") - F.sum("failed")).alias("passed"), F.sum("failed").alias("failed"))


def _unreachable_store():
    def store(rows):
        raise ConnectionError("no route to the store")

    return store


def parking_replay_stream(spark, sf_dir):
    """Micro-batches parked while the store is down, replayed once when it is back."""
    base = shared_dir(prepare(spark), "parking")
    events = feeds.topic_table(spark, sf_dir, "events", stream=True)
    rows = events.select("event_id", "event_type")
    down = ParkingSink(PartitionSink("store", _unreachable_store), f"{base}/parked")
    start_query(rows, down.foreach_batch(), f"{base}/checkpoint").awaitTermination()
    store = ColumnarSink("store", path=f"{base}/store")
    for _ in range(2):  # the second time nothing is left to replay
        replay_parked(spark, f"{base}/parked", rows.schema, store)
    left = parked_batches(spark, f"{base}/parked", rows.schema).count()
    return spark.read.parquet(f"{base}/store").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("event_id").alias("events")
    ).withColumn("still_parked", F.lit(left).cast("long"))


def orders_fanout_stream(spark, sf_dir):
    """Enriched orders to a lake and an OLAP table from one shared plan; margins from the lake."""
    base = _fanned_out(spark, sf_dir)
    return orders.margin_by_brand(spark.read.parquet(f"{base}/lake"))


def olap_stream(spark, sf_dir):
    """The OLAP copy of the same job."""
    base = _fanned_out(spark, sf_dir)
    return orders.margin_by_brand(spark.read.parquet(f"{base}/olap"))


def orders_dead_letters_stream(spark, sf_dir):
    """What the same job sets aside, with the reason."""
    rows = spark.read.parquet(f"{_fanned_out(spark, sf_dir)}/dead_letters")
    return rows.select("raw_partition", "raw_offset", "reject_reason")


def _fanned_out(spark, sf_dir):
    base = shared_dir(prepare(spark), "orders")
    # Years of orders in one go: monthly folders, not one per day.
    sinks = [
        LakeSink("cold", path=f"{base}/lake", unit="month"),
        ColumnarSink("olap", path=f"{base}/olap"),
    ]
    raw = feeds.line_changes(spark, sf_dir, stream=True)
    for query in orders.run_enrichment(
        raw, feeds.products(spark, sf_dir), sinks, f"{base}/checkpoint", None, shared=True,
        dead_letter_path=f"{base}/dead_letters",
    ):
        query.awaitTermination()
    return base


def medallion_stream(spark, sf_dir):
    """Bronze, silver and gold as chained streaming tables."""
    base = shared_dir(prepare(spark), "stages")
    raw = feeds.line_changes(spark, sf_dir, stream=True, consume=True)
    orders.run_stages(
        spark, raw, feeds.products(spark, sf_dir), base, gold_partition=("category",)
    )
    last = spark.read.parquet(f"{base}/gold")
    return last.groupBy("event_date", "category").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("qty").alias("qty"),
        F.sum(F.round("margin_amount", 2).cast("decimal(18,2)")).cast("double").alias("margin"),
    )


def exactly_once_replay(spark, sf_dir):
    """The same input written again after its checkpoint is lost, in other batches.

    The table then holds rows twice; readers take one for each token.
    """
    base = shared_dir(prepare(spark), "replay")
    for attempt, slices in (("first", 1), ("second", 2)):
        txns = activity.transactions(
            feeds.txn_messages(spark, sf_dir, stream=True, slices_per_trigger=slices))
        named = txns.withColumn("event_id", F.col("txn_id"))
        start_query(named, batch_table(f"{base}/out"), f"{base}/{attempt}").awaitTermination()
    rows = once_per_token(spark.read.parquet(f"{base}/out"))
    return rows.groupBy("merchant").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("txn_id").alias("txns")
    )


QUERIES = {
    f.__name__: f for f in (
        tumbling_stream, sliding_update_stream, session_stream, interval_join_stream,
        asof_stream, zscore_alerts_stream, trailing_stats_stream, margin_by_brand_stream, dedup_stream, late_stream, sink_tolerance_stream,
        sink_rejects_stream, dq_counts_stream, compacted_lake, alarm_stream,
        watermark_advice,
        parking_replay_stream, orders_fanout_stream, olap_stream, orders_dead_letters_stream,
        medallion_stream, exactly_once_replay,
    )
}

_SLICED = """ends AS (SELECT min(epoch_us(ts)) AS low, max(epoch_us(ts)) AS high FROM events),
sliced AS (SELECT events.*, CAST(least(3, (epoch_us(ts) - low) * 4 // (high - low + 1)) AS BIGINT) AS batch
  FROM events, ends)"""

SQL = {
    "tumbling_stream": f"""WITH {CLICKS}, w AS (
  SELECT time_bucket(INTERVAL 1 HOUR, event_time) AS window_start,
    time_bucket(INTERVAL 1 HOUR, event_time) + INTERVAL 1 HOUR AS window_end, country,
    count(*) AS rows, CAST(sum(page_load_ms) AS BIGINT) AS load_sum FROM clicks GROUP BY ALL)
SELECT * FROM w WHERE window_end <= (SELECT max(event_time) - INTERVAL 10 MINUTE FROM clicks)""",
    "sliding_update_stream": BATCH_SQL["sliding_counts"],
    "session_stream": f"""SELECT * FROM (
{_sessions_sql("user_id", "count(page_url) AS page_view_count")}
) WHERE session_end <= (SELECT max(ts) - INTERVAL 30 MINUTE FROM events WHERE event_id % 97 <> 0)""",
    "interval_join_stream": _pairs_sql("INNER"),
    # A row comes out once both watermarks have passed its hour.
    "asof_stream": f"""WITH {LINES}, {LATE_VERSIONS}, passed AS (
  SELECT least((SELECT max(epoch_us(event_time)) FROM good) - 10000000,
    (SELECT max(epoch_us(updated_at)) FROM versions) - 3600000000) AS us)
SELECT f.pos AS raw_offset, order_id, f.product_id, v.product_name, v.unit_cost,
  {_MARGIN} AS margin_amount, CAST(order_ts AS DATE) AS event_date
FROM flat f ASOF LEFT JOIN versions v ON f.product_id = v.product_id AND f.event_time >= v.updated_at
WHERE (epoch_us(f.event_time) // 3600000000 + 1) * 3600000000 <= (SELECT us FROM passed)""",
    "zscore_alerts_stream": f"""WITH {TXNS}, spread AS (
  SELECT user_id, amount, time_bucket(INTERVAL 1 HOUR, event_time) + to_hours(k + 1) AS window_end
  FROM txns, range(24) AS r(k)),
stats AS (SELECT user_id, window_end, avg(amount) AS avg_amount, stddev_samp(amount) AS std_amount,
  count(*) AS txn_count FROM spread GROUP BY ALL
  HAVING window_end <= (SELECT max(event_time) - INTERVAL 5 MINUTE FROM txns)),
scored AS (SELECT t.*, avg_amount, std_amount, txn_count FROM txns t JOIN stats s
  ON t.user_id = s.user_id AND t.event_time > s.window_end
  AND t.event_time <= s.window_end + INTERVAL 1 HOUR)
{_SCORED}""",
    # Every row that the watermark has passed.
    "trailing_stats_stream": f"""SELECT * FROM ({BATCH_SQL["trailing_stats"]})
WHERE txn_id IN (SELECT CAST(event_id AS VARCHAR) FROM events WHERE ts <= (SELECT max(ts) - INTERVAL 5 MINUTE FROM events))""",
    "margin_by_brand_stream": f"""WITH {feeds.HISTORY}, {feeds.PRODUCTS}, cleared AS (
  SELECT priority, (max(lsn) // 16) * 8 + 7 AS upto FROM history
  WHERE substring(priority, 1, 1) IN ('2', '4') GROUP BY priority),
left_over AS (SELECT h.* FROM history h LEFT JOIN cleared c USING (priority) WHERE c.upto IS NULL OR h.lsn > c.upto),
latest AS (SELECT * FROM left_over QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY lsn DESC) = 1)
SELECT brand, count(*) AS orders, CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
  CAST(sum(CAST({_MARGIN} AS DECIMAL(18,2))) AS DOUBLE) AS margin
FROM latest LEFT JOIN products USING (product_id) WHERE op <> 'd' GROUP BY brand""",
    "dedup_stream": _dedup_sql("e.event_id, e.ts, e.user_id, e.event_type, e.value", "user_id", 12),
    "late_stream": """WITH RECURSIVE e AS (
  SELECT event_id, user_id, ts, epoch_us(ts) + CASE WHEN event_id % 7 = 0 THEN 5 * 86400000000 ELSE 0 END AS arrival
  FROM events),
ends AS (SELECT min(arrival) AS low, max(arrival) AS high FROM e),
s AS (SELECT e.*, least(3, (arrival - low) * 4 // (high - low + 1)) AS batch FROM e, ends),
tops AS (SELECT batch, max(ts) AS top FROM s GROUP BY batch),
seen AS (SELECT batch, max(top) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest
  FROM tops),
judged AS (SELECT event_id, user_id, epoch_us(ts) AS us,
    coalesce(ts < latest - INTERVAL 6 HOUR, false) AS late FROM s JOIN seen USING (batch)),
ready AS (SELECT * FROM judged WHERE NOT late),
-- The on-time rows are drained in one go, so a kept row is followed by the next in time that lies 12 hours later.
kept AS (
  SELECT user_id, min(us) AS us FROM ready GROUP BY user_id
  UNION ALL
  SELECT k.user_id, (SELECT min(r.us) FROM ready r WHERE r.user_id = k.user_id AND r.us >= k.us + 12 * 3600000000)
  FROM kept k WHERE us IS NOT NULL),
first AS (SELECT r.user_id, r.us, min(event_id) AS event_id FROM ready r JOIN kept k ON k.user_id = r.user_id AND k.us = r.us GROUP BY ALL),
verdicts AS (
  SELECT j.*, CASE WHEN late THEN 'late' WHEN f.event_id IS NOT NULL THEN 'kept' ELSE 'repeated' END AS verdict
  FROM judged j LEFT JOIN first f ON f.event_id = j.event_id)
SELECT verdict, count(*) AS rows, count(DISTINCT event_id) AS events, CAST(sum(event_id) AS BIGINT) AS id_sum
FROM verdicts GROUP BY verdict""",
    "sink_tolerance_stream": f"""WITH {_SLICED}
SELECT 'store' AS sink_name, batch AS batch_id, count(*) FILTER (event_id % 10 <> 0) AS records_written,
  count(*) FILTER (event_id % 10 = 0) AS records_failed, CAST(0 AS BIGINT) AS records_parked
FROM sliced GROUP BY batch""",
    "sink_rejects_stream": f"""WITH {_SLICED}, judged AS (
  SELECT batch AS batch_id, event_id, CASE WHEN event_id % 7 = 3 THEN 'unreachable' WHEN event_id % 10 = 0 THEN 'refused' ELSE 'stored' END AS status
  FROM sliced),
verdicts AS (
  SELECT batch_id, status, CASE status WHEN 'refused' THEN 'too old' WHEN 'unreachable' THEN 'ConnectionError: no route to the store' END AS reason, event_id
  FROM judged
  UNION ALL SELECT batch_id, CASE WHEN event_id % 10 = 0 THEN 'refused later' ELSE 'stored later' END,
    CASE WHEN event_id % 10 = 0 THEN 'refused' END, event_id FROM judged WHERE status = 'unreachable')
SELECT batch_id, status, reason, count(*) AS rows,
  CASE WHEN status NOT IN ('stored', 'stored later') THEN CAST(sum(event_id) AS BIGINT) END AS id_sum FROM verdicts GROUP BY batch_id, status, reason""",
    "compacted_lake": """SELECT CAST(date_trunc('month', ts) AS DATE) AS event_date, count(*) AS rows,
  count(DISTINCT event_id % 40) AS batches, CAST(sum(event_id) AS BIGINT) AS id_sum, true AS few_files FROM events GROUP BY 1""",
    # Runs over closed periods, ended by a closed period that does not breach.
    "alarm_stream": f"""WITH closed AS (SELECT max(ts) - INTERVAL 1 MINUTE AS reached FROM events),
runs AS ({OPERATIONS_SQL["alarm_eval"].replace("'d' || (user_id % 5) AS dimension, value, ts FROM events)",
    "'d' || (user_id % 5) AS dimension, value, ts FROM events WHERE time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= (SELECT reached FROM closed))")})
SELECT * FROM runs WHERE breach_end + INTERVAL 1 HOUR <= (SELECT reached FROM closed)""",
    # The bucket of a lateness has its leading bit and the three bits after it.
    "watermark_advice": """WITH e AS (
  SELECT ts, epoch_us(ts) + CASE WHEN event_id % 7 = 0 THEN (event_id % 5) * 86400000000 ELSE 0 END AS arrival FROM events),
ends AS (SELECT min(arrival) AS low, max(arrival) AS high FROM e),
s AS (SELECT epoch_us(ts) AS us, least(3, (arrival - low) * 4 // (high - low + 1)) AS batch FROM e, ends),
tops AS (SELECT batch, max(us) AS top FROM s GROUP BY batch),
seen AS (SELECT batch, max(top) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest FROM tops),
late AS (SELECT CAST(greatest(coalesce(latest - us, 0), 0) AS BIGINT) AS x FROM s JOIN seen USING (batch)),
ended AS (SELECT CASE WHEN x < 8 THEN x ELSE ((x >> (length(bin(x)) - 4)) + 1) * CAST(2 ** (length(bin(x)) - 4) AS BIGINT) - 1 END AS delay_us FROM late),
counts AS (SELECT delay_us, count(*) AS n FROM ended GROUP BY delay_us),
ranked AS (SELECT delay_us, CAST(sum(n) OVER (ORDER BY delay_us DESC) - n AS BIGINT) AS late_rows, sum(n) OVER () AS total FROM counts)
SELECT share, min(delay_us) AS delay_us, arg_min(late_rows, delay_us) AS late_rows
FROM ranked, (SELECT unnest([CAST(0.5 AS DOUBLE), 0.1, 0.01, 0.001]) AS share) WHERE late_rows <= share * total GROUP BY share""",
    "dq_counts_stream": f"SELECT rule, passed, failed FROM ({ORDER_SQL['dq_report']})",
    "parking_replay_stream": """SELECT event_type, count(*) AS rows, count(DISTINCT event_id) AS events,
  CAST(0 AS BIGINT) AS still_parked FROM events GROUP BY event_type""",
    "olap_stream": ORDER_SQL["broadcast_enrich_margin"],
    "orders_dead_letters_stream": f"""WITH {LINES}
SELECT part AS raw_partition, pos AS raw_offset,
  CASE defect WHEN 2 THEN 'unknown_op' ELSE 'malformed' END AS reject_reason
FROM lines WHERE defect IN (1, 2, 3)""",
    "orders_fanout_stream": ORDER_SQL["broadcast_enrich_margin"],
    "medallion_stream": ORDER_SQL["medallion_gold"],
    "exactly_once_replay": """SELECT event_type AS merchant, count(*) AS rows,
  count(DISTINCT event_id) AS txns FROM events GROUP BY event_type""",
}
