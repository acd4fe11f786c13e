"""Headline timings. Prints one JSON line.

Messages are written once, untimed, as stored topics; each timed query reads
them as a job reads its broker. ``*_stream`` queries drain the same input as a
stream. The best of two runs counts, as a streaming job runs warm.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from eventlake.functions.envelope import decode_changes, upserts  # noqa: E402
from eventlake.operators import anomaly, changes, dedup, joins, metrics, windows  # noqa: E402
from eventlake.plans import activity, operations, orders  # noqa: E402
from eventlake.queries import feeds  # noqa: E402
from eventlake.schemas import ORDER_SCHEMA  # noqa: E402
from eventlake.session import build_session, shared_dir  # noqa: E402
from eventlake.sources.broker import file_stream  # noqa: E402
from eventlake.streaming.runs import start_query  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
# Published events per second of the slowest track, for the same kinds of work.
PUBLISHED = {"filter": 45_000, "broadcast_join": 8_500, "interval_join_stream": 3_000,
             "window_1h_stream": 6_000}


def session():
    return build_session("eventlake-bench", f"local[{CPUS}]", {
        "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false",
        "spark.driver.memory": "16g",
    })


def stored_topics(spark) -> dict[str, str]:
    base = shared_dir(spark, "topics")
    sources = {
        "lines": feeds.line_changes(spark, SF_DIR), "orders": feeds.order_changes(spark, SF_DIR),
        "clicks": feeds.click_messages(spark, SF_DIR), "txns": feeds.txn_messages(spark, SF_DIR),
    }
    for name, df in sources.items():  # dealt by message key, as a topic is
        df.repartition(int(CPUS), "key").write.parquet(f"{base}/{name}")
    return {name: f"{base}/{name}" for name in sources}


def workloads(spark, topics):
    def batch(name):
        return spark.read.parquet(topics[name])

    def stream(name):
        return file_stream(spark, topics[name])

    products = feeds.products(spark, SF_DIR)
    versions = feeds.product_versions(spark, SF_DIR)

    def hourly(rows):
        return windows.tumbling_window(rows, "event_time", "1 hour", ["country", "device_type"], [
            ("*", "count", "n"), ("page_load_ms", "avg", "load")])

    def pairs(txns):
        left = txns.where("merchant = 'purchase'").select("user_id", "event_time", "txn_id")
        right = txns.where("merchant = 'click'").select("user_id", "event_time", "txn_id")
        return joins.interval_join(left, right, "user_id", "event_time", "event_time")

    def decoded(name):
        return decode_changes(batch(name), ORDER_SCHEMA)

    def txns():
        return activity.transactions(batch("txns"))

    def keyed(rows):
        return rows.withColumn("order_id", changes.key_image("order_id"))

    return {
        "filter": ("lines", lambda: upserts(decoded("lines"))),
        "broadcast_join": ("lines", lambda: orders.enriched_orders(batch("lines"), products)),
        "shuffled_join": ("lines", lambda: joins.enrich(
            orders.order_rows(batch("lines")), products.hint("merge"), "product_id", orders.DIM_COLS)),
        "asof_join": ("lines", lambda: orders.versioned_orders(
            batch("lines"), versions, few_versions=True)),
        "asof_join_chunked": ("lines", lambda: orders.versioned_orders(
            batch("lines"), versions)),
        "latest_state": ("orders", lambda: changes.latest_state(
            keyed(decoded("orders")), ["order_id"], ["source_lsn", "raw_offset"])),
        "window_1h": ("clicks", lambda: hourly(activity.clicks(batch("clicks")))),
        "sliding_5m_1m": ("clicks", lambda: activity.page_views(activity.clicks(batch("clicks")))),
        "sessions": ("clicks", lambda: activity.user_sessions(activity.clicks(batch("clicks")))),
        "interval_join": ("txns", lambda: pairs(txns())),
        "zscore_trailing": ("txns", lambda: anomaly.trailing_stats(
            txns(), "user_id", "amount", "event_time", "24 hours")),
        "zscore_windowed": ("txns", lambda: anomaly.windowed_scores(
            txns(), size="24 hours", slide="1 hour")),
        "dedup": ("txns", lambda: dedup.first_per_window(
            txns(), "user_id", "event_time", "12 hours", ["txn_id"])),
        "latency_percentiles": ("txns", lambda: metrics.latency_percentiles(
            operations.all_runs(feeds.tracks(spark, SF_DIR)), "runtime", "end_to_end_latency_ms")),
        "filter_stream": ("lines", lambda: upserts(decode_changes(stream("lines"), ORDER_SCHEMA))),
        "broadcast_join_stream": ("lines", lambda: orders.enriched_orders(stream("lines"), products)),
        "window_1h_stream": ("clicks", lambda: hourly(activity.clicks(stream("clicks")))),
        "interval_join_stream": ("txns", lambda: pairs(activity.transactions(stream("txns")))),
    }


def run_once(spark, build) -> float:
    began = time.perf_counter()
    df = build()
    if df.isStreaming:
        def discard(rows, _batch_id):
            rows.write.format("noop").mode("overwrite").save()

        start_query(df, discard, shared_dir(spark, "bench")).awaitTermination()
    else:
        df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    topics = stored_topics(spark)
    sizes = {name: spark.read.parquet(path).count() for name, path in topics.items()}
    seconds, rates = {}, {}
    only = set(sys.argv[1:])
    for name, (topic, build) in workloads(spark, topics).items():
        if only and name not in only:
            continue
        seconds[name] = round(min(run_once(spark, build) for _ in range(2)), 3)
        rates[name] = int(sizes[topic] / seconds[name])
    print(json.dumps({
        "metric": "total seconds of headline queries", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(SF_DIR.rstrip("/")),
        "events_per_second": rates, "published_events_per_second": PUBLISHED,
        "cpus": int(CPUS), "topic_rows": sizes,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
