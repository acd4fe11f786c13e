"""Start a job: ``spark-submit … -m eventlake <job>`` or ``python -m eventlake <job>``.

Input is a broker (``--bootstrap-servers``) or stored topic files (``--input``).
With ``--once`` a job drains what is there and ends.
"""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import DataFrame, SparkSession

from eventlake.plans import activity, operations, orders
from eventlake.session import build_session, ship_package
from eventlake.sinks.broadcast import BroadcastSink
from eventlake.sinks.columnar import ColumnarSink
from eventlake.sources.broker import (
    ARCHIVE_PER_TRIGGER, CLICKS_PER_TRIGGER, IAM_OPTIONS, ORDERS_PER_TRIGGER,
    TXNS_PER_TRIGGER, BrokerSource, file_stream,
)
from eventlake.sources.tables import read_table
from eventlake.streaming.progress import ProgressListener
from eventlake.streaming.runs import TRIGGERS

# Topics the jobs read, and their rate limits.
TOPICS = {
    "orders": ("cdc.public.orders", ORDERS_PER_TRIGGER),
    "versioned-orders": ("cdc.public.orders", ORDERS_PER_TRIGGER),
    "stages": ("cdc.public.orders", ORDERS_PER_TRIGGER),
    "clickstream": ("app.clickstream", CLICKS_PER_TRIGGER),
    "alerting": ("app.transactions", TXNS_PER_TRIGGER),
    "dedup": ("app.transactions", TXNS_PER_TRIGGER),
    "archive": (None, ARCHIVE_PER_TRIGGER),
}
FLUSH_SECONDS = 60


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="eventlake", description=__doc__)
    out.add_argument("job", choices=sorted(TOPICS))
    source = out.add_mutually_exclusive_group(required=True)
    source.add_argument("--bootstrap-servers")
    source.add_argument("--input", help="folder of broker-shaped parquet files")
    out.add_argument("--checkpoint", required=True)
    out.add_argument("--output", required=True, help="base folder of the file destinations")
    out.add_argument("--products", help="dimension: path or table")
    out.add_argument("--products-format", default="parquet")
    out.add_argument("--hot-client", help="module:function opening the hot store")
    out.add_argument("--search-client", help="module:function opening the search store")
    out.add_argument("--starting-offsets", default="latest")
    out.add_argument("--no-iam", action="store_true")
    out.add_argument("--once", action="store_true")
    return out


def _named(spec: str | None):
    if spec is None:
        return None
    module, name = spec.split(":")
    return getattr(importlib.import_module(module), name)


def read_topic(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    topic, limit = TOPICS[args.job]
    if args.input:
        return file_stream(spark, args.input)
    which = {"topics": (topic,)} if topic else {"topic_pattern": r"^cdc\..*"}
    return BrokerSource(
        args.bootstrap_servers, **which, starting_offsets=args.starting_offsets,
        max_offsets_per_trigger=limit, iam=not args.no_iam,
    ).read_stream(spark)


def _alert_sink(args: argparse.Namespace) -> BroadcastSink:
    if args.input:
        return BroadcastSink("alerts", {"path": f"{args.output}/alerts"}, fmt="parquet")
    options = {"kafka.bootstrap.servers": args.bootstrap_servers}
    return BroadcastSink("alerts", {**options, **({} if args.no_iam else IAM_OPTIONS)})


def start(spark: SparkSession, args: argparse.Namespace) -> list:
    """The running queries of the chosen job."""
    raw, cp, base = read_topic(spark, args), args.checkpoint, args.output

    def pace(name: str) -> str | None:
        return None if args.once else TRIGGERS[name]

    if args.job in ("orders", "versioned-orders", "stages"):
        products = read_table(spark, args.products, args.products_format)
        hot, search = _named(args.hot_client), _named(args.search_client)
        if args.job == "stages":
            return orders.run_stages(spark, raw, products, base, pace("orders"))
        if args.job == "versioned-orders":
            return orders.run_versioned(raw, products, search, f"{base}/lake", cp, pace("orders"),
                                        f"{base}/dead_letters")
        sinks = orders.order_sinks(hot, search, f"{base}/lake", f"{base}/metrics")
        return orders.run_enrichment(raw, products, sinks, cp, pace("orders"),
                                     dead_letter_path=f"{base}/dead_letters")
    if args.job == "clickstream":
        return activity.run_clickstream(
            raw, ColumnarSink("country-windows", path=f"{base}/country_page_views_5min"),
            ColumnarSink("sessions", path=f"{base}/user_sessions"), cp, not args.once)
    if args.job == "alerting":
        return [activity.run_alerting(raw, _alert_sink(args), cp, pace("alerts"))]
    if args.job == "dedup":
        return activity.run_dedup_audit(
            activity.transactions(raw), f"{base}/kept", f"{base}/audit", cp, trigger=pace("alerts"))
    return [operations.run_raw_archive(
        raw, f"{base}/archive", f"{base}/dead_letters", cp, None if args.once else "10 minutes")]


def main(argv: list[str] | None = None) -> None:
    """Runs a job; the figures of its micro-batches go to ``<output>/progress`` once a minute."""
    args = parser().parse_args(argv)
    spark = build_session(f"eventlake-{args.job}")
    ship_package(spark)
    listener, progress = ProgressListener(), f"{args.output}/progress"
    spark.streams.addListener(listener)
    try:
        queries = start(spark, args)
        if args.once:
            for query in queries:
                query.awaitTermination()
            listener.wait_for(queries)
        else:
            while not spark.streams.awaitAnyTermination(FLUSH_SECONDS):
                listener.flush(spark, progress)
    finally:
        spark.streams.removeListener(listener)
        listener.flush(spark, progress)


if __name__ == "__main__":
    main()
