"""Clicks and transactions: window counts, sessions, alerts, deduplication audit."""

from __future__ import annotations

from pyspark.sql import DataFrame

from eventlake.functions.envelope import decode_json
from eventlake.operators.anomaly import trailing_alerts, windowed_alerts
from eventlake.operators.windows import session_window, sliding_window, with_session_seconds
from eventlake.schemas import CLICK_SCHEMA, TXN_SCHEMA
from eventlake.sinks.base import Sink
from eventlake.streaming.dedup import LateSplit, first_per_window_stream
from eventlake.streaming.runs import TRIGGERS, batch_table, start_query


def clicks(broker_rows: DataFrame) -> DataFrame:
    return decode_json(broker_rows, CLICK_SCHEMA)


def transactions(broker_rows: DataFrame) -> DataFrame:
    return decode_json(broker_rows, TXN_SCHEMA)


def page_views(
    click_rows: DataFrame, size: str = "5 minutes", slide: str = "1 minute",
    watermark: str = "10 minutes",
) -> DataFrame:
    """Rolling page views and mean load time per country and device."""
    return sliding_window(
        click_rows, "event_time", size, slide, ["country", "device_type"],
        [("*", "count", "page_view_count"), ("page_load_ms", "avg", "avg_page_load_ms")],
        watermark,
    )


def user_sessions(
    click_rows: DataFrame, gap: str = "30 minutes", watermark: str = "30 minutes"
) -> DataFrame:
    """Sessions per user with page count and length."""
    sessions = session_window(
        click_rows, "event_time", gap, ["user_id"],
        [("page_url", "count", "page_view_count")], watermark,
    )
    return with_session_seconds(sessions)


def run_clickstream(
    broker_rows: DataFrame, windows_sink: Sink, sessions_sink: Sink, checkpoint: str,
    triggered: bool = True,
):
    """Window counts in update mode (newest version wins in the store), sessions in append."""
    rows = clicks(broker_rows)
    pace = TRIGGERS if triggered else {"windows": None, "sessions": None}
    return [
        start_query(page_views(rows), windows_sink.foreach_batch(), f"{checkpoint}/windows",
                    pace["windows"], "update"),
        start_query(user_sessions(rows), sessions_sink.foreach_batch(), f"{checkpoint}/sessions",
                    pace["sessions"], "append"),
    ]


def alerts(txns: DataFrame, frame: str = "1 hour", slide: str = "5 minutes") -> DataFrame:
    """Alerts on a table (own trailing frame) or a stream (last closed window)."""
    if txns.isStreaming:
        return windowed_alerts(txns, size=frame, slide=slide)
    return trailing_alerts(txns, frame=frame)


def run_alerting(broker_rows: DataFrame, sink: Sink, checkpoint: str,
                 trigger: str | None = TRIGGERS["alerts"]):
    rows = alerts(transactions(broker_rows))
    return start_query(rows, sink.foreach_batch(), f"{checkpoint}/alerts", trigger)


def run_dedup_audit(
    txns: DataFrame, kept_path: str, late_base: str, checkpoint: str,
    window: str = "1 hour", allowed: str = "1 hour",
    trigger: str | None = TRIGGERS["alerts"], key: str = "txn_id", time_col: str = "event_time",
    tie_cols: list[str] | None = None,
) -> list:
    """Each key once per window; rows beyond the allowed lateness go to the audit table.

    Two queries: the first deals rows to ``late_base/on_time`` and
    ``late_base/late``, the second keeps the first on-time rows. Every row of the
    input is kept, repeated or late. Without a trigger the first one drains
    before the second starts.
    """
    spark = txns.sparkSession
    split = LateSplit(spark, late_base, txns.schema, key, time_col, allowed)
    first = start_query(txns, split, f"{checkpoint}/late", trigger)
    if trigger is None:
        first.awaitTermination()
    rows = first_per_window_stream(split.read_on_time(spark), key, time_col, window, allowed, tie_cols)
    return [first, start_query(rows, batch_table(kept_path), f"{checkpoint}/dedup", trigger)]
