"""Reports over finished runs, and the raw archive of all change topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.envelope import lag_ms
from eventlake.operators.metrics import cost_per_million, exact_latency, throughput_per_minute
from eventlake.sinks.lake import ArchiveSink
from eventlake.sources.broker import matching_topics
from eventlake.sources.tables import recent, union_tracks
from eventlake.streaming.runs import start_query

# Hourly cost and average events per second of the published tracks.
TRACK_COSTS = (("emr_on_eks", 0.44, 8500.0), ("databricks", 0.71, 9200.0),
               ("flink", 0.44, 11000.0))


def all_runs(
    tracks: dict[str, DataFrame], now: Column | None = None, commit_col: str = "_commit_time",
    whole_seconds: bool = False,
) -> DataFrame:
    """Rows of all tracks with their end-to-end latency, optionally the last 24 hours only."""
    rows = union_tracks(
        {name: df if now is None else recent(df, now) for name, df in tracks.items()}
    )
    latency = lag_ms(F.col("event_time"), F.col(commit_col), whole_seconds)
    return rows.withColumn("end_to_end_latency_ms", latency)


def runtime_comparison(runs: DataFrame) -> DataFrame:
    """Exact latency figures and mean events per active minute for each track."""
    latency = exact_latency(runs, "runtime", "end_to_end_latency_ms")
    minutes = (
        runs.groupBy("runtime", F.date_trunc("minute", "event_time").alias("minute"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("runtime")
        .agg(F.count(F.lit(1)).alias("active_minutes"), F.max("n").alias("peak_per_minute"))
    )
    return latency.join(minutes, "runtime").orderBy("p99_ms", "runtime")


def throughput_report(runs: DataFrame) -> DataFrame:
    return throughput_per_minute(runs, "runtime", "event_time").orderBy("runtime", "minute")


def cost_report(throughput: DataFrame, costs: DataFrame) -> DataFrame:
    """Cost per million events; ``costs`` has runtime and cost_per_hour."""
    return throughput.join(costs, "runtime").withColumn(
        "cost_per_million", cost_per_million(F.col("cost_per_hour"), F.col("events_per_second"))
    )


def run_raw_archive(
    broker_rows: DataFrame, path: str, dead_letter_path: str, checkpoint: str,
    trigger: str | None = "10 minutes", pattern: str = r"^cdc\..*",
):
    """Every change topic as hourly files; unreadable messages go to the dead letters."""
    ts_ms = F.get_json_object(F.col("value").cast("string"), "$.ts_ms").try_cast("long")
    sink = ArchiveSink("raw-archive", path, dead_letter_path, ts_ms)
    return start_query(
        matching_topics(broker_rows, pattern), sink.foreach_batch(), f"{checkpoint}/archive", trigger
    )
