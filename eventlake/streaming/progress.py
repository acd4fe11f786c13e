"""Query progress as metric rows."""

from __future__ import annotations

import json
import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from eventlake.operators.metrics import BATCH_METRICS, as_metrics
from eventlake.sinks.base import overwrite_partitions

PROGRESS_SCHEMA = (
    "job string, batch_id long, at string, records_in long, records_out long, "
    "duration_ms long, lag_ms long, input_per_second double, processed_per_second double, "
    "dropped_by_watermark long, state_rows long"
)


def progress_row(job: str, progress: dict) -> tuple:
    """One row of figures from a progress report (its JSON as a dictionary).

    The lag is the end of the batch minus the newest event time in it.
    """
    states = progress.get("stateOperators") or []
    newest = (progress.get("eventTime") or {}).get("max")
    began = _millis(progress["timestamp"])
    duration = int(progress.get("batchDuration") or 0)
    out = (progress.get("sink") or {}).get("numOutputRows", -1)
    return (
        job, int(progress["batchId"]), progress["timestamp"], int(progress["numInputRows"]),
        int(out) if out >= 0 else None, duration,
        began + duration - _millis(newest) if newest else None,
        float(progress.get("inputRowsPerSecond") or 0.0),
        float(progress.get("processedRowsPerSecond") or 0.0),
        sum(int(s.get("numRowsDroppedByWatermark", 0)) for s in states),
        sum(int(s.get("numRowsTotal", 0)) for s in states),
    )


RULE_SCHEMA = "job string, batch_id long, at string, rule string, rows long, failed long"


def rule_rows(job: str, progress: dict, observation: str = "quality") -> list[tuple]:
    """One row for each rule that ``enforce`` counted under the name ``observation`` in a batch."""
    counts = (progress.get("observedMetrics") or {}).get(observation) or {}
    return [(job, int(progress["batchId"]), progress["timestamp"], rule, int(counts["rows"]), int(failed))
            for rule, failed in counts.items() if rule != "rows"]


def _millis(iso: str) -> int:
    return int(datetime.fromisoformat(iso.replace("Z", "+00:00")).timestamp() * 1000)


class ProgressListener(StreamingQueryListener):
    """Keeps the figures of the micro-batches seen since the last ``flush``, and the counts of quality rules.

    A few small rows per micro-batch, so the driver holds no data.
    """

    def __init__(self, observation: str = "quality"):
        self.rows: list[tuple] = []
        self.rules: list[tuple] = []
        self.observation = observation

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        report = json.loads(event.progress.json)
        job = report.get("name") or str(report["id"])
        self.rules.extend(rule_rows(job, report, self.observation))
        self.rows.append(progress_row(job, report))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def wait_for(self, queries: list, seconds: float = 10.0) -> None:
        """Waits until the reports of ended queries have arrived; they come on a thread of their own."""
        due = time.monotonic() + seconds
        last = {(q.name or str(q.id), q.lastProgress["batchId"]) for q in queries if q.lastProgress}
        while last - {row[:2] for row in self.rows} and time.monotonic() < due:
            time.sleep(0.05)

    def flush(self, spark: SparkSession, path: str) -> None:
        """Stores what has come since the last time, rules below ``path``-rules; rows whose write fails stay for the next time."""
        for kept, schema, target in ((self.rows, PROGRESS_SCHEMA, path), (self.rules, RULE_SCHEMA, f"{path.rstrip('/')}-rules")):
            n = len(kept)
            if n:
                overwrite_partitions(spark.createDataFrame(kept[:n], schema), target, ["job", "batch_id"])
                del kept[:n]


def progress_table(spark: SparkSession, job: str, reports: list[dict]) -> DataFrame:
    """Figures of ``query.recentProgress`` as a table."""
    return spark.createDataFrame([progress_row(job, r) for r in reports], PROGRESS_SCHEMA)


def committed_offsets(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(topic, partition, committed_offset) of the newest committed batch of a broker query.

    Offsets live in the query's checkpoint and not in a consumer group; with the
    topic's end offsets they give the consumer lag. The folder holds one small
    file per retained batch.
    """
    def log(name: str) -> DataFrame:
        number = F.col("_metadata.file_name").try_cast("long")
        files = spark.read.text(f"{checkpoint}/{name}", wholetext=True)
        return files.select(number.alias("batch_id"), "value")

    newest = log("commits").agg(F.max("batch_id").alias("batch_id"))
    # A log file has a version line, a settings line, and one line per source.
    lines = F.split("value", "\n")
    sources = F.filter(F.slice(lines, F.lit(3), F.greatest(F.size(lines) - 2, F.lit(0))), lambda line: line.startswith("{"))
    planned = log("offsets").join(F.broadcast(newest), "batch_id").select(
        F.explode(sources).alias("source")
    )
    topics = planned.select(
        F.explode(F.from_json("source", "map<string,map<string,bigint>>")).alias("topic", "parts")
    )
    parts = topics.select("topic", F.explode("parts").alias("partition", "committed_offset"))
    return parts.withColumn("partition", F.col("partition").cast("int"))


def batch_metrics(progress: DataFrame) -> DataFrame:
    """Metric rows per micro-batch and job: records in and out, duration, lag, batch id."""
    return as_metrics(progress, BATCH_METRICS, "JobName", "job")


def dropped_rows(progress: DataFrame) -> DataFrame:
    """Rows the stateful operators of each job dropped as too late."""
    return progress.groupBy("job").agg(F.sum("dropped_by_watermark").alias("dropped"))
