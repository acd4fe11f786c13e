"""Starting queries: one per sink, shared fan-out, table writers, bounded runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventlake.session import stream_settings
from eventlake.sinks.base import Sink, fan_out, overwrite_partitions

# Trigger intervals of the jobs.
TRIGGERS = {"orders": "5 seconds", "alerts": "10 seconds", "windows": "30 seconds",
            "sessions": "1 minute"}


def start_query(
    df: DataFrame, callback, checkpoint: str, trigger: str | None = None,
    output_mode: str = "append", name: str | None = None,
) -> StreamingQuery:
    """``foreachBatch`` query; without a trigger it drains what is there and ends."""
    writer = df.writeStream.foreachBatch(callback).outputMode(output_mode)
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    when = {"processingTime": trigger} if trigger else {"availableNow": True}
    with stream_settings(df.sparkSession):
        return writer.trigger(**when).start()


def start_per_sink(
    df: DataFrame, sinks: list[Sink], checkpoint: str, trigger: str | None = TRIGGERS["orders"],
    output_mode: str = "append",
) -> list[StreamingQuery]:
    """One query and checkpoint per sink: a slow sink does not hold up the others."""
    return [
        start_query(df, s.foreach_batch(), f"{checkpoint}/{s.name}", trigger, output_mode)
        for s in sinks
    ]


def start_shared(
    df: DataFrame, sinks: list[Sink], checkpoint: str, trigger: str | None = TRIGGERS["orders"],
    output_mode: str = "append",
) -> StreamingQuery:
    """One query for all sinks: the source is read and the plan computed once."""
    return start_query(df, fan_out(sinks), f"{checkpoint}/shared", trigger, output_mode)


def start_table(
    df: DataFrame, target: str, checkpoint: str, partition_by: tuple[str, ...] = (),
    trigger: str | None = TRIGGERS["orders"], fmt: str = "parquet",
) -> StreamingQuery:
    """Streaming table writer, by path or by catalog name.

    A partitioned table of files is written batch by batch, with the rows of a
    micro-batch gathered by partition and the batch id as the last partition.
    """
    if partition_by and "/" in target:
        callback = batch_table(target, partition_by)
        return start_query(df, callback, checkpoint, trigger)
    writer = df.writeStream.format(fmt).outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(**({"processingTime": trigger} if trigger else {"availableNow": True}))
    with stream_settings(df.sparkSession):
        return writer.start(target) if "/" in target else writer.toTable(target)


def batch_table(path: str, partition_by: tuple[str, ...] = ()):
    """Callback storing each micro-batch as its own partitions; a replay replaces them."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
        overwrite_partitions(numbered, path, [*partition_by, "batch_id"])

    return on_batch


def drain(df: DataFrame, path: str, checkpoint: str, output_mode: str = "append") -> DataFrame:
    """Run a stream over all available input and return what it wrote, as a table.

    The result is an ordinary table in the shared folder, so it survives the
    loss of executors.
    """
    schema = df.schema
    query = start_query(df, batch_table(path), checkpoint, output_mode=output_mode)
    query.awaitTermination()
    spark = df.sparkSession
    return spark.read.schema(schema.add("batch_id", "long")).parquet(path)
