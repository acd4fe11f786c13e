"""OLAP store: whole-batch appends and newest version per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.operators.changes import latest_changes
from eventlake.sinks.base import Sink, overwrite_partitions, write_counted


def newest_version(df: DataFrame, keys: list[str], version: str = "batch_id") -> DataFrame:
    """What readers of an append-only store see: the row with the highest version per key."""
    return latest_changes(df, keys, [version])


class ColumnarSink(Sink):
    """Append of a whole batch, all or nothing.

    Files: one ``batch_id`` partition per micro-batch, replaced on replay. JDBC:
    the batch id travels as the version column, and ``newest_version`` (or a
    replacing table engine) removes what a replay repeats.
    """

    def __init__(self, name: str, path: str | None = None, jdbc: dict | None = None, **kwargs):
        super().__init__(name, **kwargs)
        if bool(path) == bool(jdbc):
            raise ValueError("give either path or jdbc")
        self.path, self.jdbc = path, jdbc

    def write(self, batch: DataFrame, batch_id: int) -> tuple[int, int]:
        versioned = batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
        if self.path:
            return write_counted(
                versioned, lambda df: overwrite_partitions(df, self.path, ["batch_id"])
            ), 0
        return write_counted(
            versioned,
            lambda df: df.write.format("jdbc").options(**self.jdbc).mode("append").save(),
        ), 0
