"""Cold lake: date-partitioned appends, and the hourly raw archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.envelope import parsed_once
from eventlake.sinks.base import Sink, overwrite_partitions, write_counted

# Layout of lake and archive files.
LAKE_CODEC = "zstd"
ARCHIVE_CODEC = "snappy"
ARCHIVE_ROWS_PER_FILE = 50_000
HOUR_FOLDERS = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}


def lake_rows(
    df: DataFrame, time_col: str = "order_ts", date_col: str = "event_date", unit: str = "day"
) -> DataFrame:
    """Rows with their partition date, derived only where it is absent.

    A coarser ``unit`` (week, month) dates rows by its first day, for history
    spread thinly over many days.
    """
    if date_col in df.columns:
        return df
    return df.withColumn(date_col, F.to_date(F.date_trunc(unit, F.col(time_col))))


class LakeSink(Sink):
    """Date-partitioned table: of a catalog or as files; a batch that runs again replaces its rows.

    A catalog table has a column ``batch_id``, and needs no folder for each batch.
    """

    def __init__(
        self, name: str, path: str | None = None, table: str | None = None,
        time_col: str = "order_ts", unit: str = "day", **kwargs,
    ):
        super().__init__(name, **kwargs)
        if bool(path) == bool(table):
            raise ValueError("give either path or table")
        self.path, self.table, self.time_col, self.unit = path, table, time_col, unit

    def write(self, batch: DataFrame, batch_id: int) -> tuple[int, int]:
        rows = lake_rows(batch, self.time_col, unit=self.unit)
        rows = rows.withColumn("batch_id", F.lit(batch_id).cast("long"))
        if self.table:
            own = F.col("batch_id") == batch_id
            return write_counted(rows, lambda df: df.writeTo(self.table).overwrite(own)), 0
        return write_counted(rows, lambda df: overwrite_partitions(
            df, self.path, ["event_date", "batch_id"], compression=LAKE_CODEC
        )), 0


def archive_rows(broker_rows: DataFrame, ts_ms: Column) -> DataFrame:
    """Raw messages with UTC hour folders from ``ts_ms``; messages without a value are skipped."""
    at = F.timestamp_millis("__ms")
    rows = broker_rows.where(F.col("value").isNotNull()).select(
        "*", parsed_once(ts_ms).alias("__ms")
    )
    return rows.select(
        *broker_rows.columns,
        *[F.date_format(at, fmt).alias(name) for name, fmt in HOUR_FOLDERS.items()],
    )


class ArchiveSink(Sink):
    """Hourly raw archive; messages whose ``ts_ms`` cannot be read go to ``dead_letter_path``."""

    def __init__(self, name: str, path: str, dead_letter_path: str, ts_ms: Column, **kwargs):
        super().__init__(name, **kwargs)
        self.path, self.dead_letter_path, self.ts_ms = path, dead_letter_path, ts_ms

    def write(self, batch: DataFrame, batch_id: int) -> tuple[int, int]:
        rows = archive_rows(batch, self.ts_ms).withColumn(
            "batch_id", F.lit(batch_id).cast("long")
        )
        # Kept while both parts are written: the topic is read and parsed once.
        rows.persist()
        try:
            good = rows.where(F.col("year").isNotNull())
            bad = rows.where(F.col("year").isNull()).drop(*HOUR_FOLDERS).withColumn(
                "reject_reason", F.lit("no readable ts_ms")
            )
            n = write_counted(good, lambda df: overwrite_partitions(
                df, self.path, [*HOUR_FOLDERS, "batch_id"], compression=ARCHIVE_CODEC,
                maxRecordsPerFile=ARCHIVE_ROWS_PER_FILE,
            ))
            overwrite_partitions(bad, self.dead_letter_path, ["batch_id"])
        finally:
            rows.unpersist()
        return n, 0
