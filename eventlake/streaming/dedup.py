"""Exact keyed deduplication as a stateful processor, with late rows set aside before it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eventlake.functions.durations import micros
from eventlake.sinks.base import overwrite_partitions
from eventlake.streaming.waiting import BUCKETS, Wake, bucket_of, pack, unpack


class FirstPerWindow(StatefulProcessor):
    """Keeps a row when its key was last kept at least ``window`` earlier.

    State of a bucket of keys is one value: the time each key was last kept. The
    comparison uses event times, not timers: all rows of one micro-batch reach
    the processor before any timer fires, so a timer alone would keep one row
    per batch. The timer only removes keys.
    """

    def __init__(self, key_col: str, time_col: str, window_us: int, columns: list[str],
                 tie_cols: list[str]):
        self.key_col, self.time_col, self.window_us = key_col, time_col, window_us
        self.columns, self.tie_cols = columns, tie_cols

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last_kept, self.wake = handle.getValueState("last_kept", "rows binary"), Wake(handle)

    def _held(self) -> dict:
        if not self.last_kept.exists():
            return {}
        held = unpack(self.last_kept.get()[0])
        return dict(zip(held["key_"], held["us"].tolist(), strict=True))

    def _keep(self, last: dict) -> None:
        self.last_kept.update((pack(pd.DataFrame({"key_": pd.Series(list(last), dtype=object), "us": np.array(list(last.values()), np.int64)})),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last = self._held()
        # The engine delivers the rows of one batch in any order; they are
        # bounded by the rate limit of the source.
        batch = pd.concat(list(rows), ignore_index=True)
        batch = batch.sort_values(["key_", self.time_col, *self.tie_cols], kind="stable", ignore_index=True)
        times = batch[self.time_col].astype("datetime64[us]").astype("int64").to_numpy()
        owners = batch["key_"].to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], owners[1:] != owners[:-1]]))
        # From one kept row straight to the next: a search for each kept row.
        kept, before = [], len(last)
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(times)], strict=True):
            own, at = last.get(owners[start]), start
            if own is not None:
                at = start + int(np.searchsorted(times[start:end], own + self.window_us))
            while at < end:
                kept.append(at)
                own = int(times[at])
                at += int(np.searchsorted(times[at:end], own + self.window_us))
            last[owners[start]] = own
        if kept or len(last) != before:
            self._keep(last)
            # Rows this much behind the watermark no longer reach the processor.
            self.wake.by(min(last.values()) + self.window_us + 1000)
        yield batch.iloc[kept][self.columns]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.wake.woken()
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        last = {k: us for k, us in self._held().items() if us + self.window_us > passed}
        if last:
            self._keep(last)
            self.wake.by(min(last.values()) + self.window_us + 1000)
        else:
            self.last_kept.clear()
        return iter([])

    def close(self) -> None:
        pass


def first_per_window_stream(
    df: DataFrame, key: str, time_col: str, window: str = "1 hour", allowed: str = "1 hour",
    tie_cols: list[str] | None = None, buckets: int = BUCKETS,
) -> DataFrame:
    """Kept rows of a stream; keys are dealt to ``buckets``, whose state is held together.

    As in the batch form, rows without key or time are left out. Rows more than
    ``allowed`` behind the latest time of the batches before are dropped by the
    engine and show as ``dropped_by_watermark`` in the progress metrics; behind a
    ``LateSplit`` there are none.
    """
    out = T.StructType(df.schema.fields)
    processor = FirstPerWindow(key, time_col, micros(window), df.columns, list(tie_cols or []))
    known = df.where(F.col(key).isNotNull() & F.col(time_col).isNotNull()).withWatermark(time_col, allowed)
    dealt = known.withColumn("key_", F.col(key).cast("string")).withColumn("bucket", bucket_of(F.col(key), buckets=buckets))
    return dealt.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=out, outputMode="Append",
        timeMode="EventTime",
    )


class LateSplit:
    """``foreachBatch`` callback that deals every row to ``on_time`` or ``late`` tables.

    Late is what lies more than ``allowed`` behind the latest event time of all
    batches before, and what has no key or no time. Each batch stores the latest
    time up to its end and reads only what the batch before has stored, so a
    batch that runs again decides as it did before. A
    stateful query that reads the on-time table in the order it was written
    sees its own watermark no further than this one, so it drops nothing.
    """

    def __init__(self, spark, base: str, schema: T.StructType, key: str, time_col: str,
                 allowed: str = "1 hour"):
        self.on_time, self.late, self.latest = (f"{base}/{n}" for n in ("on_time", "late", "latest"))
        self.key, self.time_col, self.allowed_us = key, time_col, micros(allowed)
        self.schema = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
        for path, columns in ((self.on_time, self.schema), (self.late, self.schema),
                              (self.latest, "us long, batch_id long")):
            overwrite_partitions(spark.createDataFrame([], columns), path, ["batch_id"])

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = None
        if batch_id > 0:  # that one folder, whatever number of batches there was
            before = spark.read.schema("us long").parquet(f"{self.latest}/batch_id={batch_id - 1}").agg(F.max("us")).first()[0]
        us = F.unix_micros(self.time_col)
        is_late = F.col(self.key).isNull() | us.isNull()
        if before is not None:
            is_late = is_late | (us < before - self.allowed_us)
        numbered = batch.withColumn("batch_id", F.lit(batch_id).cast("long")).persist()
        try:
            overwrite_partitions(numbered.where(~is_late), self.on_time, ["batch_id"])
            overwrite_partitions(numbered.where(is_late), self.late, ["batch_id"])
            newest = numbered.agg(F.greatest(F.max(us), F.lit(before).cast("long")).alias("us"),
                                  F.lit(batch_id).cast("long").alias("batch_id"))
            overwrite_partitions(newest, self.latest, ["batch_id"])
        finally:
            numbered.unpersist()

    def read_on_time(self, spark) -> DataFrame:
        """The on-time rows as a stream."""
        return spark.readStream.schema(self.schema).parquet(self.on_time).drop("batch_id")
