"""As-of join of a stream of rows with a stream of versions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eventlake.functions.durations import micros
from eventlake.streaming.waiting import BUCKETS, Waiting, Wake, bucket_of, pack, unpack

JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
ROW, VERSION = 1, 0


class VersionedRows(StatefulProcessor):
    """Holds each row until the watermark has passed it, then gives it the newest version not after it.

    State of a bucket of keys: their versions as one value, and waiting rows in
    parts by time. When the watermark passes a tick, no version that belongs to
    its rows can come any more. Versions older than the newest one of their key
    at the watermark are dropped then.
    """

    def __init__(self, tick_us: int):
        self.tick_us = tick_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.versions = handle.getValueState("versions", "rows binary")
        self.waiting, self.wake = Waiting(handle), Wake(handle)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        came, wake = [], None
        for part in rows:
            is_version = part["kind"] == VERSION
            part = part[["key_", "us", "payload"]]
            came.append(part[is_version])
            new = part[~is_version]
            if len(new):
                self.waiting.add(new)
                due = (int(new["us"].min()) // self.tick_us + 1) * self.tick_us
                wake = due if wake is None else min(wake, due)
        known = pd.concat(came, ignore_index=True)
        if len(known):
            wake = int(known["us"].max()) if wake is None else wake
            if self.versions.exists():
                known = pd.concat([unpack(self.versions.get()[0]), known], ignore_index=True)
            # Of two versions of one instant the same one stays in whatever order they come.
            known = known.sort_values(["us", "key_", "payload"], ignore_index=True).drop_duplicates(["key_", "us"], keep="last")
            self.versions.update((pack(known),))
        if wake is not None:
            self.wake.by(wake)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        self.wake.woken()
        known = unpack(self.versions.get()[0]) if self.versions.exists() else pd.DataFrame(
            {"key_": pd.Series([], dtype=object), "us": pd.Series([], dtype="int64"), "payload": pd.Series([], dtype=object)})
        dims = known.rename(columns={"payload": "dim"})
        for due in self.waiting.take(passed // self.tick_us * self.tick_us):
            due = due.sort_values("us", kind="stable", ignore_index=True)
            found = pd.merge_asof(due, dims, on="us", by="key_") if len(dims) else due.assign(dim=None)
            yield found[["payload", "dim"]].astype(object).where(found[["payload", "dim"]].notna(), None)
        # Rows still to come, or still waiting, are not before this.
        first = self.waiting.first()
        oldest = passed if first is None else min(passed, first)
        if len(known):
            old = known["us"] <= oldest
            left = pd.concat([known[old].drop_duplicates("key_", keep="last"), known[~old]], ignore_index=True)
            if len(left) < len(known):
                self.versions.update((pack(left),))
        if first is not None:
            self.wake.by((first // self.tick_us + 1) * self.tick_us)
        elif len(known) and int(known["us"].iloc[-1]) > passed:
            self.wake.by(int(known["us"].iloc[-1]))

    def close(self) -> None:
        pass


def asof_join_streams(
    rows: DataFrame, versions: DataFrame, key: str, time_col: str, updated_col: str, dim_cols: list[str],
    allowed: str | None = "1 hour", versions_allowed: str | None = "1 hour", tick: str = "1 second", salts: int = 1,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Left join of a stream to the newest version of ``key`` with ``updated_col <= time_col``, from a second stream.

    Each side has a watermark of its own, ``allowed`` and ``versions_allowed``
    behind its latest time (None: the stream carries its watermark already); a
    row is returned once both have passed the tick that it lies in, so a version may arrive long after the rows that need it.
    The order of arrival plays no part in the result. What is behind both
    watermarks already when it comes is dropped by the engine and counted as
    ``dropped_by_watermark``; a ``LateSplit`` before the join sets it aside.
    Rows without a key or a time have no version and are returned at once.

    Keys are dealt to ``buckets``, whose state is held together. The rows of a key are spread over ``salts`` tasks, each of which holds the
    key's versions; rows and versions pass as text, so no type is bent.
    """
    known = F.col(key).isNotNull() & F.col(time_col).isNotNull()

    def packed(df: DataFrame, at: str, kind: int, columns: list[str], salt: Column, delay: str | None) -> DataFrame:
        return (df.withWatermark(at, delay) if delay else df).select(
            bucket_of(F.col(key), buckets=buckets).alias("bucket"), F.col(key).cast("string").alias("key_"), salt.alias("salt"), F.col(at).alias("at"),
            F.unix_micros(at).alias("us"), F.lit(kind).alias("kind"), F.to_json(F.struct(*columns), JSON_OPTIONS).alias("payload"))

    one = F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    dated = versions.where(F.col(key).isNotNull() & F.col(updated_col).isNotNull())
    both = packed(rows.where(known), time_col, ROW, rows.columns, one, allowed).union(
        packed(dated, updated_col, VERSION, dim_cols, every, versions_allowed))
    matched = both.groupBy("bucket", "salt").transformWithStateInPandas(
        statefulProcessor=VersionedRows(micros(tick)), outputStructType="payload string, dim string",
        outputMode="Append", timeMode="EventTime")
    row_type, dim_type = rows.schema, T.StructType([versions.schema[c] for c in dim_cols])
    joined = matched.select(F.from_json("payload", row_type, JSON_OPTIONS).alias("r"), F.from_json("dim", dim_type, JSON_OPTIONS).alias("d")).select(
        "r.*", *[F.col(f"d.{c}").alias(c) for c in dim_cols])
    alone = rows.where(~known).select("*", *[F.lit(None).cast(dim_type[c].dataType).alias(c) for c in dim_cols])
    return joined.union(alone)
