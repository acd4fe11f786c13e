"""Sliding-window figures of a stream beside the rows that they score, without building all windows."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eventlake.streaming.temporal import JSON_OPTIONS
from eventlake.streaming.waiting import BUCKETS, Waiting, Wake, bucket_of, pack, unpack

NO_AMOUNT = -(1 << 63)  # stands for an amount that is missing
_FIGURES = ["c", "n", "s", "sq"]


class LastWindows(StatefulProcessor):
    """Gives each row the figures of its key's last window that ended before it, once the watermark has passed that end.

    A pane is the longest time that both a window and a slide are whole numbers
    of, and a window a run of panes. State of a bucket of keys: rows, amounts,
    sum and sum of squares of each (key, pane) as one value, and the rows that
    wait for their window to close. Panes that no row to come can need are dropped.
    """

    def __init__(self, size_us: int, step: int):
        self.size_us, self.step, self.width = size_us, step, math.gcd(size_us, step)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.panes = handle.getValueState("panes", "rows binary")
        self.waiting, self.wake = Waiting(handle), Wake(handle)

    def _held(self) -> pd.DataFrame:
        if not self.panes.exists():
            return pd.DataFrame({"key_": pd.Series([], dtype=object), "pane": pd.Series([], dtype="int64"), **{c: pd.Series([], dtype="int64") for c in _FIGURES}})
        held = unpack(self.panes.get()[0])
        held["sq"] = [int(x) for x in held["sq"]]
        return held.astype({"sq": object})

    def _keep(self, panes: pd.DataFrame) -> None:
        self.panes.update((pack(panes.assign(sq=[str(x) for x in panes["sq"]])),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        parts, first = [], None
        for part in rows:
            units = part["units"].to_numpy()
            there = units != NO_AMOUNT
            units = np.where(there, units, 0)
            parts.append(self._summed(pd.DataFrame({
                "key_": part["key_"], "pane": part["us"] // self.width, "c": np.int64(1), "n": there.astype(np.int64),
                "s": units, "sq": units.astype(object) * units.astype(object)})))
            new = part.loc[part["payload"].notna(), ["key_", "us", "payload"]]
            if len(new):
                self.waiting.add(new)
                first = int(new["us"].min()) if first is None else min(first, int(new["us"].min()))
        self._keep(self._summed(pd.concat([self._held(), *parts], ignore_index=True)))
        if first is not None:
            self.wake.by(self._due(first))
        return iter([])

    def _due(self, us: int) -> int:
        """Just before the watermark reaches the end of the window of a row, as timers fire once it is behind them."""
        return (us - 1) // self.step * self.step - 1000

    @staticmethod
    def _summed(panes: pd.DataFrame) -> pd.DataFrame:
        return panes.groupby(["key_", "pane"], sort=True, as_index=False)[_FIGURES].sum()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        self.wake.woken()
        panes = self._held()
        names = pd.Index(panes["key_"].unique())
        low = int(panes["pane"].min()) - 1 if len(panes) else 0
        span = int(panes["pane"].max()) - low + 2 if len(panes) else 1
        places = names.get_indexer(panes["key_"]) * span + panes["pane"].to_numpy() - low
        upto = [np.concatenate([[0], np.cumsum(panes[c].to_numpy())]) for c in _FIGURES]
        for due in self.waiting.take((passed // self.step + 1) * self.step + 1):
            code, end = names.get_indexer(due["key_"]), (due["us"].to_numpy() - 1) // self.step * self.step
            edges = [np.searchsorted(places, code * span + np.clip(at // self.width - low, 0, span - 1)) for at in (end - self.size_us, end)]
            c, n, s, sq = (x[edges[1]] - x[edges[0]] for x in upto)
            yield pd.DataFrame({"payload": due["payload"], "window_end": end, "c": c.astype("int64"), "n": n.astype("int64"),
                                "s": s.astype("int64"), "sq": [str(x) for x in sq]})[c > 0]
        # A row to come, or still waiting, needs no pane before its window.
        first = self.waiting.first()
        oldest = ((passed if first is None else min(passed, first)) - 1) // self.step * self.step - self.size_us
        left = panes[panes["pane"] * self.width >= oldest]
        if len(left) == 0:
            self.panes.clear()
        elif len(left) < len(panes):
            self._keep(left)
        if first is not None:
            self.wake.by(self._due(first))
        elif len(left):
            self.wake.by((int(left["pane"].max()) + 1) * self.width + self.size_us + self.step)

    def close(self) -> None:
        pass


def last_windows(
    df: DataFrame, user_col: str, units, time_col: str, size_us: int, step: int, salts: int = 1, buckets: int = BUCKETS,
) -> DataFrame:
    """Rows of a stream with a watermark as ``r``, with ``window_end`` and the figures ``c``, ``n``, ``s`` and ``sq`` of their last window.

    Rows without a user or a time have no window, and rows whose window is empty
    are left out. The rows of a user are spread over ``salts`` tasks, each of
    which holds the user's panes.
    """
    known = df.where(F.col(user_col).isNotNull() & F.col(time_col).isNotNull())
    own = F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int")
    rows = known.select(
        bucket_of(F.col(user_col), buckets=buckets).alias("bucket"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
        F.col(user_col).cast("string").alias("key_"), F.col(time_col).alias("at"), F.unix_micros(time_col).alias("us"),
        F.coalesce(units, F.lit(NO_AMOUNT)).alias("units"), F.to_json(F.struct(*df.columns), JSON_OPTIONS).alias("text"), own.alias("own"))
    packed = rows.select("bucket", "salt", "key_", "at", "us", "units", F.when(F.col("own") == F.col("salt"), F.col("text")).alias("payload"))
    scored = packed.groupBy("bucket", "salt").transformWithStateInPandas(
        statefulProcessor=LastWindows(size_us, step), outputMode="Append", timeMode="EventTime",
        outputStructType="payload string, window_end long, c long, n long, s long, sq string")
    return scored.select(
        F.from_json("payload", df.schema, JSON_OPTIONS).alias("r"), F.timestamp_micros("window_end").alias("window_end"),
        "c", "n", "s", F.col("sq").cast("decimal(38,0)").alias("sq"))
