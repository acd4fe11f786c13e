"""Exact trailing statistics of a stream."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eventlake.functions.durations import micros
from eventlake.operators.anomaly import MIN_COUNT, Z_LIMIT, as_alerts, flag_outliers, mean_and_std, units_of
from eventlake.streaming.temporal import JSON_OPTIONS

_NONE = -(1 << 63)  # stands for an amount that is missing
_PART = np.dtype([("us", "<i8"), ("units", "<i8")])


def _sums(rows: np.ndarray) -> list[np.ndarray]:
    """Running rows, amounts, sum and sum of squares (exact) before each place and after the last one."""
    there = rows["units"] != _NONE
    units = np.where(there, rows["units"], 0)
    squares = units.astype(object) * units.astype(object)
    return [np.concatenate([[0], np.cumsum(x)]) for x in (np.ones(len(rows), np.int64), there.astype(np.int64), units, squares)]


class TrailingSums(StatefulProcessor):
    """Scores each row once the watermark has passed it, against the rows of its key in [t - frame, t).

    The frame is a whole number of time cells. State of a key: totals of each
    cell, its times and amounts, and the rows that wait. The figures of a row in
    cell c are the totals of the cells between, the rows of c before it, and the
    rows of cell c - cells that are still in the frame; only those two cells are
    read. Cells that no row to come can reach are dropped.
    """

    def __init__(self, frame_us: int, cells: int):
        self.frame_us, self.cells, self.width = frame_us, cells, frame_us // cells

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.parts = handle.getMapState("parts", "cell long", "rows binary")
        self.totals = handle.getMapState("totals", "cell long", "c long, n long, s long, sq string")
        self.waiting = handle.getMapState("waiting", "cell long", "rows string")

    def _part(self, cell: int) -> np.ndarray:
        held = self.parts.getValue((cell,))[0] if self.parts.containsKey((cell,)) else b""
        return np.sort(np.frombuffer(bytes(held), _PART), order="us", kind="stable")

    def _total(self, cell: int) -> tuple[int, int, int, int]:
        if not self.totals.containsKey((cell,)):
            return 0, 0, 0, 0
        c, n, s, sq = self.totals.getValue((cell,))
        return c, n, s, int(sq)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        arrived: dict[int, list] = {}
        for part in rows:
            for us, units, payload in zip(part["us"].tolist(), part["units"].tolist(), part["payload"].tolist(), strict=True):
                arrived.setdefault(us // self.width, []).append((us, units, payload))
        for cell, new in arrived.items():
            part = np.array([(us, units) for us, units, _ in new], _PART)
            held = bytes(self.parts.getValue((cell,))[0]) if self.parts.containsKey((cell,)) else b""
            self.parts.updateValue((cell,), (held + part.tobytes(),))
            added = [x[-1] for x in _sums(part)]
            c, n, s, sq = (int(a) + int(b) for a, b in zip(self._total(cell), added, strict=True))
            self.totals.updateValue((cell,), (c, n, s, str(sq)))
            before = json.loads(self.waiting.getValue((cell,))[0]) if self.waiting.containsKey((cell,)) else []
            self.waiting.updateValue((cell,), (json.dumps(before + [[us, payload] for us, _, payload in new]),))
        if arrived:
            self.handle.registerTimer(-(-min(us for new in arrived.values() for us, _, _ in new) // 1000))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        next_due = None
        totals = {cell: (c, n, s, int(sq)) for (cell,), (c, n, s, sq) in self.totals.iterator()}
        for cell in sorted(c for (c,) in self.waiting.keys()):
            if cell * self.width > passed:
                next_due = cell * self.width if next_due is None else next_due
                break
            rows = json.loads(self.waiting.getValue((cell,))[0])
            due, left = [r for r in rows if r[0] <= passed], [r for r in rows if r[0] > passed]
            if left:
                self.waiting.updateValue((cell,), (json.dumps(left),))
                next_due = min(r[0] for r in left) if next_due is None else next_due
            else:
                self.waiting.removeKey((cell,))
            if due:
                yield self._scored(cell, due, totals)
        # What lies at or before the watermark can't come any more.
        for cell in [c for c in totals if (c + 1) * self.width <= passed - self.frame_us]:
            self.parts.removeKey((cell,))
            self.totals.removeKey((cell,))
            del totals[cell]
        if next_due is None and totals:
            next_due = (max(totals) + 1) * self.width + self.frame_us
        if next_due is not None:
            self.handle.registerTimer(-(-next_due // 1000))

    def _scored(self, cell: int, due: list, totals: dict) -> pd.DataFrame:
        at = np.array([us for us, _ in due], np.int64)
        own, old = self._part(cell), self._part(cell - self.cells)
        entered = np.searchsorted(own["us"], at, side="left")
        gone = np.searchsorted(old["us"], at - self.frame_us, side="left")
        between = [totals[k] for k in range(cell - self.cells + 1, cell) if k in totals]
        whole = [sum(t[i] for t in between) for i in range(4)]
        c, n, s, sq = (w + new[entered] + (last[-1] - last[gone]) for w, new, last in zip(whole, _sums(own), _sums(old), strict=True))
        return pd.DataFrame({
            "payload": [p for _, p in due], "c": c.astype("int64"), "n": n.astype("int64"), "s": s.astype("int64"), "sq": [str(x) for x in sq]})

    def close(self) -> None:
        pass


def trailing_stats_stream(
    df: DataFrame, user_col: str, amount_col: str, time_col: str, frame: str = "1 hour",
    allowed: str | None = "5 minutes", decimals: int = 2, cells: int = 12,
) -> DataFrame:
    """``trailing_stats`` of a stream: the same rows with the same figures, each once the watermark has passed it.

    The watermark is ``allowed`` behind the latest time (None: the stream has
    one). Rows of any micro-batch and in any order count, as long as they are
    not behind the watermark when they come; those the engine drops and counts.
    Rows without a time are left out, as in the batch form.
    """
    frame_us = micros(frame)
    cells = next(c for c in range(cells, 0, -1) if frame_us % c == 0)
    dated = df.where(F.col(time_col).isNotNull())
    rows = (dated.withWatermark(time_col, allowed) if allowed else dated).select(
        F.col(user_col).alias("owner"), F.col(time_col).alias("at"), F.unix_micros(time_col).alias("us"),
        F.coalesce(units_of(F.col(amount_col), decimals), F.lit(_NONE)).alias("units"),
        F.to_json(F.struct(*df.columns), JSON_OPTIONS).alias("payload"))
    scored = rows.groupBy("owner").transformWithStateInPandas(
        statefulProcessor=TrailingSums(frame_us, cells), outputStructType="payload string, c long, n long, s long, sq string",
        outputMode="Append", timeMode="EventTime")
    mean, std = mean_and_std(F.col("n"), F.col("s"), F.col("sq").cast("decimal(38,0)"), decimals)
    return scored.select(
        F.from_json("payload", df.schema, JSON_OPTIONS).alias("r"), mean.alias("avg_amount"), std.alias("std_amount"),
        F.col("c").alias("txn_count")).select("r.*", "avg_amount", "std_amount", "txn_count")


def trailing_alerts_stream(
    df: DataFrame, user_col: str = "user_id", amount_col: str = "amount", time_col: str = "event_time",
    frame: str = "1 hour", allowed: str | None = "5 minutes", decimals: int = 2,
    min_count: int = MIN_COUNT, z_limit: float = Z_LIMIT,
) -> DataFrame:
    """Every row of a stream against its user's own trailing frame, as ``trailing_alerts`` of a table."""
    stats = trailing_stats_stream(df, user_col, amount_col, time_col, frame, allowed, decimals)
    return as_alerts(flag_outliers(stats, amount_col, min_count, z_limit), user_col)
