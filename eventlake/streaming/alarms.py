"""Alarms while the stream runs."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eventlake.functions.durations import micros

_OUT = ["state", "breach_start_us", "breach_end_us", "periods", "worst_value"]


class AlarmRuns(StatefulProcessor):
    """Runs of breaching periods of one series and alarm.

    State: figures of the periods that the watermark has not passed, and the
    run so far. A period is judged once the watermark has passed its end; a
    silent one is closed by a timer and does not breach.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.figures = handle.getMapState("figures", "period long", "top double, low double, total double, n long")
        self.rule = handle.getValueState("rule", "statistic string, width long, threshold double, least long")
        self.run = handle.getValueState("run", "first long, last long, worst double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new: dict[int, list[float]] = {}
        for part in rows:
            if not self.rule.exists():
                head = part.iloc[0]
                self.rule.update((head["statistic"], int(head["width"]), float(head["threshold"]), int(head["least"])))
            width = self.rule.get()[1]
            for us, value in zip(part["us"].tolist(), part["value"].tolist(), strict=True):
                new.setdefault(us // width, []).append(value)
        for period, values in new.items():
            held = self.figures.getValue((period,)) if self.figures.containsKey((period,)) else (float("-inf"), float("inf"), 0.0, 0)
            top, low, total, n = held
            self.figures.updateValue((period,), (max(top, *values), min(low, *values), total + sum(values), n + len(values)))
        self.handle.registerTimer((min(new) + 1) * self.rule.get()[1] // 1000)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        statistic, width, threshold, least = self.rule.get()
        closed = timerValues.getCurrentWatermarkInMs() * 1000 // width  # periods below are over
        held = {p: f for (p,), f in self.figures.iterator()}
        run = tuple(self.run.get()) if self.run.exists() else None
        out = []

        def ended(run: tuple) -> None:
            if run[1] - run[0] + 1 >= least:
                out.append(("OK", run[0] * width, (run[1] + 1) * width, run[1] - run[0] + 1, run[2]))

        for period in sorted(p for p in held if p < closed):
            top, low, total, n = held.pop(period)
            self.figures.removeKey((period,))
            value = {"max": top, "min": low, "sum": total, "avg": total / n}[statistic]
            breaches = value > threshold
            if run and (period > run[1] + 1 or not breaches):
                ended(run)
                run = None
            if breaches:
                run = (run[0], period, max(run[2], value)) if run else (period, period, value)
                if run[1] - run[0] + 1 == least:
                    out.append(("ALARM", run[0] * width, (run[1] + 1) * width, least, run[2]))
        if run and run[1] + 1 < closed:  # nothing came in the period after it
            ended(run)
            run = None
        if run:
            self.run.update(run)
        else:
            self.run.clear()
        following = [(run[1] + 2) * width] if run else []
        following += [(min(held) + 1) * width] if held else []
        if following:
            self.handle.registerTimer(min(following) // 1000)
        if out:
            yield pd.DataFrame(out, columns=_OUT)

    def close(self) -> None:
        pass


def alarm_stream(points: DataFrame, alarms, keys: list[str] | None = None, allowed: str = "1 minute") -> DataFrame:
    """Alarms that begin (``ALARM``, once as many periods breach as the alarm asks for) and end (``OK``).

    An ``OK`` row is what ``evaluate_alarms`` returns for the whole run; gaps end
    a run there as well. Points (``metric``, ``value``, ``ts`` and ``keys``) without a value or a time, or behind the
    watermark when they come, play no part. Periods are whole milliseconds.
    """
    keys = keys or ["dimension"]
    rules = points.sparkSession.createDataFrame(
        [(a.name, a.metric, a.statistic, micros(a.period), float(a.threshold), a.periods) for a in alarms],
        "alarm string, metric string, statistic string, width long, threshold double, least long")
    timed = points.where(F.col("value").isNotNull() & F.col("ts").isNotNull()).withWatermark("ts", allowed)
    met = timed.join(rules, "metric").select(
        "alarm", *keys, "ts", F.unix_micros("ts").alias("us"), F.col("value").cast("double").alias("value"), "statistic", "width", "threshold", "least")
    types = {f.name: f for f in met.schema.fields}
    out = T.StructType([types[c] for c in ("alarm", *keys)] + [
        T.StructField("state", T.StringType()), T.StructField("breach_start_us", T.LongType()), T.StructField("breach_end_us", T.LongType()),
        T.StructField("periods", T.LongType()), T.StructField("worst_value", T.DoubleType())])
    found = met.groupBy("alarm", *keys).transformWithStateInPandas(
        statefulProcessor=_Keyed(["alarm", *keys]), outputStructType=out, outputMode="Append", timeMode="EventTime")
    return found.select("alarm", *keys, "state", F.timestamp_micros("breach_start_us").alias("breach_start"),
                        F.timestamp_micros("breach_end_us").alias("breach_end"), "periods", "worst_value")


class _Keyed(AlarmRuns):
    """The same with the key in front of every row."""

    def __init__(self, names: list[str]):
        self.names = names

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        for frame in super().handleExpiredTimer(key, timerValues, expiredTimerInfo):
            for at, (name, value) in enumerate(zip(self.names, key, strict=True)):
                frame.insert(at, name, value)
            yield frame
