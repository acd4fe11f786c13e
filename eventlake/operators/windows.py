"""Event-time window aggregations.

The same functions take batch tables and streams. Streams use Spark's stateful
window operators. Batch tables go through a pre-aggregation to time cells:

* sliding: rows are combined per pane (one slide) first, and the panes, not the
  rows, are copied to the windows they belong to;
* session: two rows of a key inside one gap-wide cell are less than a gap apart,
  hence in one session, so rows are combined per (key, cell) with a map-side
  combine, and only those cells are ordered per key. A key's share of that step
  is bounded by the time span over the gap, however many rows it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions.aggregates import aggregations
from eventlake.functions.durations import micros


def tumbling_window(
    df: DataFrame, time_col: str, duration: str, group_cols: list[str], aggs,
    watermark: str = "10 minutes",
) -> DataFrame:
    """Fixed windows: window_start, window_end, group columns, aggregates."""
    specs = aggregations(aggs)
    return (
        df.withWatermark(time_col, watermark)
        .groupBy(F.window(time_col, duration).alias("w"), *group_cols)
        .agg(*[s.direct() for s in specs])
        .select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
            *group_cols, *[s.alias for s in specs],
        )
    )


def sliding_window(
    df: DataFrame, time_col: str, duration: str, slide: str, group_cols: list[str], aggs,
    watermark: str = "10 minutes",
) -> DataFrame:
    """Overlapping windows of ``duration`` starting every ``slide``."""
    specs = aggregations(aggs)
    size, step = micros(duration), micros(slide)
    if df.isStreaming or size % step:
        windowed = (
            df.withWatermark(time_col, watermark)
            .groupBy(F.window(time_col, duration, slide).alias("w"), *group_cols)
            .agg(*[s.direct() for s in specs])
        )
        return windowed.select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
            *group_cols, *[s.alias for s in specs],
        )
    panes = (
        df.groupBy(F.window(time_col, slide).alias("pane"), *group_cols)
        .agg(*[p for s in specs for p in s.partials()])
        .withColumn("pane_us", F.unix_micros("pane.start"))
    )
    starts = F.sequence(
        F.col("pane_us") - (size - step), F.col("pane_us"), F.lit(step).cast("long")
    )
    return (
        panes.withColumn("start_us", F.explode(starts))
        .groupBy("start_us", *group_cols)
        .agg(*[s.merged() for s in specs])
        .select(
            F.timestamp_micros("start_us").alias("window_start"),
            F.timestamp_micros(F.col("start_us") + size).alias("window_end"),
            *group_cols, *[s.alias for s in specs],
        )
    )


def session_window(
    df: DataFrame, time_col: str, gap: str, group_cols: list[str], aggs,
    watermark: str = "10 minutes",
) -> DataFrame:
    """Sessions closed by ``gap`` of silence; rows exactly a gap apart stay together.

    ``session_end`` is the last row's time plus the gap.
    """
    specs = aggregations(aggs)
    names = [s.alias for s in specs]
    if df.isStreaming:
        return (
            df.withWatermark(time_col, watermark)
            .groupBy(F.session_window(time_col, gap).alias("w"), *group_cols)
            .agg(*[s.direct() for s in specs])
            .select(
                F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"),
                *group_cols, *names,
            )
        )
    gap_us = micros(gap)
    at = F.unix_micros(time_col)
    cells = (
        df.where(F.col(time_col).isNotNull())
        .groupBy(*group_cols, F.floor(at / F.lit(gap_us)).alias("__cell"))
        .agg(
            F.min(at).alias("__lo"), F.max(at).alias("__hi"),
            *[p for s in specs for p in s.partials()],
        )
    )
    ordered = Window.partitionBy(*group_cols).orderBy("__cell")
    opens = F.col("__lo") - F.lag("__hi").over(ordered) > gap_us
    return (
        cells.withColumn("__opens", F.coalesce(opens, F.lit(False)).cast("int"))
        .withColumn("__session", F.sum("__opens").over(ordered))
        .groupBy(*group_cols, "__session")
        .agg(F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi"),
             *[s.merged() for s in specs])
        .select(
            F.timestamp_micros("__lo").alias("session_start"),
            F.timestamp_micros(F.col("__hi") + gap_us).alias("session_end"),
            *group_cols, *names,
        )
    )


def hop_window(
    df: DataFrame, time_col: str, slide: str, size: str, group_cols: list[str], aggs,
    watermark: str = "10 minutes",
) -> DataFrame:
    """``sliding_window`` with the argument order of the SQL ``HOP`` table function."""
    return sliding_window(df, time_col, size, slide, group_cols, aggs, watermark)


def with_session_seconds(sessions: DataFrame) -> DataFrame:
    """Session length in whole seconds, trailing gap included."""
    seconds = F.unix_timestamp("session_end") - F.unix_timestamp("session_start")
    return sessions.withColumn("session_duration_sec", seconds)
