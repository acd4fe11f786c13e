"""Amounts far from a user's recent mean (z-score alerts).

Amounts are summed as whole units of 10^-decimals (money is NUMERIC(12,2) at the
source), so the sums are exact: a user who always pays the same amount has a
deviation of exactly zero, in any order of addition.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions.durations import micros
from eventlake.streaming.panes import last_windows

MIN_COUNT = 5
Z_LIMIT = 3.0


def units_of(amount: Column, decimals: int) -> Column:
    return F.round(amount * (10 ** decimals)).cast("long")


def mean_and_std(n: Column, s: Column, sq: Column, decimals: int) -> tuple[Column, Column]:
    """Mean and sample deviation from exact count, sum and sum of squares."""
    scale = float(10 ** decimals)
    spread = n.cast("decimal(19,0)") * sq - s.cast("decimal(19,0)") * s.cast("decimal(19,0)")
    variance = spread.cast("double") / (n * (n - 1)).cast("double")
    mean = F.when(n > 0, s.cast("double") / n / scale)
    return mean, F.when(n > 1, F.sqrt(variance) / scale)


def trailing_stats(
    df: DataFrame, user_col: str, amount_col: str, time_col: str,
    frame: str = "1 hour", decimals: int = 2, cells: int = 12,
) -> DataFrame:
    """Each row with mean, deviation and count of its user's rows in [t - frame, t).

    The row itself and rows of the same instant are not part of its history.
    The frame is cut into ``cells`` time cells. A row enters the statistics in
    its own cell and leaves them ``cells`` cells later, so the statistics at any
    row are: totals of the last ``cells`` cells at the start of its cell, plus
    the rows that entered since, minus the rows that left since. Work is split by
    (user, cell), a running sum each, and only cell totals, combined on the map
    side, are ordered per user. A hot user is spread over all their cells and no
    frame is ever summed anew.
    """
    frame_us = micros(frame)
    # As many cells as divide the frame evenly, ``cells`` at most.
    cells = next(c for c in range(cells, 0, -1) if frame_us % c == 0)
    width = frame_us // cells
    at = F.unix_micros(time_col)
    units = units_of(F.col(amount_col), decimals)
    squared = units.cast("decimal(19,0)") * units.cast("decimal(19,0)")
    rows = df.where(F.col(time_col).isNotNull()).select(
        F.col(user_col).alias("__user"), at.alias("__us"),
        F.floor(at / F.lit(width)).alias("__cell"),
        F.lit(1).cast("long").alias("__c"),
        F.when(units.isNotNull(), 1).otherwise(0).cast("long").alias("__n"),
        F.coalesce(units, F.lit(0)).alias("__s"),
        F.coalesce(squared, F.lit(0)).cast("decimal(38,0)").alias("__sq"),
        F.struct(*df.columns).alias("__row"),
    )
    names = {"__c": "long", "__n": "long", "__s": "long", "__sq": "decimal(38,0)"}
    totals = rows.groupBy("__user", "__cell").agg(*[F.sum(c).alias(c) for c in names])
    # Cell totals of [c - cells, c - 1] as the opening balance of every cell c
    # that has rows: range frame over cell numbers, one small row per cell.
    before = Window.partitionBy("__user").orderBy("__cell").rangeBetween(-cells, -1)
    opening = totals.select(
        "__user", "__cell", (F.col("__cell") * width).alias("__us"), F.lit(0).alias("__kind"),
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).cast(t).alias(c) for c, t in names.items()],
    )
    # kind 1: the row to be scored, which then enters; kind 2: the same row when
    # it leaves, just after t + frame, without its columns.
    enters = F.col("__kind") == 1
    moves = rows.withColumn("__kind", F.explode(F.array(F.lit(1), F.lit(2)))).select(
        "__user", F.when(enters, F.col("__cell")).otherwise(F.col("__cell") + cells).alias("__cell"),
        F.when(enters, F.col("__us")).otherwise(F.col("__us") + frame_us).alias("__us"), "__kind",
        *[F.when(enters, F.col(c)).otherwise(-F.col(c)).cast(t).alias(c) for c, t in names.items()],
        F.when(enters, F.col("__row")).alias("__row"),
    )
    # Order within an instant: opening balance, rows of the instant (one exactly
    # `frame` old still counts), rows that left.
    line = moves.unionByName(opening, allowMissingColumns=True).withColumn(
        "__at", F.col("__us") * 3 + F.col("__kind")
    )
    upto = Window.partitionBy("__user", "__cell").orderBy("__at")
    past = upto.rangeBetween(Window.unboundedPreceding, -1)
    sums = [F.coalesce(F.sum(c).over(past), F.lit(0)).alias(c) for c in names]
    stats = line.select("__kind", "__row", *sums).where("__kind = 1")
    mean, std = mean_and_std(F.col("__n"), F.col("__s"), F.col("__sq"), decimals)
    return stats.select(
        "__row.*", mean.alias("avg_amount"), std.alias("std_amount"),
        F.col("__c").alias("txn_count"),
    )


def flag_outliers(
    stats: DataFrame, amount_col: str = "amount", min_count: int = MIN_COUNT,
    z_limit: float = Z_LIMIT,
) -> DataFrame:
    """Rows with enough history, some spread, and a z-score beyond the limit."""
    z = (F.col(amount_col) - F.col("avg_amount")) / F.col("std_amount")
    return (
        stats.where(F.col("std_amount").isNotNull() & (F.col("std_amount") > 0))
        .where(F.col("txn_count") >= min_count)
        .withColumn("z_score", z)
        .where(F.abs("z_score") > z_limit)
    )


def as_alerts(outliers: DataFrame, user_col: str = "user_id") -> DataFrame:
    """Alert labels and the recipients: the user and the operations team."""
    return (
        outliers.withColumn("alert_type", F.lit("anomalous_amount"))
        .withColumn("severity", F.lit("WARNING"))
        .withColumn("user_targets", F.array(F.col(user_col).cast("string"), F.lit("ops-team")))
    )


def trailing_alerts(
    df: DataFrame, user_col: str = "user_id", amount_col: str = "amount",
    time_col: str = "event_time", frame: str = "1 hour", decimals: int = 2,
    min_count: int = MIN_COUNT, z_limit: float = Z_LIMIT,
) -> DataFrame:
    """Batch form: every row against its user's own trailing frame."""
    stats = trailing_stats(df, user_col, amount_col, time_col, frame, decimals)
    return as_alerts(flag_outliers(stats, amount_col, min_count, z_limit), user_col)


def _parts(amount_col: str, decimals: int) -> tuple[Column, ...]:
    units = units_of(F.col(amount_col), decimals)
    squared = units.cast("decimal(19,0)") * units.cast("decimal(19,0)")
    return (
        F.count(F.lit(1)).alias("c"), F.count(units).alias("n"),
        F.sum(units).alias("s"), F.sum(squared).alias("sq"),
    )


def _named_stats(decimals: int) -> tuple[Column, ...]:
    mean, std = mean_and_std(F.col("n"), F.col("s"), F.col("sq").cast("decimal(38,0)"), decimals)
    return mean.alias("avg_amount"), std.alias("std_amount"), F.col("c").alias("txn_count")


def windowed_stats(
    df: DataFrame, user_col: str, amount_col: str, time_col: str,
    size: str = "1 hour", slide: str = "5 minutes", decimals: int = 2,
) -> DataFrame:
    """Mean, deviation and count per user and sliding window, with the window's end."""
    stats = df.groupBy(F.window(time_col, size, slide).alias("w"), user_col).agg(
        *_parts(amount_col, decimals)
    )
    return stats.select(
        user_col, F.window_time("w").alias("stats_time"), F.col("w.end").alias("window_end"),
        *_named_stats(decimals),
    )


def _stats_where_needed(
    rows: DataFrame, user_col: str, amount_col: str, time_col: str, size_us: int, step: int,
    decimals: int,
) -> DataFrame:
    """The sliding windows some row is scored with, without building all others.

    Rows are combined per (user, pane) on the map side, a pane being the longest
    time that both a window and a slide are whole numbers of. A window is a run of
    panes, so its figures are a sum over the panes before its end, taken only at
    the ends that have a row right after them. A user's share of the ordered
    step is bounded by the number of panes in the time span.
    """
    width = math.gcd(size_us, step)
    pane = F.floor(F.unix_micros(time_col) / F.lit(width))
    panes = rows.where(F.col(time_col).isNotNull()).groupBy(
        F.col(user_col).alias("__user"), pane.alias("__i")
    ).agg(*_parts(amount_col, decimals))
    # End e, as a number of panes, of the window a row is scored with.
    ends = rows.where(F.col(time_col).isNotNull()).select(
        F.col(user_col).alias("__user"),
        F.floor(F.unix_micros("__end") / F.lit(width)).alias("__i"), F.lit(True).alias("__scored"),
    ).distinct()
    within = Window.partitionBy("__user").orderBy("__i").rangeBetween(-(size_us // width), -1)
    line = panes.unionByName(ends, allowMissingColumns=True)
    sums = line.select(
        "__user", "__i", "__scored", *[F.sum(c).over(within).alias(c) for c in ("c", "n", "s", "sq")]
    )
    return sums.where("__scored and c > 0").select(
        "__user", F.timestamp_micros(F.col("__i") * width).alias("window_end"),
        *_named_stats(decimals),
    )


def windowed_scores(
    df: DataFrame, user_col: str = "user_id", amount_col: str = "amount",
    time_col: str = "event_time", size: str = "1 hour", slide: str = "5 minutes",
    watermark: str = "5 minutes", decimals: int = 2, salts: int = 1,
) -> DataFrame:
    """Each row beside the statistics of the last closed window of its user.

    A row at t meets the one window whose end e satisfies e < t <= e + slide, so
    the join is an equality on (user, e) and not on the user alone. A stream keeps
    panes and sums them where a row needs them; a row is scored once the watermark
    has passed the end of its window. A batch gives the same rows. ``salts`` spreads a hot user of a stream.
    """
    step = micros(slide)
    last_end = F.timestamp_micros(F.floor((F.unix_micros(time_col) - 1) / F.lit(step)) * step)
    rows = df.withWatermark(time_col, watermark)
    ended = rows.withColumn("__end", last_end)
    if not df.isStreaming:
        stats = _stats_where_needed(
            ended, user_col, amount_col, time_col, micros(size), step, decimals
        ).alias("s")
        on = (F.col(f"t.{user_col}") == F.col("s.__user")) & (
            F.col("t.__end") == F.col("s.window_end"))
        return ended.alias("t").join(stats, on, "inner").drop("__end", "__user")
    scored = last_windows(rows, user_col, units_of(F.col(amount_col), decimals), time_col, micros(size), step, salts)
    return scored.select("r.*", "window_end", *_named_stats(decimals))


def windowed_alerts(
    df: DataFrame, user_col: str = "user_id", amount_col: str = "amount",
    time_col: str = "event_time", size: str = "1 hour", slide: str = "5 minutes",
    watermark: str = "5 minutes", decimals: int = 2,
    min_count: int = MIN_COUNT, z_limit: float = Z_LIMIT,
) -> DataFrame:
    """Streaming-capable form of the alerts."""
    scores = windowed_scores(df, user_col, amount_col, time_col, size, slide, watermark, decimals)
    return as_alerts(flag_outliers(scores, amount_col, min_count, z_limit), user_col)
