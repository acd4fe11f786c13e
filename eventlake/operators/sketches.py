"""Latency quantiles from mergeable sketches: stored once for each minute, rolled up to any longer time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.durations import micros

# Lengths that dashboards and reports ask for.
LEVELS = ("300 seconds", "1 hour", "1 day")


def _start(at: Column, width: str) -> Column:
    us = micros(width)
    return F.timestamp_micros(F.floor(F.unix_micros(at) / F.lit(us)) * us)


def value_sketches(rows: DataFrame, value_col: str, time_col: str, keys: list[str], width: str = "1 minute", k: int = 800) -> DataFrame:
    """``window_start``, ``keys``, ``sketch`` and ``n`` of each window that has values (long; nulls play no part).

    A sketch takes a few KB whatever it has seen and is combined before the
    shuffle, so a hot key sends one row per task and window. Ranks are right to
    about 1.5 divided by ``k`` to the power 0.9 (0.4 percent for 800); up to
    ``k`` values are held exactly.
    """
    known = rows.where(F.col(value_col).isNotNull() & F.col(time_col).isNotNull())
    return known.groupBy(_start(F.col(time_col), width).alias("window_start"), *keys).agg(
        F.kll_sketch_agg_bigint(F.col(value_col).cast("long"), k).alias("sketch"), F.count(F.lit(1)).alias("n"))


def rolled_up(sketches: DataFrame, keys: list[str], width: str, k: int = 800) -> DataFrame:
    """Sketches of a longer width from stored ones; no row is read again. Widths that are whole numbers of each other give the same rows in any order of rolling up."""
    return sketches.groupBy(_start(F.col("window_start"), width).alias("window_start"), *keys).agg(
        F.kll_merge_agg_bigint("sketch", k).alias("sketch"), F.sum("n").alias("n"))


def sketch_quantiles(sketches: DataFrame, quantiles: dict[str, float]) -> DataFrame:
    """The sketch replaced by named quantiles: a value of the data whose rank is the least that reaches each."""
    named = [F.kll_sketch_get_quantile_bigint("sketch", F.lit(p)).alias(name) for name, p in quantiles.items()]
    return sketches.select(*[c for c in sketches.columns if c != "sketch"], *named)


def missing_keys(
    produced: DataFrame, stored: DataFrame, key: str, time_col: str, keys: list[str], width: str = "1 hour",
    slices: int = 1, lg_entries: int = 12,
) -> DataFrame:
    """Keys that were produced and are not stored, exactly: ``keys``, ``window_start``, ``key``.

    Each cell (``keys``, window and one of ``slices`` shares of the keys) of both sides has a theta
    sketch, combined before the shuffle. A cell whose difference is empty, and which the sketches
    hold exactly (up to 2 ** ``lg_entries`` keys), lacks nothing; only the rows of the others
    are compared. Choose ``slices`` so that usual cells are held exactly: a larger one is compared in any case.
    A key has the same time on both sides; repeated keys count once, rows without a key or a time are left out.
    """
    def cells(df: DataFrame) -> DataFrame:
        known = df.where(F.col(key).isNotNull() & F.col(time_col).isNotNull())
        return known.select(*keys, key, _start(F.col(time_col), width).alias("window_start"),
                            F.pmod(F.xxhash64(key), F.lit(slices)).alias("slice"))

    def sketched(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*cell).agg(F.theta_sketch_agg(F.col(key).cast("string"), lg_entries).alias(name))

    cell = [*keys, "window_start", "slice"]
    made, held = cells(produced), cells(stored)
    both = sketched(made, "made").join(sketched(held, "held"), cell, "left")
    lacking = F.col("held").isNull() | (F.theta_sketch_estimate("made") > (1 << lg_entries)) | (
        F.theta_sketch_estimate("held") > (1 << lg_entries)) | (F.theta_sketch_estimate(F.theta_difference("made", "held")) > 0)
    open_cells = both.where(lacking).select(*cell)
    left, right = made.join(open_cells, cell, "left_semi"), held.join(open_cells, cell, "left_semi")
    return left.join(right, [*cell, key], "left_anti").select(*keys, "window_start", key).distinct()
