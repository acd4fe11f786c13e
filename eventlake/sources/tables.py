"""Stored tables: dimensions, upstream stages, recent slices."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.session import shared_dir


def read_table(spark: SparkSession, source: str, fmt: str = "parquet") -> DataFrame:
    """A table by path (anything with a slash) or by catalog name."""
    if "/" in source:
        return spark.read.format(fmt).load(source)
    return spark.read.table(source)


def stream_table(spark: SparkSession, source: str, schema=None, fmt: str = "parquet") -> DataFrame:
    """An upstream stage as a stream, by path or by catalog name."""
    if "/" in source:
        return spark.readStream.format(fmt).schema(schema).load(source)
    return spark.readStream.table(source)


def written_once(df: DataFrame, purpose: str = "rows") -> DataFrame:
    """Rows written to the shared folder and read back: for several readers of rows that are dear to make."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def recent(df: DataFrame, now: Column, period: str = "24 hours", time_col: str = "event_time"):
    """Rows newer than ``now - period``. The bound is a constant, so scans prune with it."""
    return df.where(F.col(time_col) > now - F.expr(f"INTERVAL {period}"))


def union_tracks(tracks: dict[str, DataFrame], tag: str = "runtime") -> DataFrame:
    """Tables by name, missing columns as nulls, each row tagged with its track."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in tracks.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
