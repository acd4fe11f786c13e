"""Bounded samples and intermediate tables that every executor can read."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.session import shared_dir

_HASH_SPAN = 1 << 32
# Arrow batches for Python workers, and row groups of written tables: a task holds one of them, and scans are split between them.
_SETTINGS = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m", "parquet.block.size": str(16 << 20)}


def remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % divisor


def bounded(spark: SparkSession) -> SparkSession:
    """The session with the settings that bound what a task holds."""
    for name, value in _SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: later steps no longer depend on executors that made it.

    Python workers get Arrow batches of 4 MB, or of one row where that is larger;
    row groups have about 16 MB.
    """
    path = shared_dir(bounded(df.sparkSession), purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Tables written inside get at most so many rows in an Arrow batch: for rows that are large each."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def sampled(df: DataFrame, key: str, bound: int) -> DataFrame:
    """About ``bound`` rows at most, chosen by a hash of ``key``: all rows of a smaller table, the same on each run."""
    n = df.count()
    if n <= bound:
        return df
    return df.where(F.pmod(F.xxhash64(F.col(key), F.lit(17)), F.lit(_HASH_SPAN)) < int(_HASH_SPAN * bound / n))


def perhaps_among(rows: DataFrame, asked: DataFrame, key: str) -> DataFrame:
    """Leaves out most rows whose ``key`` (a long) isn't asked for, before they are shuffled.

    Goes by a bitmap of 2**24 places, 2 MB at most, which is broadcast: a row
    that is asked for always stays, others stay where their places collide.
    """
    places = 1 << 24
    wanted = F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(places))
    bitmaps = asked.groupBy(F.bitmap_bucket_number(wanted).alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(wanted)).alias("__bits"))
    bit = F.bitmap_bit_position(wanted)
    byte = F.conv(F.hex(F.substring("__bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    marked = rows.join(F.broadcast(bitmaps), F.bitmap_bucket_number(wanted) == F.col("__bucket"))
    return marked.where(F.getbit(byte, (bit % 8).cast("int")) == 1).select(*[f"`{c}`" for c in rows.columns])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bounded(spark).read.parquet(f"{sf_dir}/{name}.parquet")
