"""Watermark delays from measured lateness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlake.sinks.base import overwrite_partitions

_FINE = 3  # bits after the leading one that tell buckets apart: bounds are an eighth of a power of two from each other


def lateness_bucket(us: Column) -> Column:
    """Bucket of a lateness in microseconds (0 or more): its number of bits and the three bits after the first."""
    bits = F.length(F.bin(us))
    fine = F.call_function("shiftright", us, bits - 1 - _FINE).bitwiseAND(F.lit((1 << _FINE) - 1))
    return F.when(us < (1 << _FINE), us).otherwise(bits.cast("long") * (1 << _FINE) + fine)


def bucket_end(bucket: Column) -> Column:
    """The largest lateness of a bucket."""
    bits, fine = F.shiftright(bucket, _FINE), bucket.bitwiseAND(F.lit((1 << _FINE) - 1))
    shift = (bits - 1 - _FINE).cast("int")
    return F.when(bucket < (1 << _FINE), bucket).otherwise((fine + 1 + (1 << _FINE)) * F.pow(F.lit(2.0), shift).cast("long") - 1)


class LatenessHistogram:
    """``foreachBatch`` callback that counts the rows of every batch by how far they lie behind all batches before.

    A row that is not behind counts as late by 0. Each batch stores one row a
    bucket (some hundreds at most, whatever its size) and the latest time up to
    its end, which the next batch reads; a batch that runs again replaces its own.
    """

    def __init__(self, base: str, time_col: str):
        self.counts, self.latest, self.time_col = f"{base}/lateness", f"{base}/latest", time_col

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        us, before = F.unix_micros(self.time_col), None
        if batch_id > 0:
            before = batch.sparkSession.read.schema("us long").parquet(f"{self.latest}/batch_id={batch_id - 1}").first()[0]
        late = F.greatest(F.lit(before).cast("long") - us, F.lit(0)) if before is not None else F.lit(0).cast("long")
        number = F.lit(batch_id).cast("long").alias("batch_id")
        timed = batch.where(F.col(self.time_col).isNotNull())
        counts = timed.groupBy(lateness_bucket(late).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.max(us).alias("newest")).persist()
        try:
            overwrite_partitions(counts.select("bucket", "n", number), self.counts, ["batch_id"])
            newest = counts.agg(F.greatest(F.max("newest"), F.lit(before).cast("long")).alias("us")).select("us", number)
            overwrite_partitions(newest, self.latest, ["batch_id"])
        finally:
            counts.unpersist()

    def histogram(self, spark: SparkSession) -> DataFrame:
        """``bucket``, ``n`` over all batches: counts of batches add up."""
        rows = spark.read.schema("bucket long, n long, batch_id long").parquet(self.counts)
        return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def watermark_advice(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """For each share of rows that may be late the least delay that keeps to it: ``share``, ``delay_us``, ``late_rows``.

    Delays are ends of buckets, so they are an eighth too long at most.
    """
    targets = histogram.sparkSession.createDataFrame([(float(s),) for s in shares], "share double")
    beyond = F.sum("n").over(Window.orderBy(F.desc("bucket")))  # some hundreds of buckets
    ranked = histogram.select("bucket", (beyond - F.col("n")).alias("late_rows"), F.sum("n").over(Window.partitionBy()).alias("total"))
    fit = ranked.join(targets, F.col("late_rows") <= F.col("share") * F.col("total"))
    least = fit.groupBy("share").agg(F.min(F.struct("bucket", "late_rows")).alias("m"))
    return least.select("share", bucket_end(F.col("m.bucket")).alias("delay_us"), F.col("m.late_rows").alias("late_rows"))
