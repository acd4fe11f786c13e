"""Enrichment joins: static dimension, versioned dimension, two event streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions.durations import micros


def enrich(df: DataFrame, dim: DataFrame, key: str, dim_cols: list[str], how: str = "left") -> DataFrame:
    """Join a table or stream with the needed columns of a batch dimension.

    No side is forced to be broadcast: the optimizer and adaptive execution
    choose by the dimension's size at run time, for a stream in each
    micro-batch, and a shuffled join splits the partitions of hot keys. A hint
    on ``dim`` still holds.
    """
    return df.join(dim.select(key, *dim_cols), on=key, how=how)


def unmatched_keys(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Keys without a dimension row and how many rows carry them."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    return per_key.join(dim.select(key), on=key, how="left_anti")


def duplicate_keys(dim: DataFrame, key: str) -> DataFrame:
    """Dimension keys that would multiply enriched rows (the join expects none)."""
    return (
        dim.groupBy(key).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")
    )


def with_margin(df: DataFrame) -> DataFrame:
    """total_amount - qty * unit_cost; null when the product is unknown."""
    margin = F.col("total_amount") - F.col("qty") * F.col("unit_cost")
    return df.withColumn("margin_amount", margin)


def refresh_dimension(
    dim: DataFrame, refresh_time: Column | None = None, loaded_col: str = "_loaded_at"
) -> DataFrame:
    """Dimension rows loaded up to a point in time, or all of them.

    Called inside ``foreachBatch`` it re-reads the dimension per micro-batch, so
    changes arrive without a restart.
    """
    return dim if refresh_time is None else dim.where(F.col(loaded_col) <= refresh_time)


def _renamed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select([F.col(c).alias(f"{prefix}{c}") for c in df.columns])


def interval_join(
    left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
    window: str = "1 hour", how: str = "inner",
    left_watermark: str = "10 minutes", right_watermark: str = "10 minutes",
    right_prefix: str = "r_",
) -> DataFrame:
    """Pairs of one key with ``right.t <= left.t <= right.t + window``.

    Right-side columns get ``right_prefix``. Besides the key, both sides share a
    time bucket as wide as the window: a row of the one side lies in its own
    bucket, the copied side in its own and the neighbouring one. A hot key is
    thereby spread over the time line, and a row meets only the two buckets that
    can hold its partners instead of the key's whole history. The watermarks
    bound the state of streams and change nothing in batch.
    """
    how = how.replace("outer", "").rstrip("_") or "full"
    if how not in ("inner", "left", "right", "full", "left_semi", "left_anti"):
        raise ValueError(f"Unsupported join type: {how}")
    l_rows = left.withWatermark(left_time, left_watermark)
    r_rows = _renamed(right.withWatermark(right_time, right_watermark), right_prefix)
    r_key, r_at = F.col(f"{right_prefix}{key}"), F.col(f"{right_prefix}{right_time}")
    l_at = F.col(left_time)
    width = micros(window)
    in_range = (l_at >= r_at) & (l_at <= r_at + F.expr(f"INTERVAL {window}"))
    if how == "full" and (left.isStreaming or right.isStreaming):
        return l_rows.join(r_rows, (F.col(key) == r_key) & in_range, "full")
    if how == "full":
        kept = interval_join(left, right, key, left_time, right_time, window, "left",
                             right_prefix=right_prefix)
        lone = interval_join(left, right, key, left_time, right_time, window, "right",
                             right_prefix=right_prefix).where(l_at.isNull())
        return kept.unionByName(lone)

    def bucket(at: Column) -> Column:
        return F.floor(F.unix_micros(at) / F.lit(width))

    # The side whose rows must appear once keeps one bucket; the other is copied.
    # A row without a time has no bucket and stays unmatched, but is not lost.
    if how == "right":
        l_rows = l_rows.withColumn("__b", F.explode(F.array(bucket(l_at) - 1, bucket(l_at))))
        r_rows = r_rows.withColumn("__rb", bucket(r_at))
    else:
        l_rows = l_rows.withColumn("__b", bucket(l_at))
        r_rows = r_rows.withColumn("__rb", F.explode(F.array(bucket(r_at), bucket(r_at) + 1)))
    on = (F.col(key) == r_key) & (F.col("__b") == F.col("__rb")) & in_range
    return l_rows.join(r_rows, on, how).drop("__b", "__rb")


def version_intervals(
    versions: DataFrame, key: str, updated_col: str, chunk: str = "1 day"
) -> DataFrame:
    """Validity [valid_from, valid_to) of each version; the newest is open-ended.

    Versions are ordered per (key, chunk of time). The first version of the next
    chunk that has any closes the chunk, so a key with very many versions is
    spread over its chunks.
    """
    at = F.col(updated_col)
    rows = versions.withColumn("__c", F.floor(F.unix_micros(at) / F.lit(micros(chunk))))
    firsts = rows.groupBy(key, "__c").agg(F.min(at).alias("__first"))
    following = F.lead("__first").over(Window.partitionBy(key).orderBy("__c"))
    closing = firsts.select(
        key, "__c", following.alias(updated_col), F.lit(1).alias("__closing")
    ).where(at.isNotNull())
    line = rows.withColumn("__closing", F.lit(0)).unionByName(closing, allowMissingColumns=True)
    in_chunk = Window.partitionBy(key, "__c").orderBy("__closing", updated_col)
    return (
        line.withColumn("valid_from", at).withColumn("valid_to", F.lead(updated_col).over(in_chunk))
        .where("__closing = 0").drop("__c", "__closing")
    )


def asof_join(
    df: DataFrame, versions: DataFrame, key: str, time_col: str, updated_col: str,
    dim_cols: list[str], few_versions: bool = False, chunk: str = "1 day",
) -> DataFrame:
    """Left join to the newest version of ``key`` with ``updated_col <= time_col``.

    Versions without a key or a time are never valid, and rows without a key or
    a time find none. Both routes give the same rows:

    * ``few_versions`` (the caller knows that a key has a handful), and every
      stream: validity intervals, joined by key with the interval as residual;
      a small table is broadcast by the optimizer's own choice.
    * Otherwise facts and versions are merged on the time line of each (key,
      chunk of time), after the version valid at the start of every chunk was
      worked out from the versions and the distinct chunks alone. The rows of a
      hot key are spread over its chunks and read once.
    """
    needed = versions.select(key, updated_col, *dim_cols).where(
        F.col(key).isNotNull() & F.col(updated_col).isNotNull())
    if few_versions or df.isStreaming:
        spans = version_intervals(needed, key, updated_col).drop(updated_col)
        spans = spans.withColumnRenamed(key, "__key")
        at = F.col(time_col)
        on = (
            (F.col(key) == F.col("__key")) & (at >= F.col("valid_from"))
            & (F.col("valid_to").isNull() | (at < F.col("valid_to")))
        )
        return df.join(spans, on, "left").drop("__key", "valid_from", "valid_to")
    return _asof_by_chunk(df, needed, key, time_col, updated_col, dim_cols, micros(chunk))


def _asof_by_chunk(
    df: DataFrame, versions: DataFrame, key: str, time_col: str, updated_col: str,
    dim_cols: list[str], chunk_us: int,
) -> DataFrame:
    def chunk_of(at: Column) -> Column:
        return F.floor(F.unix_micros(at) / F.lit(chunk_us))

    dim = F.struct(*dim_cols)
    facts = df.select(
        F.col(key).alias("__key"), chunk_of(F.col(time_col)).alias("__chunk"),
        F.unix_micros(time_col).alias("__us"), F.lit(1).alias("__kind"),
        F.struct(*df.columns).alias("__row"),
    )
    known = versions.select(
        F.col(key).alias("__key"), chunk_of(F.col(updated_col)).alias("__chunk"),
        F.unix_micros(updated_col).alias("__us"), F.lit(0).alias("__kind"),
        dim.alias("__dim"),
    )
    # Version carried into each chunk that has facts. Both inputs are reduced on
    # the map side first (newest version per chunk, distinct chunks of facts), so
    # a key brings at most two rows per chunk to the ordered step.
    newest = known.groupBy("__key", "__chunk").agg(F.max_by("__dim", "__us").alias("__dim"))
    starts = facts.select("__key", "__chunk").where("__chunk is not null").distinct()
    earlier = (
        Window.partitionBy("__key").orderBy("__chunk", "__kind")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        starts.withColumn("__kind", F.lit(0))
        .unionByName(newest.withColumn("__kind", F.lit(1)), allowMissingColumns=True)
        .withColumn("__dim", F.last("__dim", ignorenulls=True).over(earlier))
        .where("__kind = 0 and __dim is not null")
        # Ranked before a version that starts exactly with the chunk.
        .withColumn("__kind", F.lit(-1)).withColumn("__us", F.col("__chunk") * chunk_us)
    )
    in_chunk = (
        Window.partitionBy("__key", "__chunk").orderBy("__us", "__kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    merged = (
        facts.unionByName(known, allowMissingColumns=True)
        .unionByName(carried, allowMissingColumns=True)
        .withColumn("__dim", F.last("__dim", ignorenulls=True).over(in_chunk))
        .where("__kind = 1")
    )
    return merged.select("__row.*", *[F.col(f"__dim.{c}").alias(c) for c in dim_cols])
