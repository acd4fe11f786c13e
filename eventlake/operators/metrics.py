"""Operational figures as tables: latency, throughput, cost, lag, alarms, retention."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions.durations import micros


def _pname(p: float) -> str:
    return f"p{round(p * 100)}_ms"


def latency_percentiles(
    df: DataFrame, group: str, latency: str,
    percentiles: tuple[float, ...] = (0.5, 0.95, 0.99), accuracy: int = 10_000,
) -> DataFrame:
    """Count, percentiles and maximum per group, from a sketch of bounded size."""
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("events"),
        *[F.percentile_approx(latency, p, accuracy).alias(_pname(p)) for p in percentiles],
        F.max(latency).alias("max_ms"),
    )


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows of each (keys, value): ``value`` and ``n``. Summed over keys or time they stay exact, as no sketch does."""
    return df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def counted_percentiles(counts: DataFrame, keys: list[str], value: str, percentiles: tuple[float, ...], width: int = 1_000) -> DataFrame:
    """Exact discrete percentiles from ``value_counts``, one row per group and percentile; null values play no part.

    Ranks are located among coarse value buckets, and only the bucket that holds
    a rank is looked into, so no task sees the values of a whole group.
    """
    counts = counts.where(F.col(value).isNotNull()).select(
        *keys, F.col(value).alias("__v"), F.floor(F.col(value) / F.lit(width)).alias("__b"), F.col("n").alias("__n"))
    by_bucket = Window.partitionBy(*keys).orderBy("__b")
    coarse = (
        counts.groupBy(*keys, "__b").agg(F.sum("__n").alias("__n"))
        .withColumn("__upto", F.sum("__n").over(
            by_bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("__total", F.sum("__n").over(Window.partitionBy(*keys)))
    )
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in percentiles]))
    ranks = (
        coarse.withColumn("percentile", wanted)
        .withColumn("__rank", F.greatest(F.ceil(F.col("percentile") * F.col("__total")), F.lit(1)))
        .where("__rank <= __upto and __rank > __upto - __n")
        .select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__b").alias("__rb"),
                "percentile", "__rank", (F.col("__upto") - F.col("__n")).alias("__before"))
    )
    on = F.col("__b") == F.col("__rb")
    for i, k in enumerate(keys):  # a null key is a group too
        on = on & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    inside = (
        Window.partitionBy(*keys, "__b", "percentile").orderBy("__v")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        counts.join(ranks, on)
        .withColumn("__upto", F.col("__before") + F.sum("__n").over(inside))
        .where("__rank <= __upto and __rank > __upto - __n")
        .select(*keys, "percentile", F.col("__v").alias("value"))
    )


def counted_summary(
    counts: DataFrame, keys: list[str], value: str, percentiles: tuple[float, ...], *totals: Column, width: int = 1_000,
) -> DataFrame:
    """One row per group: ``totals`` (aggregates over ``value`` and ``n``) and the exact percentiles as columns."""
    names = [f"__k{i}" for i in range(len(keys))]
    wide = counted_percentiles(counts, keys, value, percentiles, width).groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]).agg(
        *[F.max(F.when(F.col("percentile") == float(p), F.col("value"))).alias(_pname(p)) for p in percentiles])
    on = F.lit(True)
    for k, n in zip(keys, names, strict=True):
        on = on & F.col(k).eqNullSafe(F.col(n))
    return counts.groupBy(*keys).agg(*totals).join(wide, on, "left").drop(*names)


def exact_latency(
    df: DataFrame, group: str, latency: str, percentiles: tuple[float, ...] = (0.5, 0.95, 0.99),
) -> DataFrame:
    """Count, exact percentiles and maximum per group, at any number of rows."""
    rows = counted_summary(value_counts(df, [group], latency), [group], latency, percentiles,
                           F.sum("n").alias("events"), F.max(latency).alias("max_ms"), width=100)
    return rows.select(group, "events", *[_pname(p) for p in percentiles], "max_ms")


def exact_percentiles(
    df: DataFrame, group: str, value: str,
    percentiles: tuple[float, ...] = (0.5, 0.9, 0.95, 0.99), width: int = 1_000,
) -> DataFrame:
    """Exact discrete percentiles of a whole-number column, one row per group and percentile.

    Rows are counted per (group, value) with a map-side combine first.
    """
    known = df.where(F.col(value).isNotNull())
    return counted_percentiles(value_counts(known, [group], value), [group], value, percentiles, width)


def throughput_per_minute(df: DataFrame, group: str, time_col: str) -> DataFrame:
    minute = F.date_trunc("minute", time_col).alias("minute")
    return df.groupBy(F.col(group), minute).agg(F.count(F.lit(1)).alias("events_per_minute"))


def completeness(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys and surplus rows: exactly-once holds when none is surplus."""
    per_key = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").alias("row_count"), F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("repeated_keys"),
        (F.sum("n") - F.count(F.lit(1))).alias("surplus_rows"),
    )


def approx_completeness(df: DataFrame, key: str, error: float = 0.01) -> DataFrame:
    """Rows and roughly how many distinct keys, from a sketch and without a shuffle of keys."""
    return df.agg(
        F.lit(key).alias("key"), F.count(key).alias("row_count"),
        F.approx_count_distinct(key, error).alias("distinct_keys"),
    )


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def cost_per_million(cost_per_hour: Column, events_per_second: Column) -> Column:
    return F.try_divide(cost_per_hour, events_per_second * 3600) * 1_000_000


def failure_rate(written: Column, failed: Column) -> Column:
    """failed / (written + failed); zero for an empty batch."""
    total = written + failed
    return F.when(total > 0, failed / total).otherwise(F.lit(0.0))


def sink_totals(outcomes: DataFrame) -> DataFrame:
    """Written, failed and failure rate per sink over all batches."""
    return outcomes.groupBy("sink_name").agg(
        F.sum("records_written").alias("written"), F.sum("records_failed").alias("failed"),
        F.max("duration_ms").alias("max_duration_ms"),
    ).withColumn("failure_rate", failure_rate(F.col("written"), F.col("failed")))


def breached_batches(outcomes: DataFrame, max_failure_fraction: float = 0.0) -> DataFrame:
    """Batches whose failure rate halts the stream."""
    rate = failure_rate(F.col("records_written"), F.col("records_failed"))
    return outcomes.withColumn("failure_rate", rate).where(
        F.col("failure_rate") > max_failure_fraction
    )


# Metric names, their source columns and units.
BATCH_METRICS = (
    ("RecordsIn", "records_in", "Count"),
    ("RecordsOut", "records_out", "Count"),
    ("BatchDurationMs", "duration_ms", "Milliseconds"),
    ("LagMs", "lag_ms", "Milliseconds"),
    ("BatchId", "batch_id", "None"),
)
SINK_METRICS = (
    ("SinkRecordsWritten", "records_written", "Count"),
    ("SinkRecordsFailed", "records_failed", "Count"),
    ("SinkWriteDurationMs", "duration_ms", "Milliseconds"),
)


def as_metrics(df: DataFrame, metrics, dimension: str, dimension_col: str, *keep: str) -> DataFrame:
    """Wide batch figures in long form: metric, value, unit, dimension."""
    entries = F.array(*[
        F.struct(
            F.lit(name).alias("metric"), F.col(column).cast("double").alias("value"),
            F.lit(unit).alias("unit"),
        )
        for name, column, unit in metrics
    ])
    label = F.concat(F.lit(f"{dimension}="), F.col(dimension_col)).alias("dimension")
    return df.select(*keep, label, F.explode(entries).alias("e")).select(
        "e.metric", "e.value", "e.unit", "dimension", *keep
    )


def consumer_lag(end_offsets: DataFrame, committed: DataFrame) -> DataFrame:
    """End minus committed offset per partition; never committed counts from the first."""
    keys = ["topic", "partition"]
    done = F.coalesce(F.col("committed_offset"), F.col("first_offset"))
    return (
        end_offsets.join(committed, keys, "left")
        .withColumn("lag", F.greatest(F.col("end_offset") - done, F.lit(0)))
    )


def lag_summary(lags: DataFrame) -> DataFrame:
    return lags.groupBy("topic").agg(
        F.count(F.lit(1)).alias("partitions"), F.sum("lag").alias("total_lag"),
        F.max("lag").alias("max_lag"),
    )


@dataclass(frozen=True)
class Alarm:
    """A metric over a threshold for ``periods`` periods in a row."""

    name: str
    metric: str
    statistic: str
    period: str
    threshold: float
    periods: int = 2


# The platform's alarms.
PLATFORM_ALARMS = (
    Alarm("under-replicated", "UnderReplicatedPartitions", "max", "5 minutes", 0.0),
    Alarm("disk-usage", "KafkaDataLogsDiskUsed", "max", "5 minutes", 75.0),
    Alarm("handler-errors", "Errors", "sum", "5 minutes", 5.0),
    Alarm("downtime", "downtime", "max", "1 minute", 0.0),
)

_STATISTICS = {"avg": F.avg, "max": F.max, "min": F.min, "sum": F.sum}


def metric_series(points: DataFrame, period: str, keys: list[str] | None = None) -> DataFrame:
    """Dashboard series: average, maximum, sum and 99th percentile per metric and period."""
    keys = keys or ["metric"]
    return points.groupBy(F.window("ts", period).alias("w"), *keys).agg(
        F.avg("value").alias("avg_value"), F.max("value").alias("max_value"),
        F.sum("value").alias("sum_value"),
        F.percentile_approx("value", 0.99, 10_000).alias("p99_value"),
        F.count(F.lit(1)).alias("points"),
    ).select(F.col("w.start").alias("period_start"), *keys,
             "avg_value", "max_value", "sum_value", "p99_value", "points")


def evaluate_alarms(points: DataFrame, alarms, keys: list[str] | None = None) -> DataFrame:
    """Runs of consecutive breaching periods, at least as long as their alarm asks for.

    All alarms are judged in one pass: a point meets the alarms of its metric
    (a short list) and is summed up per alarm, series and period. A period
    without points does not breach, so only breaching periods are ordered per
    series and no grid of all periods is built.
    """
    keys = keys or ["dimension"]
    rules = points.sparkSession.createDataFrame(
        [(a.name, a.metric, a.statistic, micros(a.period), float(a.threshold), a.periods)
         for a in alarms],
        "alarm string, __metric string, __statistic string, __width long, __threshold double, "
        "__least int")
    met = points.join(rules, F.col("metric") == F.col("__metric"))
    period = F.floor(F.unix_micros("ts") / F.col("__width")).alias("__p")
    rule = ["alarm", "__statistic", "__width", "__threshold", "__least"]
    summed = met.groupBy(*rule, *keys, period).agg(
        *[f("value").alias(f"__{name}") for name, f in _STATISTICS.items()])
    value = F.lit(None).cast("double")
    for name in _STATISTICS:
        value = F.when(F.col("__statistic") == name, F.col(f"__{name}")).otherwise(value)
    breaching = summed.withColumn("__v", value).where(F.col("__v") > F.col("__threshold"))
    nth = F.row_number().over(Window.partitionBy("alarm", *keys).orderBy("__p"))
    return (
        breaching.withColumn("__run", F.col("__p") - nth)
        .groupBy("alarm", "__width", "__least", *keys, "__run")
        .agg(F.min("__p").alias("__first"), F.max("__p").alias("__last"),
             F.count(F.lit(1)).alias("periods"), F.max("__v").alias("worst_value"))
        .where(F.col("periods") >= F.col("__least"))
        .select(
            "alarm", *keys,
            F.timestamp_micros(F.col("__first") * F.col("__width")).alias("breach_start"),
            F.timestamp_micros((F.col("__last") + 1) * F.col("__width")).alias("breach_end"),
            "periods", "worst_value",
        )
    )


def alarm_runs(points: DataFrame, alarm: Alarm, keys: list[str] | None = None) -> DataFrame:
    """The breaching runs of one alarm."""
    return evaluate_alarms(points, [alarm], keys)


# Rate alerts. Periods are one minute long.
RATE_ALARMS = (
    Alarm("consumer-lag", "EstimatedMaxTimeLag", "max", "1 minute", 300.0, 1),
    Alarm("backpressure", "backPressuredTimeMsPerSecond", "avg", "1 minute", 500.0, 5),
)


def slow_batch_alarm(trigger_ms: int) -> Alarm:
    """Batch duration above twice the trigger interval for ten minutes."""
    return Alarm("slow-batches", "BatchDurationMs", "max", "1 minute", 2.0 * trigger_ms, 10)


def growing_lag(
    points: DataFrame, metric: str = "LagMs", limit: float = 1_800_000.0,
    period: str = "1 minute", keys: list[str] | None = None,
) -> DataFrame:
    """Periods in which the lag is over the limit and above the period before."""
    keys = keys or ["dimension"]
    width = micros(period)
    series = (
        points.where(F.col("metric") == metric)
        .groupBy(*keys, F.floor(F.unix_micros("ts") / F.lit(width)).alias("__p"))
        .agg(F.max("value").alias("lag_value"))
    )
    line = Window.partitionBy(*keys).orderBy("__p")
    # A gap in the series has no period before.
    follows = F.lag("__p").over(line) == F.col("__p") - 1
    return (
        series.withColumn("previous_value", F.when(follows, F.lag("lag_value").over(line)))
        .where((F.col("lag_value") > limit) & (F.col("lag_value") > F.col("previous_value")))
        .select(*keys, F.timestamp_micros(F.col("__p") * width).alias("period_start"),
                "lag_value", "previous_value")
    )


def falling_behind(
    rates: DataFrame, job_col: str = "job", batches: int = 3, chunk: int = 100_000
) -> DataFrame:
    """Batches that end a run of ``batches`` consecutive ids, all slower than their input.

    The batch line of a job is cut into chunks of ids; the last ids of a chunk
    are copied to the next one, so runs across a border are found and a job with
    very many batches is spread over tasks.
    """
    own = F.floor(F.col("batch_id") / F.lit(chunk))
    reached = F.floor((F.col("batch_id") + (batches - 1)) / F.lit(chunk))
    slow = rates.where(F.col("processed_per_second") < F.col("input_per_second"))
    last = (
        Window.partitionBy(job_col, "__chunk").orderBy("batch_id")
        .rangeBetween(-(batches - 1), 0)
    )
    return (
        slow.withColumn("__chunk", F.explode(F.array_distinct(F.array(own, reached))))
        .withColumn("__run", F.count(F.lit(1)).over(last))
        .where((F.col("__run") == batches) & (F.col("__chunk") == own))
        .drop("__chunk", "__run")
    )


# Days kept per destination; the lake keeps all, moving it after 90 days.
TIER_POLICY = (("hot", 1 / 24, None), ("search", 30.0, None), ("olap", 90.0, None),
               ("lake", None, 90.0))
# Hours kept per topic.
TOPIC_HOURS = {
    "cdc.public.orders": 168, "cdc.public.order_items": 168, "cdc.public.customers": 168,
    "cdc.inventory.stock_levels": 168, "cdc.sessions.user_sessions": 72,
    "app.clickstream": 72, "app.transactions": 168, "ws-broadcast": 1,
    "__debezium-heartbeat": 24, "__s3-sink-dlq": 168,
}


def retention_actions(
    df: DataFrame, policy: DataFrame, now: Column, time_col: str, tier_col: str = "tier",
) -> DataFrame:
    """Each row with keep, move or expire by its age and its tier's policy.

    ``policy`` has one row per tier: keep_days and move_days, null for never. A
    tier without a policy keeps its rows.
    """
    age_days = (F.unix_micros(now) - F.unix_micros(time_col)) / F.lit(86_400_000_000)
    action = (
        F.when(age_days > F.col("keep_days"), "expire")
        .when(age_days > F.col("move_days"), "move")
        .otherwise("keep")
    )
    return (
        df.join(policy, tier_col, "left")
        .withColumn("action", action).drop("keep_days", "move_days")
    )
