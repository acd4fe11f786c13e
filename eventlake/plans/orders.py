"""Order changes: decode, enrich, margin, destinations; also bronze, silver and gold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.functions.envelope import (
    changelog, dead_letters, decode_good, decode_or_reject, flatten_after, good_changes, upserts,
)
from eventlake.operators.joins import asof_join, enrich, with_margin
from eventlake.operators.quality import ORDER_EXPECTATIONS, enforce
from eventlake.schemas import ORDER_SCHEMA, UPSERT_OPS
from eventlake.session import stream_settings
from eventlake.sinks.document import DocumentSink
from eventlake.sinks.keyed import KeyedSink
from eventlake.sinks.lake import LakeSink, lake_rows
from eventlake.sources.tables import written_once
from eventlake.streaming.runs import batch_table, start_per_sink, start_query, start_shared, start_table
from eventlake.streaming.temporal import asof_join_streams

DIM_COLS = ["product_name", "category", "brand", "unit_cost"]
LINEAGE = ("event_id", "event_time", "cdc_op")
RAW = ("source_lsn", "raw_topic", "raw_partition", "raw_offset")
# Newest last: the log position of the source, then the offset in the partition.
POSITION = ("source_lsn", "raw_offset")
# Fixed value: bytes of silver files in one micro-batch of gold, which shuffles them.
GOLD_BYTES = 512 << 20


def order_rows(
    broker_rows: DataFrame, row_schema: T.StructType = ORDER_SCHEMA, keep: tuple[str, ...] = RAW
) -> DataFrame:
    """Created, updated and snapshot orders as flat rows; broken messages are left to the dead letters."""
    changes = upserts(decode_good(broker_rows, row_schema))
    return flatten_after(changes, row_schema, *LINEAGE, *keep)


def enriched_orders(
    broker_rows: DataFrame, products: DataFrame, row_schema: T.StructType = ORDER_SCHEMA
) -> DataFrame:
    """Orders with product columns and margin; works on tables and streams."""
    orders = order_rows(broker_rows, row_schema)
    return with_margin(enrich(orders, products, "product_id", DIM_COLS))


def versioned_orders(
    broker_rows: DataFrame, product_versions: DataFrame, updated_col: str = "_updated_at",
    row_schema: T.StructType = ORDER_SCHEMA, few_versions: bool = False, **stream_options,
) -> DataFrame:
    """Orders with the product version valid at their event time, margin and date.

    The as-of join by chunks reads its rows twice; a table's are written once
    before, as every reading would parse the messages again.
    Where the versions are a stream as well, ``stream_options`` go to
    ``asof_join_streams``; the orders keep the watermark of the change log.
    """
    orders = changelog(broker_rows, row_schema).where(F.col("op").isin(*UPSERT_OPS))
    orders = orders.drop("op", "source_ts_ms")
    dims = ["product_name", "category", "unit_cost"]
    if product_versions.isStreaming:
        joined = asof_join_streams(
            orders, product_versions, "product_id", "event_time", updated_col, dims, allowed=None, **stream_options)
    else:
        if not (few_versions or orders.isStreaming):
            orders = written_once(orders, "versioned-orders")
        joined = asof_join(
            orders, product_versions, "product_id", "event_time", updated_col, dims, few_versions)
    return lake_rows(with_margin(joined), "order_ts")


def refreshing_products(read_products, callback):
    """``foreachBatch`` callback that reads the dimension anew for every micro-batch.

    For plain order rows as input: dimension changes take effect without a restart.
    """
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        enriched = enrich(batch, read_products(), "product_id", DIM_COLS)
        callback(with_margin(enriched), batch_id)

    return on_batch


def lake_copy(
    broker_rows: DataFrame, products: DataFrame, row_schema: T.StructType = ORDER_SCHEMA
) -> DataFrame:
    """The one-destination variant: log position kept, partition date added."""
    orders = order_rows(broker_rows, row_schema, keep=("source_lsn",))
    cols = ["product_name", "category", "unit_cost"]
    enriched = with_margin(enrich(orders, products, "product_id", cols))
    return lake_rows(enriched.drop("event_id", "cdc_op"), "order_ts")


def start_dead_letters(
    broker_rows: DataFrame, path: str | None, checkpoint: str, trigger: str | None,
    row_schema: T.StructType = ORDER_SCHEMA,
) -> list:
    """A query that stores the messages an order job cannot use, with the reason; none without a path."""
    if path is None:
        return []
    rejected = dead_letters(decode_or_reject(broker_rows, row_schema))
    return [start_query(rejected, batch_table(path), f"{checkpoint}/dead-letters", trigger)]


def run_lake_copy(
    broker_rows: DataFrame, products: DataFrame, sink, checkpoint: str,
    trigger: str | None = "5 seconds", dead_letter_path: str | None = None,
):
    """The one-destination variant as a query."""
    queries = start_per_sink(lake_copy(broker_rows, products), [sink], checkpoint, trigger)
    return queries + start_dead_letters(broker_rows, dead_letter_path, checkpoint, trigger)


def bronze(broker_rows: DataFrame, row_schema: T.StructType = ORDER_SCHEMA) -> DataFrame:
    """All messages, decoded, with the reason why one is no change; nothing left out yet."""
    return decode_or_reject(broker_rows, row_schema)


def silver(bronze_rows: DataFrame, row_schema: T.StructType = ORDER_SCHEMA, observation=None):
    """Flat orders that satisfy the drop rules; rules are judged before projection."""
    kept = enforce(good_changes(bronze_rows), ORDER_EXPECTATIONS, observation)
    return flatten_after(kept, row_schema, "event_time")


def gold(silver_rows: DataFrame, products: DataFrame) -> DataFrame:
    cols = ["product_name", "category", "unit_cost"]
    return lake_rows(with_margin(enrich(silver_rows, products, "product_id", cols)))


def order_sinks(open_hot, open_search, lake_path: str, metrics_path: str | None = None) -> list:
    """Hot, search and cold destinations of the enriched orders."""
    return [
        KeyedSink("orders-hot", open_hot, "order_id", "order:", 3600, POSITION,
                  metrics_path=metrics_path),
        DocumentSink("orders-search", open_search, "orders-{yyyy_mm_dd}", "order_ts", POSITION,
                     metrics_path=metrics_path),
        LakeSink("orders-cold", path=lake_path, metrics_path=metrics_path),
    ]


def run_enrichment(
    broker_rows: DataFrame, products: DataFrame, sinks: list, checkpoint: str,
    trigger: str | None = "5 seconds", shared: bool = False, dead_letter_path: str | None = None,
):
    """Stream to all sinks, each with its own query, or all from one shared plan.

    The shared plan stores the dead letters too, so a message is parsed once for all destinations.
    """
    if shared and dead_letter_path is not None:
        write = shared_orders(products, sinks, dead_letter_path)
        return [start_query(usable_or_rejected(broker_rows), write, f"{checkpoint}/shared", trigger)]
    enriched = enriched_orders(broker_rows, products)
    rejects = start_dead_letters(broker_rows, dead_letter_path, checkpoint, trigger)
    if shared:
        return [start_shared(enriched, sinks, checkpoint, trigger), *rejects]
    return start_per_sink(enriched, sinks, checkpoint, trigger) + rejects


def usable_or_rejected(broker_rows: DataFrame, row_schema: T.StructType = ORDER_SCHEMA) -> DataFrame:
    """Flat orders and dead letters in one frame, told apart by ``reject_reason``; only a dead letter has its raw text."""
    decoded = decode_or_reject(broker_rows, row_schema)
    bad = F.col("reject_reason").isNotNull()
    needed = decoded.where((bad & (F.col("reject_reason") != "tombstone")) | (~bad & F.col("cdc_op").isin(*UPSERT_OPS)))
    needed = needed.withColumn("raw_value", F.when(bad, F.col("raw_value")))
    return flatten_after(needed, row_schema, *LINEAGE, *RAW, "kafka_ts", "reject_reason", "raw_value")


def shared_orders(products: DataFrame, sinks: list, dead_letter_path: str):
    """``foreachBatch`` callback for ``usable_or_rejected``: dead letters first, then every sink, from one computed batch."""
    park, writers = batch_table(dead_letter_path), [s.foreach_batch() for s in sinks]

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            park(dead_letters(batch), batch_id)
            orders = batch.where(F.col("reject_reason").isNull()).drop("kafka_ts", "reject_reason", "raw_value")
            enriched = with_margin(enrich(orders, products, "product_id", DIM_COLS))
            for write in writers:
                write(enriched, batch_id)
        finally:
            batch.unpersist()

    return on_batch


def run_versioned(
    broker_rows: DataFrame, product_versions: DataFrame, open_search, lake_path: str,
    checkpoint: str, trigger: str | None = "5 seconds", dead_letter_path: str | None = None,
):
    """As-of enrichment to search (one document per order) and lake from one plan.

    Returns the query, or with a dead-letter path a list of both queries.
    """
    rows = versioned_orders(broker_rows, product_versions)
    sinks = [
        DocumentSink("orders-search", open_search, "orders-{yyyy_mm_dd}", "order_ts",
                     POSITION, id_col="order_id"),
        LakeSink("orders-cold", path=lake_path),
    ]
    query = start_shared(rows, sinks, checkpoint, trigger)
    rejects = start_dead_letters(broker_rows, dead_letter_path, checkpoint, trigger)
    return [query, *rejects] if rejects else query


def run_stages(spark, broker_rows: DataFrame, products: DataFrame, base: str,
               trigger: str | None = None, gold_partition: tuple[str, ...] = ("event_date",),
               observation: str | None = "quality", gold_bytes: int = GOLD_BYTES) -> list:
    """Bronze, silver and gold as three chained tables, each with its own checkpoint.

    The counts of the quality rules come with the progress of the silver query,
    as observed metrics of the name ``observation``.

    Without a trigger every stage drains its input before the next one starts.
    Gold takes files of ``gold_bytes`` at a time, so that its shuffles don't grow with the table.
    """
    def start(df, stage, partition_by=()):
        with stream_settings(spark):  # a file sink goes by the settings of the session, not of a clone
            query = start_table(df, f"{base}/{stage}", f"{base}/_checkpoints/{stage}",
                                partition_by, trigger)
            if trigger is None:
                query.awaitTermination()
        return query

    first = bronze(broker_rows)
    queries = [start(first, "bronze")]
    second = silver(spark.readStream.schema(first.schema).parquet(f"{base}/bronze"),
                    observation=observation)
    queries.append(start(second, "silver"))
    stored = spark.readStream.schema(second.schema).option("maxBytesPerTrigger", gold_bytes).parquet(f"{base}/silver")
    third = gold(stored, products)
    queries.append(start(third, "gold", gold_partition))
    return queries


def margin_by_brand(enriched: DataFrame) -> DataFrame:
    """Order count and exact margin per brand."""
    return enriched.groupBy("brand").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.col("total_amount").cast("decimal(18,2)")).cast("double").alias("revenue"),
        F.sum(F.round("margin_amount", 2).cast("decimal(18,2)")).cast("double").alias("margin"),
    )
