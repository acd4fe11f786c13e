"""Decoding, enrichment and quality of order changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlake.functions import envelope as env
from eventlake.functions.tokens import idempotency_token
from eventlake.operators import joins, quality
from eventlake.plans import orders as plans
from eventlake.queries import feeds
from eventlake.queries.feeds import LINES, PRODUCTS, VERSIONS, plain_times
from eventlake.schemas import ORDER_SCHEMA
from eventlake.sources.broker import from_position, matching_topics, stored_positions
from eventlake.sources.tables import written_once

ORDER_COLS = [f.name for f in ORDER_SCHEMA.fields]


def cdc_decode(spark, sf_dir):
    """Flat decoded changes; broken messages stay as rows of nulls."""
    rows = env.decode_changes(feeds.line_changes(spark, sf_dir), ORDER_SCHEMA)
    return plain_times(rows.select(
        "event_id", "event_time", "cdc_op", "source_db", "source_schema", "source_table",
        "raw_topic", "raw_partition", "raw_offset", "kafka_ts",
        F.col("before.qty").alias("before_qty"), F.col("after.order_id").alias("after_order_id"),
        F.col("after.total_amount").alias("after_total_amount"),
        F.col("after.order_ts").alias("after_order_ts"),
    ))


def cdc_event_id(spark, sf_dir):
    rows = env.decode_changes(feeds.line_changes(spark, sf_dir), ORDER_SCHEMA, images=())
    return rows.select("event_id", F.col("source_lsn").isNull().alias("from_offset")).groupBy(
        "from_offset"
    ).agg(F.count(F.lit(1)).alias("rows"), F.min("event_id").alias("first_id"),
          F.max("event_id").alias("last_id"))


def cdc_quarantine(spark, sf_dir):
    rows = env.decode_or_reject(feeds.line_changes(spark, sf_dir), ORDER_SCHEMA)
    return rows.select(
        "raw_partition", "raw_offset", F.coalesce("reject_reason", F.lit("good")).alias("verdict")
    )


def dead_letter_rows(spark, sf_dir):
    rows = env.decode_or_reject(feeds.line_changes(spark, sf_dir), ORDER_SCHEMA)
    return plain_times(env.dead_letters(rows).drop("raw_value"))


def order_rows(spark, sf_dir):
    """Op filter and flattening of the new image."""
    rows = plans.order_rows(feeds.line_changes(spark, sf_dir))
    return plain_times(rows.drop("raw_topic"))


def cdc_lag(spark, sf_dir):
    """Lag between change and ingestion, exact and from whole seconds."""
    rows = env.decode_good(feeds.line_changes(spark, sf_dir), ORDER_SCHEMA)
    at, seen = F.col("event_time"), F.col("kafka_ts")
    return rows.groupBy("raw_partition").agg(
        F.max(env.lag_ms(at, seen)).alias("max_lag_ms"),
        F.sum(env.lag_ms(at, seen, whole_seconds=True)).alias("sum_whole_lag_ms"),
        F.count(F.lit(1)).alias("rows"),
    )


def topic_routing(spark, sf_dir):
    """Pattern subscription over change and application topics, with the name's parts."""
    both = feeds.line_changes(spark, sf_dir).unionByName(feeds.click_messages(spark, sf_dir))
    prefix, schema, name = env.topic_parts(F.col("topic"))
    return (
        matching_topics(both).groupBy(
            prefix.alias("prefix"), schema.alias("source_schema"), name.alias("source_table")
        ).agg(F.count(F.lit(1)).alias("messages"), F.count("value").alias("with_value"))
    )


def start_offsets(spark, sf_dir):
    """Stored rows from a given offset per partition; unnamed partitions from the first."""
    rows = from_position(
        feeds.line_changes(spark, sf_dir),
        offsets={"cdc.public.orders": {0: 4_000, 1: -2, 2: -1}},
    )
    return rows.groupBy("partition").agg(
        F.count(F.lit(1)).alias("messages"), F.min("offset").alias("first_offset")
    )


def start_timestamp(spark, sf_dir):
    rows = from_position(
        feeds.line_changes(spark, sf_dir), "AT_TIMESTAMP",
        timestamp=F.lit("1999-06-01 00:00:00").cast("timestamp"),
    )
    return plain_times(rows.groupBy("partition").agg(
        F.count(F.lit(1)).alias("messages"), F.min("timestamp").alias("first_time")
    ))


def topic_positions(spark, sf_dir):
    return stored_positions(feeds.line_changes(spark, sf_dir))


def broadcast_enrich_margin(spark, sf_dir):
    rows = plans.enriched_orders(feeds.line_changes(spark, sf_dir), feeds.products(spark, sf_dir))
    return plans.margin_by_brand(rows)


def enriched_order_rows(spark, sf_dir):
    rows = plans.enriched_orders(feeds.line_changes(spark, sf_dir), feeds.products(spark, sf_dir))
    return rows.select(
        "raw_offset", "order_id", "product_id", "product_name", "category", "brand", "unit_cost",
        F.round("margin_amount", 2).alias("margin_amount"),
    )


def shuffled_enrich_margin(spark, sf_dir):
    """The same enrichment by shuffle, as with a dimension too large to broadcast."""
    rows = plans.order_rows(feeds.line_changes(spark, sf_dir))
    large = feeds.products(spark, sf_dir).hint("merge")
    joined = joins.enrich(rows, large, "product_id", plans.DIM_COLS)
    return plans.margin_by_brand(joins.with_margin(joined))


def unmatched_dim_keys(spark, sf_dir):
    rows = plans.order_rows(feeds.line_changes(spark, sf_dir))
    return joins.unmatched_keys(rows, feeds.products(spark, sf_dir), "product_id")


def duplicate_dim_keys(spark, sf_dir):
    """Dimension check on the versioned table, where every key repeats."""
    return joins.duplicate_keys(feeds.product_versions(spark, sf_dir), "product_id")


def dimension_refresh(spark, sf_dir):
    """Dimension as of a load time."""
    dim = feeds.product_versions(spark, sf_dir).withColumnRenamed("_updated_at", "_loaded_at")
    cut = F.lit("1999-01-01 00:00:00").cast("timestamp")
    fresh = joins.refresh_dimension(dim, cut)
    return fresh.groupBy("category").agg(
        F.count(F.lit(1)).alias("versions"),
        F.sum(F.col("unit_cost").cast("decimal(18,2)")).cast("double").alias("cost"),
    )


def _versioned(spark, sf_dir, few_versions):
    rows = plans.versioned_orders(
        feeds.line_changes(spark, sf_dir), feeds.product_versions(spark, sf_dir),
        few_versions=few_versions,
    )
    return rows.select(
        "raw_offset", "order_id", "product_id", "product_name", "unit_cost",
        F.round("margin_amount", 2).alias("margin_amount"), "event_date",
    )


def asof_enrich_margin(spark, sf_dir):
    return _versioned(spark, sf_dir, few_versions=True)


def asof_enrich_chunked(spark, sf_dir):
    """The same as-of join by the route for large version tables."""
    return _versioned(spark, sf_dir, few_versions=False)


def _versioned_with_gaps(spark, sf_dir, few_versions):
    """Rows and versions with and without a key, with and without a time."""
    rows = plans.order_rows(feeds.line_changes(spark, sf_dir)).select(
        "raw_offset",
        F.when(F.col("raw_offset") % 41 != 0, F.col("product_id")).alias("product_id"),
        F.when(F.col("raw_offset") % 43 != 0, F.col("event_time")).alias("event_time"),
    )
    if not few_versions:  # read twice by the as-of join
        rows = written_once(rows, "rows-with-gaps")
    versions = feeds.product_versions(spark, sf_dir).select("product_id", "_updated_at", "unit_cost")
    keyless = versions.withColumn("product_id", F.lit(None).cast("string"))
    timeless = versions.withColumn("_updated_at", F.lit(None).cast("timestamp"))
    joined = joins.asof_join(
        rows, versions.union(keyless).union(timeless), "product_id", "event_time", "_updated_at",
        ["unit_cost"], few_versions,
    )
    return plain_times(joined)


def asof_gaps_intervals(spark, sf_dir):
    return _versioned_with_gaps(spark, sf_dir, True)


def asof_gaps_chunked(spark, sf_dir):
    return _versioned_with_gaps(spark, sf_dir, False)


def changelog_rows(spark, sf_dir):
    """The change log as a table, by operation; a delete counts the row it removed."""
    rows = env.changelog(feeds.line_changes(spark, sf_dir), ORDER_SCHEMA)
    return plain_times(rows.groupBy("op", "currency").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("qty").alias("qty"),
        F.max("event_time").alias("last_time"),
    ))


def stream_events(spark, sf_dir):
    """Changes in the canonical event shape, with the lag between event and ingestion."""
    changes = env.decode_good(feeds.line_changes(spark, sf_dir), ORDER_SCHEMA)
    rows = env.as_stream_events(changes, F.col("kafka_ts"))
    return rows.groupBy("source_type", "source_topic", "partition", "cdc_op").agg(
        F.count_if(env.is_cdc(F.col("source_type"))).alias("cdc_rows"),
        F.sum(env.lag_ms(F.col("event_time"), F.col("ingestion_time"))).alias("lag_sum"),
        F.max("offset").alias("last_offset"), F.sum("cdc_after.qty").alias("qty"),
    )


def lake_copy_rows(spark, sf_dir):
    rows = plans.lake_copy(feeds.line_changes(spark, sf_dir), feeds.products(spark, sf_dir))
    return rows.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("orders"), F.count("source_lsn").alias("with_lsn"),
        F.sum(F.round("margin_amount", 2).cast("decimal(18,2)")).cast("double").alias("margin"),
    )


def dq_report(spark, sf_dir):
    rows = env.good_changes(env.decode_or_reject(feeds.line_changes(spark, sf_dir), ORDER_SCHEMA))
    return quality.report(rows, quality.ORDER_EXPECTATIONS)


def dq_silver(spark, sf_dir):
    return plain_times(plans.silver(plans.bronze(feeds.line_changes(spark, sf_dir))))


def medallion_gold(spark, sf_dir):
    first = plans.bronze(feeds.line_changes(spark, sf_dir))
    last = plans.gold(plans.silver(first), feeds.products(spark, sf_dir))
    return last.groupBy("event_date", "category").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("qty").alias("qty"),
        F.sum(F.round("margin_amount", 2).cast("decimal(18,2)")).cast("double").alias("margin"),
    )


def idempotency_tokens(spark, sf_dir):
    """Tokens by log position, by event id, and by topic position; zero falls through."""
    rows = env.good_changes(env.decode_or_reject(feeds.line_changes(spark, sf_dir), ORDER_SCHEMA))
    shaped = rows.select(
        F.when(F.col("raw_offset") % 13 == 0, F.lit(0)).otherwise(F.col("source_lsn")).alias("lsn"),
        F.when(F.col("raw_offset") % 17 == 0, F.lit("")).otherwise(F.col("event_id")).alias("event_id"),
        "raw_topic", "raw_partition", "raw_offset",
    )
    return shaped.select("raw_offset", idempotency_token(shaped).alias("token"))


QUERIES = {
    f.__name__: f for f in (
        cdc_decode, cdc_event_id, cdc_quarantine, dead_letter_rows, order_rows, cdc_lag,
        topic_routing, start_offsets, start_timestamp, topic_positions, broadcast_enrich_margin,
        enriched_order_rows, shuffled_enrich_margin, unmatched_dim_keys, duplicate_dim_keys,
        dimension_refresh, asof_enrich_margin, asof_enrich_chunked, asof_gaps_intervals,
        asof_gaps_chunked, changelog_rows,
        stream_events, lake_copy_rows, dq_report,
        dq_silver, medallion_gold, idempotency_tokens,
    )
}

_MARGIN = "round(total_amount - qty * unit_cost, 2)"
_ID = "coalesce(CAST(lsn AS VARCHAR), topic || ':' || part || ':' || pos)"
_BY_BRAND = f"""WITH {LINES}, {PRODUCTS}
SELECT brand, count(*) AS orders, CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
  CAST(sum(CAST({_MARGIN} AS DECIMAL(18,2))) AS DOUBLE) AS margin
FROM flat LEFT JOIN products USING (product_id) GROUP BY brand"""
_ASOF = f"""WITH {LINES}, {VERSIONS}
SELECT f.pos AS raw_offset, order_id, f.product_id, v.product_name, v.unit_cost,
  {_MARGIN} AS margin_amount, CAST(order_ts AS DATE) AS event_date
FROM flat f ASOF LEFT JOIN versions v ON f.product_id = v.product_id AND f.event_time >= v.updated_at"""

_ASOF_GAPS = f"""WITH {LINES}, {VERSIONS}, f AS (
  SELECT pos AS raw_offset, CASE WHEN pos % 41 <> 0 THEN product_id END AS product_id,
    CASE WHEN pos % 43 <> 0 THEN event_time END AS event_time FROM flat)
SELECT f.*, v.unit_cost FROM f ASOF LEFT JOIN versions v
  ON f.product_id = v.product_id AND f.event_time >= v.updated_at"""

SQL = {
    "cdc_decode": f"""WITH {LINES}
SELECT CASE WHEN defect = 1 THEN topic || ':' || part || ':' || pos ELSE {_ID} END AS event_id,
  CASE WHEN defect NOT IN (1, 3) THEN make_timestamp(ts_ms * 1000) END AS event_time,
  CASE WHEN defect <> 1 THEN CASE defect WHEN 2 THEN 'x' ELSE op END END AS cdc_op,
  CASE WHEN defect <> 1 THEN 'analytics' END AS source_db,
  CASE WHEN defect <> 1 THEN 'public' END AS source_schema,
  CASE WHEN defect <> 1 THEN 'orders' END AS source_table,
  topic AS raw_topic, part AS raw_partition, pos AS raw_offset,
  make_timestamp((ts_ms + 250) * 1000) AS kafka_ts,
  CASE WHEN defect <> 1 THEN CASE op WHEN 'd' THEN qty WHEN 'u' THEN qty - 1 END END AS before_qty,
  CASE WHEN defect <> 1 AND op <> 'd' THEN order_id END AS after_order_id,
  CASE WHEN defect <> 1 AND op <> 'd' THEN total_amount END AS after_total_amount,
  CASE WHEN defect <> 1 AND op <> 'd' THEN order_ts END AS after_order_ts
FROM lines WHERE defect <> 0""",
    "cdc_event_id": f"""WITH {LINES}, ids AS (
  SELECT lsn IS NULL OR defect = 1 AS from_offset,
    CASE WHEN defect = 1 THEN topic || ':' || part || ':' || pos ELSE {_ID} END AS event_id
  FROM lines WHERE defect <> 0)
SELECT from_offset, count(*) AS rows, min(event_id) AS first_id, max(event_id) AS last_id
FROM ids GROUP BY from_offset""",
    "cdc_quarantine": f"""WITH {LINES}
SELECT part AS raw_partition, pos AS raw_offset, CASE defect WHEN 0 THEN 'tombstone'
  WHEN 1 THEN 'malformed' WHEN 2 THEN 'unknown_op' WHEN 3 THEN 'malformed' ELSE 'good' END AS verdict
FROM lines""",
    "dead_letter_rows": f"""WITH {LINES}
SELECT topic AS raw_topic, part AS raw_partition, pos AS raw_offset,
  make_timestamp((ts_ms + 250) * 1000) AS kafka_ts,
  CASE defect WHEN 2 THEN 'unknown_op' ELSE 'malformed' END AS reject_reason
FROM lines WHERE defect IN (1, 2, 3)""",
    "order_rows": f"""WITH {LINES}
SELECT {_ID} AS event_id, event_time, op AS cdc_op, lsn AS source_lsn, part AS raw_partition, pos AS raw_offset,
  order_id, customer_id, product_id, qty, total_amount, currency, order_ts FROM flat""",
    "cdc_lag": f"""WITH {LINES}
SELECT part AS raw_partition, CAST(250 AS BIGINT) AS max_lag_ms,
  CAST(sum(((ts_ms + 250) // 1000 - ts_ms // 1000) * 1000) AS BIGINT) AS sum_whole_lag_ms,
  count(*) AS rows
FROM good GROUP BY part""",
    "topic_routing": f"""WITH {LINES}
SELECT 'cdc' AS prefix, 'public' AS source_schema, 'orders' AS source_table,
  count(*) AS messages, count(*) FILTER (defect <> 0) AS with_value FROM lines""",
    "start_offsets": f"""WITH {LINES}
SELECT part AS partition, count(*) AS messages, min(pos) AS first_offset FROM lines
WHERE part = 1 OR (part = 0 AND pos >= 4000) GROUP BY part""",
    "start_timestamp": f"""WITH {LINES}
SELECT part AS partition, count(*) AS messages, min(make_timestamp((ts_ms + 250) * 1000)) AS first_time
FROM lines WHERE make_timestamp((ts_ms + 250) * 1000) >= TIMESTAMP '1999-06-01' GROUP BY part""",
    "topic_positions": f"""WITH {LINES}
SELECT topic, part AS partition, min(pos) AS first_offset, max(pos) + 1 AS end_offset
FROM lines GROUP BY topic, part""",
    "broadcast_enrich_margin": _BY_BRAND,
    "shuffled_enrich_margin": _BY_BRAND,
    "enriched_order_rows": f"""WITH {LINES}, {PRODUCTS}
SELECT pos AS raw_offset, order_id, product_id, product_name, category, brand, unit_cost,
  {_MARGIN} AS margin_amount
FROM flat LEFT JOIN products USING (product_id)""",
    "unmatched_dim_keys": f"""WITH {LINES}, {PRODUCTS}
SELECT product_id, count(*) AS row_count FROM flat ANTI JOIN products USING (product_id)
GROUP BY product_id""",
    "duplicate_dim_keys": f"""WITH {VERSIONS}
SELECT product_id, count(*) AS row_count FROM versions GROUP BY product_id HAVING count(*) > 1""",
    "dimension_refresh": f"""WITH {VERSIONS}
SELECT category, count(*) AS versions,
  CAST(sum(CAST(unit_cost AS DECIMAL(18,2))) AS DOUBLE) AS cost
FROM versions WHERE updated_at <= TIMESTAMP '1999-01-01' GROUP BY category""",
    "asof_enrich_margin": _ASOF,
    "asof_enrich_chunked": _ASOF,
    "asof_gaps_intervals": _ASOF_GAPS,
    "asof_gaps_chunked": _ASOF_GAPS,
    "changelog_rows": f"""WITH {LINES}
SELECT op, currency, count(*) AS rows, CAST(sum(qty) AS BIGINT) AS qty,
  max(make_timestamp(ts_ms * 1000)) AS last_time
FROM good GROUP BY ALL""",
    "stream_events": f"""WITH {LINES}
SELECT 'cdc_debezium' AS source_type, topic AS source_topic, part AS partition,
  op AS cdc_op, count(*) AS cdc_rows,
  CAST(count(*) * 250 AS BIGINT) AS lag_sum, max(pos) AS last_offset,
  CAST(sum(CASE WHEN op <> 'd' THEN qty END) AS BIGINT) AS qty
FROM good GROUP BY ALL""",
    "lake_copy_rows": f"""WITH {LINES}, {PRODUCTS}
SELECT CAST(order_ts AS DATE) AS event_date, count(*) AS orders, count(lsn) AS with_lsn,
  CAST(sum(CAST({_MARGIN} AS DECIMAL(18,2))) AS DOUBLE) AS margin
FROM flat LEFT JOIN products USING (product_id) GROUP BY ALL""",
    "dq_report": f"""WITH {LINES}, judged AS (
  SELECT op IN ('c', 'u', 'r') AS a, op <> 'd' AND order_id IS NOT NULL AS b,
    op <> 'd' AND total_amount > 0 AS c, op <> 'd' AND currency <> 'XXX' AS d FROM good)
SELECT 'valid_op' AS rule, 'drop' AS action, count(*) FILTER (a) AS passed,
  count(*) FILTER (NOT a) AS failed FROM judged
UNION ALL SELECT 'order_id_not_null', 'drop', count(*) FILTER (b), count(*) FILTER (NOT b) FROM judged
UNION ALL SELECT 'amount_positive', 'warn', count(*) FILTER (c), count(*) FILTER (NOT c) FROM judged
UNION ALL SELECT 'currency_valid', 'warn', count(*) FILTER (d), count(*) FILTER (NOT d) FROM judged""",
    "dq_silver": f"""WITH {LINES}
SELECT event_time, order_id, customer_id, product_id, qty, total_amount, currency, order_ts
FROM flat WHERE order_id IS NOT NULL""",
    "medallion_gold": f"""WITH {LINES}, {PRODUCTS}
SELECT CAST(order_ts AS DATE) AS event_date, category, count(*) AS orders,
  CAST(sum(qty) AS BIGINT) AS qty,
  CAST(sum(CAST({_MARGIN} AS DECIMAL(18,2))) AS DOUBLE) AS margin
FROM flat LEFT JOIN products USING (product_id) WHERE order_id IS NOT NULL GROUP BY ALL""",
    "idempotency_tokens": f"""WITH {LINES}
SELECT pos AS raw_offset, CASE
    WHEN pos % 13 <> 0 AND lsn <> 0 THEN 'lsn:' || lsn
    WHEN pos % 17 <> 0 THEN 'eid:' || {_ID}
    ELSE 'koffset:' || topic || ':' || part || ':' || pos END AS token
FROM good""",
}
