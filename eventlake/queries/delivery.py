"""Rows as the destinations take them, and recipients of broadcasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlake.functions import envelope as env
from eventlake.functions.tokens import index_name
from eventlake.operators import metrics
from eventlake.plans import orders as plans
from eventlake.plans.activity import clicks, page_views, transactions
from eventlake.queries import feeds
from eventlake.queries.feeds import HISTORY, LINES, TXNS, plain_times
from eventlake.schemas import ORDER_SCHEMA
from eventlake.sinks import broadcast, columnar, document, keyed, lake


def _orders(spark, sf_dir):
    return plans.order_rows(feeds.order_changes(spark, sf_dir))


def keyed_hash_rows(spark, sf_dir):
    """Hot-store hashes, newest change per order."""
    rows = keyed.hash_rows(
        _orders(spark, sf_dir), "order:", "order_id", 3600, F.col("event_time"), plans.POSITION,
    )
    names = ("order_id", "qty", "total_amount", "currency", "order_ts", "cdc_op")
    return plain_times(rows.select(
        "key", "expires_at", F.size("fields").cast("long").alias("field_count"),
        *[F.col("fields")[n].alias(n) for n in names],
    ))


def keyed_merge_rows(spark, sf_dir):
    """Field-wise merge of line changes; lines without an order id fall back to a token."""
    rows = plans.order_rows(feeds.line_changes(spark, sf_dir))
    rows = rows.select(
        "event_id", "order_id", "currency", "raw_topic", "raw_partition", "raw_offset"
    )
    merged = keyed.merged_hash_rows(rows, "order:", "order_id", ["raw_offset", "event_id"])
    return merged.select("key", F.explode("fields").alias("field", "value"))


def live_hash_rows(spark, sf_dir):
    """Hashes that have not expired at a point in time, per currency."""
    rows = keyed.hash_rows(
        _orders(spark, sf_dir), "order:", "order_id", 86_400 * 365, F.col("event_time"),
        plans.POSITION,
    )
    now = F.lit("1999-07-01 00:00:00").cast("timestamp")
    live = keyed.live_rows(rows, now)
    return live.groupBy(F.col("fields")["currency"].alias("currency")).agg(
        F.count(F.lit(1)).alias("keys")
    )


def search_documents(spark, sf_dir):
    """Search documents with rotating index and token id; the newest copy stays."""
    rows = _orders(spark, sf_dir).drop("cdc_op")
    # Two deliveries of every change: the second must not add a document.
    twice = rows.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("__delivery")).drop("__delivery")
    docs = document.documents(twice, "orders-{yyyy_mm_dd}", "order_ts", list(plans.POSITION))
    source = F.from_json("_source", "order_id string, qty long, total_amount double")
    return docs.select(
        "_index", "_id", *[source[n].alias(n) for n in ("order_id", "qty", "total_amount")]
    )


def index_names(spark, sf_dir):
    """Monthly and yearly indexes; orders without a time go to 1970."""
    rows = _orders(spark, sf_dir)
    ts = F.when(F.col("raw_offset") % 5 != 0, F.col("order_ts"))
    return rows.groupBy(
        index_name("o-{yyyy_mm}", ts).alias("monthly"), index_name("o-{yyyy}-all", ts).alias("yearly")
    ).agg(F.count(F.lit(1)).alias("documents"))


def columnar_newest(spark, sf_dir):
    """Window rows written twice in update mode: readers see the newest version per key."""
    views = page_views(clicks(feeds.click_messages(spark, sf_dir)), "6 hours", "6 hours")
    first = views.withColumn("page_view_count", (F.col("page_view_count") / 2).cast("long"))
    appended = first.withColumn("batch_id", F.lit(0)).unionByName(
        views.withColumn("batch_id", F.lit(1))
    )
    newest = columnar.newest_version(appended, ["window_start", "country", "device_type"])
    return plain_times(newest.select(
        "window_start", "country", "device_type", "page_view_count", "batch_id"
    ))


def lake_partitions(spark, sf_dir):
    """Rows per partition date of the cold table."""
    rows = lake.lake_rows(_orders(spark, sf_dir))
    return rows.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("order_id").alias("orders")
    )


def archive_partitions(spark, sf_dir):
    """Messages per hour folder of the raw archive."""
    raw = feeds.line_changes(spark, sf_dir)
    ts_ms = F.get_json_object(F.col("value").cast("string"), "$.ts_ms").try_cast("long")
    rows = lake.archive_rows(raw, ts_ms)
    return rows.groupBy("year", "month", "day", "hour").agg(F.count(F.lit(1)).alias("messages"))


def broadcast_messages(spark, sf_dir):
    """Broadcast topic messages of all transactions, read back from their JSON."""
    txns = transactions(feeds.txn_messages(spark, sf_dir))
    targets = F.when(F.col("merchant") != "error", F.array("user_id", F.lit("ops-team")))
    sent = broadcast.broadcast_messages(
        txns.withColumn("user_targets", targets), F.lit(7).cast("long")
    )
    everyone, users = broadcast.parse_targets(F.col("value"))
    payload = F.from_json(F.get_json_object("value", "$.payload"), "txn_id string, amount double")
    return sent.select(
        payload["txn_id"].alias("txn_id"), payload["amount"].alias("amount"),
        everyone.alias("everyone"), F.array_join(users, ",").alias("users"),
        F.get_json_object("value", "$.batch_id").cast("long").alias("batch_id"),
    )


def _connections(spark, sf_dir):
    """Signups connect, errors disconnect; a fifth of the users is anonymous."""
    base = feeds.events(spark, sf_dir).where(F.col("event_type").isin("signup", "error"))
    return base.select(
        F.concat(F.lit("conn-"), F.col("event_id") % 997).alias("connection_id"),
        F.when(F.col("event_type") == "signup", "connect").otherwise("disconnect").alias("event"),
        F.when(F.col("user_id") % 5 != 0, F.concat(F.lit("u"), "user_id")).alias("user_id"),
        F.when(F.col("event_id") % 3 != 0, F.concat(
            F.lit(" orders, t"), F.col("user_id"), F.lit(",, "))).alias("topics"),
        "ts",
    )


def _registry(spark, sf_dir):
    return broadcast.connection_registry(
        _connections(spark, sf_dir), F.lit("2024-01-30 00:00:00").cast("timestamp"),
        ttl_seconds=30 * 86_400,
    )


def connection_registry(spark, sf_dir):
    rows = _registry(spark, sf_dir)
    return plain_times(rows.withColumn("subscribed_topics", F.array_join("subscribed_topics", "|")))


def _deliveries(spark, sf_dir):
    talk = feeds.table(spark, sf_dir, "conversations")
    number = F.col("conv_id") + F.col("turn")
    user = F.concat(F.lit("u"), F.col("conv_id") % 150)
    targets = (
        F.when(F.col("role") == "system", F.lit('"*"'))
        .when(F.col("role") == "user", F.concat(F.lit('"'), user, F.lit('"')))
        .otherwise(F.concat(F.lit('["'), user, F.lit('","anonymous"]')))
    )
    value = F.concat(F.lit('{"user_targets":'), targets, F.lit(',"payload":{}}'))
    messages = talk.withColumn("value", value)
    everyone, users = broadcast.parse_targets(F.col("value"))
    messages = messages.select(
        "conv_id", "turn", number.alias("number"), everyone.alias("everyone"), users.alias("users")
    )
    return broadcast.resolve_recipients(messages, _registry(spark, sf_dir))


def broadcast_targets(spark, sf_dir):
    """Every delivery: a message and a connection it goes to."""
    return _deliveries(spark, sf_dir).select("conv_id", "turn", "connection_id")


def delivery_outcomes(spark, sf_dir):
    delivered = F.pmod(F.col("number") + F.substring("connection_id", 6, 10).cast("long"), F.lit(7)) != 0
    return broadcast.delivery_outcomes(_deliveries(spark, sf_dir), delivered)


def _outcomes(spark, sf_dir):
    """Hourly sink outcomes: events of a type are one sink, values over 100 its failures."""
    hour = F.floor(F.unix_seconds("ts") / 3600)
    return feeds.events(spark, sf_dir).groupBy(
        F.col("event_type").alias("sink_name"), hour.alias("batch_id")
    ).agg(
        F.count_if(F.col("value") <= 100).alias("records_written"),
        F.count_if(F.col("value") > 100).alias("records_failed"),
        F.floor(F.max("value") * 10).alias("duration_ms"),
    )


def sink_totals(spark, sf_dir):
    rows = metrics.sink_totals(_outcomes(spark, sf_dir))
    return rows.withColumn("failure_rate", F.round("failure_rate", 9))


def breached_batches(spark, sf_dir):
    """Batches that would halt their stream at a tolerance of one half."""
    rows = metrics.breached_batches(_outcomes(spark, sf_dir), 0.5)
    return rows.select("sink_name", "batch_id", F.round("failure_rate", 9).alias("failure_rate"))


def sink_metrics(spark, sf_dir):
    return metrics.as_metrics(
        _outcomes(spark, sf_dir), metrics.SINK_METRICS, "SinkName", "sink_name", "batch_id"
    )


def distinct_completeness(spark, sf_dir):
    """Every change delivered twice, one destination keyed by token: nothing surplus."""
    rows = env.decode_changes(feeds.order_changes(spark, sf_dir), ORDER_SCHEMA, images=())
    twice = rows.select("event_id").unionAll(rows.select("event_id"))
    return metrics.completeness(twice, "event_id")


QUERIES = {
    f.__name__: f for f in (
        keyed_hash_rows, keyed_merge_rows, live_hash_rows, search_documents, index_names,
        columnar_newest, lake_partitions, archive_partitions, broadcast_messages,
        connection_registry, broadcast_targets, delivery_outcomes, sink_totals,
        breached_batches, sink_metrics, distinct_completeness,
    )
}

_NEWEST_ORDER = """newest AS (SELECT * FROM history WHERE op <> 'd'
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY lsn DESC) = 1)"""
_REGISTRY = """registry AS (
  SELECT 'conn-' || (event_id % 997) AS connection_id, event_type,
    CASE WHEN user_id % 5 <> 0 THEN 'u' || user_id ELSE 'anonymous' END AS user_id,
    CASE WHEN event_id % 3 <> 0 THEN 'orders|t' || user_id ELSE '*' END AS subscribed_topics,
    ts AS connected_at, CAST(floor(epoch(ts)) AS BIGINT) + 30 * 86400 AS ttl
  FROM events WHERE event_type IN ('signup', 'error')
  QUALIFY row_number() OVER (PARTITION BY event_id % 997
    ORDER BY ts DESC, event_type <> 'signup' DESC) = 1),
live AS (SELECT * EXCLUDE (event_type) FROM registry
  WHERE event_type = 'signup' AND ttl > epoch(TIMESTAMP '2024-01-30'))"""
_DELIVERIES = f"""{_REGISTRY}, wanted AS (
  SELECT conv_id, turn, role, unnest(CASE role WHEN 'system' THEN ['*']
    WHEN 'user' THEN ['u' || (conv_id % 150)]
    ELSE ['u' || (conv_id % 150), 'anonymous'] END) AS target FROM conversations),
deliveries AS (SELECT conv_id, turn, connection_id FROM wanted JOIN live
  ON role = 'system' OR target = user_id)"""
_OUTCOMES = """outcomes AS (
  SELECT event_type AS sink_name, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS batch_id,
    count(*) FILTER (value <= 100) AS written, count(*) FILTER (value > 100) AS failed,
    CAST(floor(max(value) * 10) AS BIGINT) AS duration_ms FROM events GROUP BY ALL)"""

SQL = {
    "keyed_hash_rows": f"""WITH {HISTORY}, {_NEWEST_ORDER}
SELECT 'order:' || order_id AS key, event_time + INTERVAL 3600 SECOND AS expires_at,
  CAST(14 AS BIGINT) AS field_count, order_id, CAST(qty AS VARCHAR) AS qty,
  CAST(total_amount AS VARCHAR) AS total_amount, currency,
  strftime(order_ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS order_ts, op AS cdc_op FROM newest""",
    "keyed_merge_rows": f"""WITH {LINES}, keyed AS (
  SELECT *, 'order:' || coalesce(order_id, 'eid:' || event_id) AS key FROM (
    SELECT *, coalesce(CAST(lsn AS VARCHAR), topic || ':' || part || ':' || pos) AS event_id FROM flat)),
newest AS (SELECT key, max(pos) AS raw_offset, arg_max(part, pos) AS raw_partition FROM keyed GROUP BY key)
SELECT key, 'currency' AS field, arg_max(currency, pos) AS value FROM keyed GROUP BY key
UNION ALL SELECT key, 'order_id', arg_max(order_id, pos) FROM keyed
  WHERE order_id IS NOT NULL GROUP BY key
UNION ALL SELECT key, 'event_id', arg_max(event_id, (pos, event_id)) FROM keyed GROUP BY key
UNION ALL SELECT key, 'raw_topic', 'cdc.public.orders' FROM newest
UNION ALL SELECT key, 'raw_partition', CAST(raw_partition AS VARCHAR) FROM newest
UNION ALL SELECT key, 'raw_offset', CAST(raw_offset AS VARCHAR) FROM newest""",
    "live_hash_rows": f"""WITH {HISTORY}, {_NEWEST_ORDER}
SELECT currency, count(*) AS keys FROM newest
WHERE event_time + INTERVAL 365 DAY > TIMESTAMP '1999-07-01' GROUP BY currency""",
    "search_documents": f"""WITH {HISTORY}
SELECT strftime(order_ts, 'orders-%Y.%m.%d') AS _index,
  CASE WHEN lsn = 0 THEN 'eid:0' ELSE 'lsn:' || lsn END AS _id, order_id, qty, total_amount
FROM history WHERE op <> 'd'""",
    "index_names": f"""WITH {HISTORY}, t AS (
  SELECT CASE WHEN lsn % 5 <> 0 THEN order_ts ELSE TIMESTAMP '1970-01-01' END AS ts
  FROM history WHERE op <> 'd')
SELECT strftime(ts, 'o-%Y.%m') AS monthly, strftime(ts, 'o-%Y-all') AS yearly,
  count(*) AS documents FROM t GROUP BY ALL""",
    "columnar_newest": f"""WITH {feeds.CLICKS}
SELECT time_bucket(INTERVAL 6 HOUR, event_time) AS window_start, country, device_type,
  count(*) AS page_view_count, 1 AS batch_id FROM clicks GROUP BY ALL""",
    "lake_partitions": f"""WITH {HISTORY}
SELECT CAST(order_ts AS DATE) AS event_date, count(*) AS rows, count(DISTINCT order_id) AS orders
FROM history WHERE op <> 'd' GROUP BY ALL""",
    "archive_partitions": f"""WITH {LINES}, t AS (
  SELECT CASE WHEN defect NOT IN (1, 3) THEN make_timestamp(ts_ms * 1000) END AS ts
  FROM lines WHERE defect <> 0)
SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
  strftime(ts, '%H') AS hour, count(*) AS messages FROM t GROUP BY ALL""",
    "broadcast_messages": f"""WITH {TXNS}
SELECT txn_id, amount, merchant = 'error' AS everyone,
  CASE WHEN merchant = 'error' THEN '' ELSE user_id || ',ops-team' END AS users,
  CAST(7 AS BIGINT) AS batch_id FROM txns""",
    "connection_registry": f"WITH {_REGISTRY} SELECT * FROM live",
    "broadcast_targets": f"WITH {_DELIVERIES} SELECT * FROM deliveries",
    "delivery_outcomes": f"""WITH {_DELIVERIES}, d AS (
  SELECT (conv_id + turn + CAST(substring(connection_id, 6) AS BIGINT)) % 7 <> 0 AS ok FROM deliveries)
SELECT count(*) FILTER (ok) AS pushed, count(*) FILTER (NOT ok) AS failed FROM d""",
    "sink_totals": f"""WITH {_OUTCOMES}
SELECT sink_name, CAST(sum(written) AS BIGINT) AS written, CAST(sum(failed) AS BIGINT) AS failed,
  max(duration_ms) AS max_duration_ms,
  round(sum(failed) / (sum(written) + sum(failed)), 9) AS failure_rate FROM outcomes GROUP BY sink_name""",
    "breached_batches": f"""WITH {_OUTCOMES}
SELECT sink_name, batch_id, round(failed / (written + failed), 9) AS failure_rate FROM outcomes
WHERE failed / (written + failed) > 0.5""",
    "sink_metrics": f"""WITH {_OUTCOMES}
SELECT 'SinkRecordsWritten' AS metric, CAST(written AS DOUBLE) AS value, 'Count' AS unit,
  'SinkName=' || sink_name AS dimension, batch_id FROM outcomes
UNION ALL SELECT 'SinkRecordsFailed', failed, 'Count', 'SinkName=' || sink_name, batch_id FROM outcomes
UNION ALL SELECT 'SinkWriteDurationMs', duration_ms, 'Milliseconds', 'SinkName=' || sink_name, batch_id
FROM outcomes""",
    "distinct_completeness": f"""WITH {HISTORY}
SELECT 2 * count(*) AS row_count, count(*) AS distinct_keys, count(*) AS repeated_keys,
  count(*) AS surplus_rows FROM history""",
}
