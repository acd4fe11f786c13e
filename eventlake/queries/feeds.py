"""Broker feeds and dimensions derived from the driver tables, in Spark and in SQL.

Lines become order changes with every kind of bad message; orders become full
change histories; events become clicks, transactions and metric points. The SQL
texts derive the same flat rows without any message in between.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.functions.envelope import decode_changes
from eventlake.schemas import ORDER_SCHEMA
from eventlake.session import discard, prepare, shared_dir, stream_settings
from eventlake.sources.broker import file_stream
from eventlake.sources.envelopes import broker_rows, envelope
from eventlake.sources.tables import written_once

MICRO_FORMAT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


SLICES = 4
MOST_FILES = 64  # of one slice of a stream


def arrival_slice(arrival: Column, lowest: int, highest: int, slices: int = SLICES) -> Column:
    """Number of the slice of the time line [lowest, highest] (microseconds) a row arrives in; the first one takes what is older."""
    number = F.floor((F.unix_micros(arrival) - lowest) * slices / F.lit(highest - lowest + 1))
    return F.greatest(F.least(number, F.lit(slices - 1)), F.lit(0))


def sliced_stream(
    df: DataFrame, arrival: Column, slices: int = SLICES, slices_per_trigger: int = 1,
    span: tuple[int, int] | None = None, consume: bool = False,
) -> DataFrame:
    """A table as a stream that brings it in equal slices of the arrival time, one after the other.

    The table is read once and written by slice, into a folder that is removed
    in the end. Then each slice goes to the folder of the stream in turn, as a file source reads files by their age, and
    always as the same number of files: one for every 1,000 rows of the smallest
    slice, ``MOST_FILES`` at most. How the table is cut into files plays no part. ``span`` gives the
    time line (microseconds) where several streams share a clock. ``consume`` is for a stream with a single
    reader: a slice is removed when it has been read.
    """
    spark = df.sparkSession
    cut, path = shared_dir(spark, "slices-cut"), shared_dir(spark, "slices")
    if span is None:
        us = F.unix_micros(arrival)
        ends = df.agg(F.min(us).alias("low"), F.max(us).alias("high")).first()
        span = ends["low"] or 0, ends["high"] or 0
    with stream_settings(spark):
        df.withColumn("__slice", arrival_slice(arrival, *span, slices)).write.partitionBy("__slice").parquet(cut)
        parts = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("__slice", T.LongType())])).parquet(cut)
        sizes = {r["__slice"]: r["count"] for r in parts.groupBy("__slice").count().collect()}
        files = max(1, min(MOST_FILES, min(sizes.get(k, 0) for k in range(slices)) // 1000))
        for number in range(slices):
            part = parts.where(F.col("__slice") == number).drop("__slice")
            part.repartition(files, F.xxhash64(*df.columns)).write.mode("append").parquet(path)
    discard(spark, cut)
    return file_stream(spark, path, files * slices_per_trigger, df.schema, consume)


def topic_table(
    spark: SparkSession, sf_dir: str, name: str, stream: bool = False, slices_per_trigger: int = 1,
    span: tuple[int, int] | None = None, consume: bool = False,
) -> DataFrame:
    """A table whose rows become the messages of a topic; as a stream it comes in time slices of several micro-batches.

    The topic partition of a message is an expression on its key, so no exchange deals the rows out.
    """
    df = table(spark, sf_dir, name)
    if stream:
        arrival = utc({"lineitem": "l_shipdate", "events": "ts"}[name])
        df = sliced_stream(df, arrival, slices_per_trigger=slices_per_trigger, span=span, consume=consume)
    return df


def utc(name: str) -> Column:
    """Zone-free table times as instants; watermarks accept only those."""
    return F.col(name).cast("timestamp")


def plain_times(df: DataFrame) -> DataFrame:
    """Instants back to zone-free times, as the tables and the SQL side have them."""
    return df.select([
        F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if f.dataType.typeName() == "timestamp" else F.col(f.name)
        for f in df.schema.fields
    ])


def _currency(key: Column) -> Column:
    codes = F.array(*[F.lit(c) for c in ("USD", "EUR", "GBP", "JPY", "XXX")])
    return F.get(codes, (key % 5).cast("int"))


_CURRENCY_SQL = "CASE {0} % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' " \
    "WHEN 3 THEN 'JPY' ELSE 'XXX' END"


def line_changes(
    spark: SparkSession, sf_dir: str, stream: bool = False, span: tuple[int, int] | None = None, consume: bool = False,
) -> DataFrame:
    """One change per line item. Some messages are empty, broken, or carry an unknown op."""
    lines = topic_table(spark, sf_dir, "lineitem", stream, span=span, consume=consume)
    key, number = F.col("l_orderkey"), F.col("l_linenumber")
    pos = key * 8 + number
    turn = (key + number) % 10
    defect = (key * 7 + number) % 50
    op = (
        F.when(defect == 2, "x").when(turn == 0, "d").when(turn == 1, "r")
        .when(turn.isin(2, 3), "u").otherwise("c")
    )
    at = utc("l_shipdate")
    ts_ms = F.unix_millis(at) + pos % 86_400_000
    unlisted = (F.col("l_returnflag") == "N") & (number == 7)
    nameless = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F") & (number == 7)
    unpaid = (F.col("l_tax") == 0.08) & (number == 1)

    def row(qty: Column) -> Column:
        return F.struct(
            F.when(~nameless, F.concat_ws("-", F.lit("O"), key, number)).alias("order_id"),
            F.concat(F.lit("C-"), F.col("l_suppkey")).alias("customer_id"),
            F.concat(F.when(unlisted, "X-").otherwise("P-"), F.col("l_partkey")).alias("product_id"),
            qty.alias("qty"),
            F.when(unpaid, 0.0).otherwise(F.col("l_extendedprice")).alias("total_amount"),
            _currency(key).alias("currency"), at.alias("order_ts"),
        )

    qty = F.col("l_quantity").cast("long")
    before = F.when(turn == 0, row(qty)).when(turn.isin(2, 3), row(qty - 1))
    after = F.when(turn != 0, row(qty))
    lsn = F.when(F.col("l_suppkey") % 11 != 0, pos)
    text = envelope(op, ts_ms, lsn, before, after)
    value = (
        F.when(defect == 0, F.lit(None))
        .when(defect == 1, F.lit("not json"))
        .when(defect == 3, F.regexp_replace(text, '"ts_ms":[0-9]+', '"ts_ms":"soon"'))
        .otherwise(text)
    )
    return broker_rows(
        lines, key, value, F.lit("cdc.public.orders"), key % 3, pos,
        F.timestamp_millis(ts_ms + 250),
    )


LINES = f"""lines AS (
  SELECT l_orderkey * 8 + l_linenumber AS pos,
    CASE WHEN l_suppkey % 11 <> 0 THEN l_orderkey * 8 + l_linenumber END AS lsn,
    (l_orderkey * 7 + l_linenumber) % 50 AS defect,
    CASE (l_orderkey + l_linenumber) % 10
      WHEN 0 THEN 'd' WHEN 1 THEN 'r' WHEN 2 THEN 'u' WHEN 3 THEN 'u' ELSE 'c' END AS op,
    CAST(l_orderkey % 3 AS INTEGER) AS part, 'cdc.public.orders' AS topic,
    epoch_ms(l_shipdate) + (l_orderkey * 8 + l_linenumber) % 86400000 AS ts_ms,
    CASE WHEN NOT (l_returnflag = 'R' AND l_linestatus = 'F' AND l_linenumber = 7)
      THEN 'O-' || l_orderkey || '-' || l_linenumber END AS order_id,
    'C-' || l_suppkey AS customer_id,
    CASE WHEN l_returnflag = 'N' AND l_linenumber = 7 THEN 'X-' ELSE 'P-' END || l_partkey
      AS product_id,
    CAST(l_quantity AS BIGINT) AS qty,
    CASE WHEN l_tax = 0.08 AND l_linenumber = 1 THEN 0.0 ELSE l_extendedprice END AS total_amount,
    {_CURRENCY_SQL.format('l_orderkey')} AS currency, l_shipdate AS order_ts
  FROM lineitem),
good AS (SELECT *, make_timestamp(ts_ms * 1000) AS event_time FROM lines WHERE defect > 3),
flat AS (SELECT * FROM good WHERE op IN ('c', 'u', 'r'))"""


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("P-"), F.col("p_partkey")).alias("product_id"),
        F.col("p_name").alias("product_name"), F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"), F.col("p_retailprice").alias("unit_cost"),
    )


PRODUCTS = """products AS (
  SELECT 'P-' || p_partkey AS product_id, p_name AS product_name, p_type AS category,
    p_brand AS brand, p_retailprice AS unit_cost FROM part)"""


def product_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four versions per product, two years apart, each ten more expensive."""
    number = F.explode(F.array(*[F.lit(v) for v in range(4)]))
    base = products(spark, sf_dir).withColumn("v", number)
    return base.select(
        "product_id", "product_name", "category", "brand",
        (F.col("unit_cost") + F.col("v") * 10).alias("unit_cost"),
        F.make_timestamp(1996 + F.col("v") * 2, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
        .alias("_updated_at"),
    )


VERSIONS = """versions AS (
  SELECT 'P-' || p_partkey AS product_id, p_name AS product_name, p_type AS category,
    p_retailprice + v * 10 AS unit_cost, make_timestamp(1996 + v * 2, 1, 1, 0, 0, 0) AS updated_at
  FROM part, range(4) AS r(v))"""


LATE_DAYS = 500  # a version reaches its stream so long after it took effect


def lines_and_late_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Order changes, and a stream of product versions that trails them, on one clock.

    Every product changes every two years from 1992 on, on a day of its own.
    """
    ends = table(spark, sf_dir, "lineitem").agg(F.min("l_shipdate").alias("low"), F.max("l_shipdate").alias("high")).select(
        F.unix_micros(utc("low")).alias("low"), F.unix_micros(utc("high")).alias("high")).first()
    span = ends["low"] or 0, (ends["high"] or 0) + LATE_DAYS * 86_400_000_000
    day = F.pmod(F.regexp_extract("product_id", "[0-9]+", 0).cast("long"), F.lit(300)).cast("int")
    versions = product_versions(spark, sf_dir).withColumn(
        "_updated_at", F.col("_updated_at") + F.make_interval(years=F.lit(-4), days=day))
    arrival = F.col("_updated_at") + F.make_interval(days=F.lit(LATE_DAYS))
    changes = line_changes(spark, sf_dir, stream=True, span=span, consume=True)
    return changes, sliced_stream(versions, arrival, span=span, consume=True)


LATE_VERSIONS = """versions AS (
  SELECT 'P-' || p_partkey AS product_id, p_name AS product_name, p_type AS category, p_retailprice + v * 10 AS unit_cost,
    make_timestamp(1992 + v * 2, 1, 1, 0, 0, 0) + to_days(CAST(p_partkey % 300 AS INTEGER)) AS updated_at
  FROM part, range(4) AS r(v))"""


def order_changes(spark: SparkSession, sf_dir: str, table_col: Column | None = None) -> DataFrame:
    """Change histories of orders: created or snapshot, updated, deleted, created again."""
    orders = topic_table(spark, sf_dir, "orders")
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    gone = (F.col("o_orderpriority") == "5-LOW") & (status == "F")
    back = gone & (F.col("o_custkey") % 2 == 0)

    def row(extra: float) -> Column:
        return F.struct(
            F.concat(F.lit("O-"), key).alias("order_id"),
            F.concat(F.lit("C-"), F.col("o_custkey")).alias("customer_id"),
            F.concat(F.lit("P-"), key % 200).alias("product_id"),
            (F.col("o_custkey") % 5 + 1).alias("qty"),
            (F.col("o_totalprice") + extra).alias("total_amount"),
            _currency(key).alias("currency"), utc("o_orderdate").alias("order_ts"),
        )

    nothing = F.lit(None)
    steps = (
        (0, F.when(status == "P", "r").otherwise("c"), F.lit(True), nothing, row(0.0)),
        (1, F.lit("u"), status != "O", row(0.0), row(10.5)),
        (2, F.lit("d"), gone, row(10.5), nothing),
        (3, F.lit("c"), back, nothing, row(20.25)),
    )
    ts_ms = F.unix_millis(utc("o_orderdate")) + key % 1000
    source = F.lit("orders") if table_col is None else table_col
    seq = F.col("__seq")
    present = F.explode(F.array(*[F.when(there, F.lit(number)) for number, _, there, _, _ in steps]))
    rows = orders.select("*", present.alias("__seq")).where(seq.isNotNull())

    def of_step(part: int) -> Column:
        first, *others = [(seq == step[0], step[part]) for step in steps]
        return reduce(lambda made, other: made.when(*other), others, F.when(*first))

    value = envelope(of_step(1), ts_ms + seq * 60_000, key * 8 + seq, of_step(3), of_step(4), table=source)
    return broker_rows(
        rows, key, value, F.lit("cdc.public.orders"), key % 3,
        key * 8 + seq, F.timestamp_millis(ts_ms + seq * 60_000 + 250),
    )


def truncates(changes: DataFrame) -> DataFrame:
    """A truncate in the middle of the log of every table with an even number."""
    return (
        changes.where(F.substring("source_table", 1, 1).isin("2", "4")).groupBy("source_table")
        .agg(((F.max("source_lsn") / 16).cast("long") * 8 + 7).alias("source_lsn"), F.max("event_time").alias("event_time"))
        .withColumn("cdc_op", F.lit("t")).withColumn("raw_offset", F.col("source_lsn"))
    )


def decoded_once(changes: DataFrame, *columns: str) -> DataFrame:
    """Columns of decoded changes, written and read back, so that several readers don't build and parse the messages again."""
    return written_once(changes.select(*columns), "decoded")


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded order changes of several tables (one for each priority) with truncates in between."""
    changes = decode_changes(order_changes(spark, sf_dir, F.col("o_orderpriority")), ORDER_SCHEMA)
    changes = decoded_once(changes, "source_table", "source_lsn", "raw_offset", "event_time", "cdc_op", "before", "after")
    return changes.unionByName(truncates(changes), allowMissingColumns=True)


HISTORY = f"""history AS (
  SELECT o_orderkey * 8 + seq AS lsn, seq, o_orderpriority AS priority,
    CAST(o_orderkey % 3 AS INTEGER) AS part,
    CASE seq WHEN 0 THEN CASE o_orderstatus WHEN 'P' THEN 'r' ELSE 'c' END
      WHEN 1 THEN 'u' WHEN 2 THEN 'd' ELSE 'c' END AS op,
    epoch_ms(o_orderdate) + o_orderkey % 1000 + seq * 60000 AS ts_ms,
    make_timestamp((epoch_ms(o_orderdate) + o_orderkey % 1000 + seq * 60000) * 1000) AS event_time,
    'O-' || o_orderkey AS order_id, 'C-' || o_custkey AS customer_id,
    'P-' || (o_orderkey % 200) AS product_id, o_custkey % 5 + 1 AS qty,
    o_totalprice + CASE seq WHEN 0 THEN 0.0 WHEN 3 THEN 20.25 ELSE 10.5 END AS total_amount,
    {_CURRENCY_SQL.format('o_orderkey')} AS currency, o_orderdate AS order_ts
  FROM orders, range(4) AS r(seq)
  WHERE seq = 0 OR (seq = 1 AND o_orderstatus <> 'O')
    OR (seq >= 2 AND o_orderpriority = '5-LOW' AND o_orderstatus = 'F'
        AND (seq = 2 OR o_custkey % 2 = 0)))"""


def _user() -> Column:
    return F.concat(F.lit("u"), F.col("user_id"))


def click_messages(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """Clicks as JSON; errors have no page, and some messages no time."""
    events = topic_table(spark, sf_dir, "events", stream)
    countries = F.array(*[F.lit(c) for c in ("DE", "FR", "JP", "US")])
    click = F.struct(
        _user().alias("user_id"), F.concat(F.lit("s"), F.col("user_id")).alias("session_id"),
        F.when(F.col("event_type") != "error", F.concat(F.lit("/p/"), F.col("event_id") % 100))
        .alias("page_url"),
        F.lit(None).cast("string").alias("referrer"), F.col("event_type").alias("device_type"),
        F.get(countries, (F.col("user_id") % 4).cast("int")).alias("country"),
        F.when(F.col("event_id") % 97 != 0, utc("ts")).alias("event_time"),
        F.floor(F.col("value") * 10).cast("int").alias("page_load_ms"),
    )
    return broker_rows(
        events, F.col("user_id"), F.to_json(click, MICRO_FORMAT), F.lit("app.clickstream"),
        F.col("user_id") % 6, F.col("event_id"), utc("ts"),
    )


CLICKS = """clicks AS (
  SELECT 'u' || user_id AS user_id,
    CASE WHEN event_type <> 'error' THEN '/p/' || (event_id % 100) END AS page_url,
    event_type AS device_type,
    CASE user_id % 4 WHEN 0 THEN 'DE' WHEN 1 THEN 'FR' WHEN 2 THEN 'JP' ELSE 'US' END AS country,
    ts AS event_time, CAST(floor(value * 10) AS INTEGER) AS page_load_ms
  FROM events WHERE event_id % 97 <> 0)"""


def txn_messages(
    spark: SparkSession, sf_dir: str, stream: bool = False, slices_per_trigger: int = 1
) -> DataFrame:
    events = topic_table(spark, sf_dir, "events", stream, slices_per_trigger)
    txn = F.struct(
        F.col("event_id").cast("string").alias("txn_id"), _user().alias("user_id"),
        F.col("value").alias("amount"), F.col("event_type").alias("merchant"),
        utc("ts").alias("event_time"),
    )
    return broker_rows(
        events, F.col("event_id"), F.to_json(txn, MICRO_FORMAT), F.lit("app.transactions"),
        F.col("event_id") % 12, F.col("event_id"), utc("ts"),
    )


TXNS = """txns AS (
  SELECT CAST(event_id AS VARCHAR) AS txn_id, 'u' || user_id AS user_id, value AS amount,
    event_type AS merchant, ts AS event_time FROM events)"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", utc("ts"))


def tracks(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Three tracks of one workload; the commit time trails the event by ``value`` ms."""
    base = events(spark, sf_dir)
    names = {"emr_on_eks": ("click", "view"), "databricks": ("purchase", "error"),
             "flink": ("signup",)}
    out = {}
    for name, types in names.items():
        part = base.where(F.col("event_type").isin(*types)).select(
            "event_id", F.col("ts").alias("event_time"),
            F.timestamp_micros(
                F.unix_micros("ts") + F.floor(F.col("value") * 10).cast("long") * 1000
            ).alias("_commit_time"),
            *(["event_type"] if len(types) > 1 else []),
        )
        out[name] = part
    return out


RUNS = """runs AS (
  SELECT event_id, ts AS event_time,
    CASE WHEN event_type IN ('click', 'view') THEN 'emr_on_eks'
      WHEN event_type IN ('purchase', 'error') THEN 'databricks' ELSE 'flink' END AS runtime,
    CASE WHEN event_type <> 'signup' THEN event_type END AS event_type,
    CAST(floor(value * 10) AS BIGINT) AS latency
  FROM events)"""


def metric_points(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """Events as metric points: the type picks the metric, the user the dimension."""
    names = {"click": "UnderReplicatedPartitions", "view": "KafkaDataLogsDiskUsed",
             "purchase": "Errors", "signup": "downtime"}
    metric = F.lit("LagMs")
    for kind, name in names.items():
        metric = F.when(F.col("event_type") == kind, name).otherwise(metric)
    return topic_table(spark, sf_dir, "events", stream).withColumn("ts", utc("ts")).select(
        metric.alias("metric"), F.concat(F.lit("d"), F.col("user_id") % 5).alias("dimension"),
        "value", "ts",
    )


POINTS = """points AS (
  SELECT CASE event_type WHEN 'click' THEN 'UnderReplicatedPartitions'
      WHEN 'view' THEN 'KafkaDataLogsDiskUsed' WHEN 'purchase' THEN 'Errors'
      WHEN 'signup' THEN 'downtime' ELSE 'LagMs' END AS metric,
    'd' || (user_id % 5) AS dimension, value, ts FROM events)"""
