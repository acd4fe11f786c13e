"""What runs of streams leave on disk."""

from __future__ import annotations

import glob
import json
import time
from datetime import datetime, timedelta

import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from test_streams import messages, order_message

from eventlake.plans import orders
from eventlake.queries import feeds
from eventlake.session import STREAM_CONF, stream_settings
from eventlake.streaming import runs
from eventlake.streaming.waiting import pack, unpack

T0 = datetime(2026, 1, 1)


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(",")
    return {name for name in files.split(",") if "shuffle_" in name and name.endswith(".data")}


def micros(minutes):
    return int((T0 + timedelta(minutes=minutes) - datetime(1970, 1, 1)).total_seconds()) * 1_000_000


def settle(holds, seconds=20):
    due = time.monotonic() + seconds
    while not holds() and time.monotonic() < due:
        time.sleep(0.1)
    return holds()


def timed_rows(spark):
    return spark.createDataFrame([(i, T0 + timedelta(minutes=i)) for i in range(400)], "id long, ts timestamp")


def folders(spark, name):
    return set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/{name}-*"))


def test_a_sliced_table_is_held_once(spark):
    """The rows cut by slice stayed beside the files of the stream before."""
    before = folders(spark, "slices-cut")
    files = shuffle_files(spark)
    stream = feeds.sliced_stream(timed_rows(spark), F.col("ts"), span=(micros(0), micros(400)))
    assert stream.isStreaming and folders(spark, "slices-cut") == before
    assert settle(lambda: not shuffle_files(spark) - files)


def test_consumed_slices_go_and_rows_stay(spark, shared):
    known = folders(spark, "slices")
    stream = feeds.sliced_stream(timed_rows(spark), F.col("ts"), consume=True)
    (path,) = {p for p in folders(spark, "slices") - known if not p.split("/")[-1].startswith("slices-cut")}
    files = len(glob.glob(f"{path}/*.parquet"))
    got = runs.drain(stream, f"{shared}/out", f"{shared}/cp")
    assert files == 4 and len(glob.glob(f"{path}/*.parquet")) < files
    assert sorted(r.id for r in got.collect()) == list(range(400))
    assert got.select("batch_id").distinct().count() == 4


def test_rows_older_than_the_shared_clock_come_first(spark, shared):
    """They lay in a slice of number -1, which nobody read."""
    stream = feeds.sliced_stream(timed_rows(spark), F.col("ts"), span=(micros(100), micros(400)))
    got = runs.drain(stream, f"{shared}/out", f"{shared}/cp")
    first = {r.id for r in got.where("batch_id = 0").select("id").collect()}
    assert got.count() == 400 and set(range(100)) <= first


def test_shuffle_files_of_a_micro_batch_go_with_it(spark, shared):
    stream = feeds.sliced_stream(timed_rows(spark), F.col("ts"))
    files = shuffle_files(spark)
    grouped = stream.withWatermark("ts", "1 minute").groupBy(F.window("ts", "5 minutes")).count()
    got = runs.drain(grouped, f"{shared}/out", f"{shared}/cp")
    assert settle(lambda: not shuffle_files(spark) - files)
    assert got.count() > 0


def test_stages_are_packed_and_gold_takes_bounded_batches(spark, shared):
    products = spark.createDataFrame([("p1", "n", "c", "b", 3.0)],
                                     "product_id string, product_name string, category string, brand string, unit_cost double")
    raw = messages(spark, f"{shared}/in", [order_message(i) for i in range(8)] + [order_message(8, "d")], batches=2)
    orders.run_stages(spark, raw, products, f"{shared}/base", gold_bytes=1)
    for stage in ("bronze", "silver"):
        for file in glob.glob(f"{shared}/base/{stage}/*.parquet"):
            columns = pq.ParquetFile(file).metadata.row_group(0)
            kinds = {columns.column(i).path_in_schema: columns.column(i) for i in range(columns.num_columns)}
            assert kinds["event_time"].physical_type == "INT64" and {c.compression for c in kinds.values()} == {"ZSTD"}
    gold = spark.read.parquet(f"{shared}/base/gold")
    assert gold.count() == 8
    assert gold.select("batch_id").distinct().count() == len(glob.glob(f"{shared}/base/silver/*.parquet")) > 1  # one batch before


def test_state_is_packed_tightly():
    rows = pd.DataFrame([(f"p{i * 7919 % 20000}", micros(i), json.dumps(
        {"order_id": f"O-{i * 104729 % 150000}-{i % 7}", "product_id": f"p{i * 7919 % 20000}", "qty": i * 31 % 50,
         "total_amount": i * 7907 % 99991 / 100, "event_time": (T0 + timedelta(seconds=i * 61)).isoformat(), "raw_topic": "cdc.public.orders"}))
        for i in range(1000)], columns=["key_", "us", "payload"])
    held = pack(rows)
    assert unpack(held).equals(rows) and len(held) < 45 * len(rows)


def test_stream_settings_end_with_the_block(spark):
    before = {name: spark.conf.get(name, None) for name in STREAM_CONF}
    with stream_settings(spark):
        assert {name: spark.conf.get(name) for name in STREAM_CONF} == STREAM_CONF
    assert {name: spark.conf.get(name, None) for name in STREAM_CONF} == before
