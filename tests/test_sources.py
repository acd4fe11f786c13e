from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventlake.session import build_session, shared_dir
from eventlake.sources import broker, tables

T0 = datetime(2026, 1, 1)


def topic(spark):
    rows = [("t", p, o, T0 + timedelta(minutes=o)) for p in (0, 1, 2) for o in range(10)]
    return spark.createDataFrame(rows, "topic string, partition int, offset long, timestamp timestamp")


def test_options():
    source = broker.BrokerSource(
        "b:9092", ("cdc.public.orders", "app.clickstream"),
        max_offsets_per_trigger=broker.ORDERS_PER_TRIGGER, consumer_group="g", fail_on_data_loss=False)
    got = source.options()
    assert got["subscribe"] == "cdc.public.orders,app.clickstream"
    assert got["maxOffsetsPerTrigger"] == "50000" and got["kafka.group.id"] == "g"
    assert got["failOnDataLoss"] == "false" and got["startingOffsets"] == "latest"
    assert got["kafka.security.protocol"] == "SASL_SSL"


def test_options_without_authentication():
    got = broker.BrokerSource("b", topic_pattern=r"^cdc\..*", iam=False,
                              starting_offsets={"t": {"0": 5}}, starting_timestamp_ms=7).options()
    assert got["subscribePattern"] == r"^cdc\..*" and "subscribe" not in got
    assert got["startingOffsets"] == '{"t": {"0": 5}}' and got["startingTimestamp"] == "7"
    assert not any("sasl" in k for k in got)
    for bad in ({}, {"topics": ("a",), "topic_pattern": "b"}):
        with pytest.raises(ValueError):
            broker.BrokerSource("b", **bad).options()


def test_start_positions(spark):
    df = topic(spark)
    assert broker.from_position(df, "TRIM_HORIZON").count() == 30
    assert broker.from_position(df, "LATEST").count() == 0
    at = broker.from_position(df, "AT_TIMESTAMP", timestamp=F.lit(T0 + timedelta(minutes=7)))
    assert at.count() == 9
    with pytest.raises(ValueError, match="AT_TIMESTAMP"):
        broker.from_position(df, "AT_TIMESTAMP")
    with pytest.raises(ValueError):
        broker.from_position(df, "somewhere")
    some = broker.from_position(df, offsets={"t": {0: 8, 1: -1}})
    assert sorted((r.partition, r["count"]) for r in some.groupBy("partition").count().collect()) == [
        (0, 2), (2, 10)]


def test_matching_topics_and_positions(spark):
    df = spark.createDataFrame([("cdc.public.orders", 0, 5), ("app.clicks", 0, 1), ("cdcx", 0, 1)],
                               "topic string, partition int, offset long")
    assert [r.topic for r in broker.matching_topics(df).collect()] == ["cdc.public.orders"]
    assert tuple(broker.stored_positions(topic(spark)).orderBy("partition").first()) == ("t", 0, 0, 10)


def test_tables_by_path_and_name(spark, shared):
    spark.range(3).write.parquet(shared)
    assert tables.read_table(spark, shared).count() == 3
    spark.range(4).createOrReplaceTempView("numbers")
    assert tables.read_table(spark, "numbers").count() == 4
    assert tables.stream_table(spark, shared, spark.range(1).schema).isStreaming


def test_session_settings(spark):
    assert build_session() is spark
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_dir(spark, "x") != shared_dir(spark, "x")


def test_messages_are_built_below_the_generator(spark):
    """A generator's own expressions are interpreted row by row."""
    from eventlake.queries import feeds

    for rows in (feeds.line_changes(spark, "/root/testdata/sf0.001"), feeds.order_changes(spark, "/root/testdata/sf0.001")):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        made = [line.strip(" +-:*") for line in plan.splitlines() if "StructsToJson" in line]
        assert len(made) == 1 and "Project" in made[0] and "Generate" not in made[0]  # in a generator before


def test_search_documents_read_the_changes_once(spark):
    """Both deliveries come from one reading of the messages."""
    from eventlake.queries import delivery

    df = delivery.search_documents(spark, "/root/testdata/sf0.001")
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1  # two before


@pytest.mark.parametrize("name", ["asof_gaps_chunked", "asof_enrich_chunked"])
def test_as_of_joins_by_chunk_do_not_parse_messages_twice(spark, name):
    from eventlake.queries import orders

    df = orders.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert "from_json" not in df._jdf.queryExecution().optimizedPlan().toString()  # twice before, now in the written rows
