from eventlake.queries import feeds


def test_no_stage_is_left_to_the_interpreter(spark):
    """The messages' stage had a method of 13,982 bytes, which the JVM never compiles."""
    feeds.line_changes(spark, "/root/testdata/sf0.001")
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_a_stream_join_keeps_one_store_for_each_partition(spark):
    from pathlib import Path

    from eventlake.queries import streams

    rows = streams.interval_join_stream(spark, "/root/testdata/sf0.001")
    checkpoint = Path(rows.inputFiles()[0].removeprefix("file://").split("/out/")[0]) / "checkpoint"
    stores = [p for p in (checkpoint / "state" / "0").glob("[0-9]*")]
    assert stores and not any((p / "left-keyToNumValues").exists() for p in stores)  # one of four stores before
