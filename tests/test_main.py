from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from eventlake import __main__ as cli
from test_sinks import folder_client, stored
from test_streams import messages, order_message


def run(job, shared, *more):
    cli.main([job, "--input", f"{shared}/in", "--checkpoint", f"{shared}/cp",
              "--output", f"{shared}/out", "--once", *more])


def test_orders_job(spark, shared, tmp_path):
    messages(spark, f"{shared}/in", [order_message(i) for i in range(6)])
    spark.createDataFrame([("p1", "lamp", "home", "b", 3.0)],
                          "product_id string, product_name string, category string, brand string, "
                          "unit_cost double").write.parquet(f"{shared}/products")
    client = f"{__name__}:open_client"
    globals()["open_client"] = folder_client(str(tmp_path / "store"))
    run("orders", shared, "--products", f"{shared}/products", "--hot-client", client,
        "--search-client", client)
    assert spark.read.parquet(f"{shared}/out/lake").count() == 6
    assert len(stored(str(tmp_path / "store"))) == 12
    assert spark.read.parquet(f"{shared}/out/metrics").agg(F.sum("records_written")).first()[0] == 18


def test_archive_job(spark, shared):
    messages(spark, f"{shared}/in", [order_message(i) for i in range(6)])
    run("archive", shared)
    assert spark.read.parquet(f"{shared}/out/archive").count() == 6
    assert spark.read.parquet(f"{shared}/out/progress").agg(F.sum("records_in")).first()[0] == 6


def test_arguments(shared):
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["orders", "--checkpoint", "c", "--output", "o"])
    with pytest.raises(ValueError, match="opens its client"):
        from eventlake.plans.orders import order_sinks

        order_sinks(None, None, shared)


def test_every_job_has_a_topic_and_a_limit():
    assert cli.TOPICS["orders"] == ("cdc.public.orders", 50_000)
    assert cli.TOPICS["clickstream"][1] == 100_000
    assert all(limit for _, limit in cli.TOPICS.values())
