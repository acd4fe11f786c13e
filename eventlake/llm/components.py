"""Connected components of a link table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.tables import stored


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``id`` and ``component`` (the smallest reachable id) of each node; links are pairs ``a``, ``b`` of nodes.

    Alternates two steps on the linked nodes until nothing changes: each node
    hangs its larger neighbours below the smallest node it sees (large star),
    then its smaller neighbours and itself (small star). Rounds are written
    out, so none depends on lost executors; there are about as many as the
    logarithm of the number of links.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    edges = stored(edges, "star")
    mark = _mark(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        edges = stored(small.where("u != v").distinct(), "star")
        found = _mark(edges)
        if found == mark:
            break
        mark = found
    return nodes.join(edges.withColumnRenamed("u", "id"), "id", "left").select("id", F.coalesce("v", "id").alias("component"))


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free checksum of the links."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)
