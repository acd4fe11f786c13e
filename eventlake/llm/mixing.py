"""Mixing sources to target weights: block quotas split over output shards by a hypergeometric tree.

Each source's documents are dealt into blocks by a hash. A source's target is
met by drawing whole blocks in a permuted order, each at most once a pass, and
part of one more block. How many draws of each source go to which output shard
is decided by a binary tree over the shards: a node hands its left half as many
draws as the half has room for, composed as a draw without replacement would
(multivariate hypergeometric), and the rest to the right. The leaves' quotas are exact, and a
source's draws, in their permuted order, are cut into one range for each shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.tables import stored

WEIGHTS = (5, 2, 1)
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[int], total: float, weights: tuple[float, ...] = WEIGHTS, most: float = 2.0) -> list[float]:
    """Shares of ``total`` by weight, none above ``most`` times its size; what is cut off goes to the others by weight.

    Cutting off and sharing again until nothing exceeds its bound ends at one
    level L with target = min(bound, L * weight); sources fill up in order
    of bound / weight.
    """
    weight = [weights[k % len(weights)] for k in range(len(sizes))]
    bound = [most * s for s in sizes]
    left, open_weight, level = float(total), float(sum(weight)), 0.0
    for k in sorted(range(len(sizes)), key=lambda k: (bound[k] / weight[k], k)):
        level = left / open_weight
        if bound[k] > level * weight[k]:
            break
        left, open_weight = left - bound[k], open_weight - weight[k]
        level = bound[k] / weight[k]
    return [min(b, level * w) for b, w in zip(bound, weight, strict=True)]


def split_quotas(quotas: np.ndarray, shards: int, seed: int, first: int, last: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each shard from ``first`` to before ``last``: where its range begins in each source's draws, and its quotas.

    Every node of the tree has its own random numbers, so any part of the tree
    can be worked out alone.
    """
    total = int(quotas.sum())

    def room(shard: int) -> int:
        return shard * total // shards  # draws in all shards before

    def walk(low: int, high: int, begin: np.ndarray, mine: np.ndarray):
        if high <= first or low >= last:
            return
        if high - low == 1:
            yield low, begin, mine
            return
        mid = (low + high) // 2
        rng = np.random.default_rng([seed, low, high])
        left = rng.multivariate_hypergeometric(mine, room(mid) - room(low), method="marginals")
        yield from walk(low, mid, begin, left)
        yield from walk(mid, high, begin + left, mine - left)

    yield from walk(0, shards, np.zeros_like(quotas), quotas)


def sized(docs: DataFrame, keep: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """Each document as ``row`` (the columns in ``keep``, all by default) with its size in words, source and a hash."""
    text = F.col(text_col).cast("string")
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in (keep or docs.columns)]).alias("row"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.col(source_col).cast("string").alias("source"),
        F.xxhash64(F.col(id_col), text).alias("key"))


def draw(rows: DataFrame, total_share: float = 1.5, weights: tuple[float, ...] = WEIGHTS, most: float = 2.0,
         block_words: int = 200_000, most_blocks: int = 1 << 20, shard_blocks: int = 64, seed: int = 11) -> DataFrame:
    """Adds ``source_size``, ``target`` and ``shards`` to the rows of ``sized``: the output shards a document is drawn into.

    Sources, in order of their code points and null last, have ``weights`` in
    turn and share ``total_share`` of all words; a target stops at ``most``
    times its source. A document is drawn once for each full pass over its
    source, and once more if its block is drawn in the last pass. Only the last
    block drawn is taken in part: its documents in hash order, each that still
    fits. Draws depend on hashes only, so reruns agree; rows that are the same
    in id and text are told apart by nothing and count one by one.

    Blocks have about ``block_words`` words, more if there would be over
    ``most_blocks``. The driver sees one row for each source. An empty table
    gives an empty result, a document without words is drawn but takes none.
    """
    spark = rows.sparkSession
    sums = rows.groupBy("source").agg(F.sum("size").alias("words")).collect()
    sums = sorted(sums, key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [int(r["words"]) for r in sums]
    wanted = targets(sizes, total_share * sum(sizes), weights, most)
    block_words = max(block_words, -(-sum(sizes) // most_blocks))
    counts = [max(1, round(s / block_words)) for s in sizes]
    source_rows = [(r["source"], k, sizes[k], wanted[k], counts[k]) for k, r in enumerate(sums)]
    sources = spark.createDataFrame(source_rows, "source string, rank int, source_size long, target double, n_blocks long")
    dealt = rows.join(sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn(
        "block", F.pmod(F.xxhash64("key", F.lit(seed)), F.col("n_blocks")))

    # Where each block stands in its source's permuted order, and how much of the last pass is left there.
    order = Window.partitionBy("rank").orderBy(F.xxhash64("rank", "block", F.lit(seed + 1)), "block")
    sums = dealt.groupBy("rank", "block").agg(F.sum("size").alias("words"), F.first("source_size").alias("source_size"),
                                              F.first("target").alias("target"))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    listed = sums.select(
        "rank", "block", "words", passes.alias("passes"), F.row_number().over(order).alias("place"),
        (F.col("target") - passes * F.col("source_size")).alias("rest"), F.sum("words").over(order).alias("upto"))
    listed = listed.select(
        "rank", "block", "passes", "place",
        (F.col("passes") + ((F.col("upto") <= F.col("rest")) & (F.col("rest") > 0)).cast("int")).alias("whole"),
        F.when((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("words") < F.col("rest")),
               F.col("rest") - (F.col("upto") - F.col("words"))).alias("left"))
    listed = stored(listed, "mix-blocks")

    # Draws of a source in order: pass by pass, within a pass in the permuted order of the blocks.
    quotas = np.zeros(len(sizes), np.int64)
    per_source = listed.groupBy("rank").agg(F.sum(F.col("whole") + F.col("left").isNotNull().cast("int")).alias("n"),
                                            F.count("*").alias("present")).collect()
    for r in per_source:
        quotas[r["rank"]] = r["n"]
    present = spark.createDataFrame([(r["rank"], r["present"]) for r in per_source], "rank int, present long")
    shards = max(1, -(-int(quotas.sum()) // shard_blocks))

    def leaves(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for low in frame["id"]:
                for shard, begin, mine in split_quotas(quotas, shards, seed, int(low), min(int(low) + 64, shards)):
                    used = np.flatnonzero(mine)
                    yield pd.DataFrame({"rank": used.astype(np.int32), "shard": shard, "begin": begin[used], "n": mine[used]})

    ranges = spark.range(0, shards, 64).mapInPandas(leaves, "rank int, shard long, begin long, n long")
    placed = ranges.select("rank", "shard", F.explode(F.sequence("begin", F.col("begin") + F.col("n") - 1)).alias("at"))
    n_draws = F.col("whole") + F.col("left").isNotNull().cast("long")
    draws = listed.where(n_draws > 0).join(present, "rank").select(
        "rank", "block", "present", "place", "whole", F.explode(F.sequence(F.lit(1).cast("long"), n_draws)).alias("nth"))
    draws = draws.select("rank", "block", (F.col("nth") > F.col("whole")).alias("part"),
                         ((F.col("nth") - 1) * F.col("present") + F.col("place") - 1).alias("at"))
    drawn = draws.join(placed, ["rank", "at"]).groupBy("rank", "block").agg(
        F.array_sort(F.collect_list(F.when(~F.col("part"), F.col("shard")))).alias("whole_shards"),
        F.max(F.when(F.col("part"), F.col("shard"))).alias("part_shard"))
    blocks = stored(listed.select("rank", "block", "left").join(drawn, ["rank", "block"], "left").withColumn(
        "whole_shards", F.coalesce("whole_shards", F.array().cast("array<bigint>"))), "mix-draws")

    out = dealt.join(blocks, ["rank", "block"])
    full = out.where("left is null").withColumn("shards", F.col("whole_shards"))
    inside = Window.partitionBy("rank", "block").orderBy(F.xxhash64("key", F.lit(seed + 2)), "key", "size")
    edge = out.where("left is not null").withColumn("nth", F.row_number().over(inside))

    def fitting(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("nth")
        left, taken = float(frame["left"].iloc[0]), []
        for size in frame["size"]:
            taken.append(size <= left)
            left -= size if size <= left else 0
        return frame.loc[taken, ["rank", "nth"]]

    taken = edge.select("rank", "nth", "size", "left").groupBy("rank").applyInPandas(fitting, "rank int, nth int")
    edge = edge.join(taken.withColumn("fits", F.lit(True)), ["rank", "nth"], "left").withColumn(
        "shards", F.when(F.col("fits"), F.concat("whole_shards", F.array("part_shard"))).otherwise(F.col("whole_shards")))
    shown = ["row", "size", "source", "key", "source_size", "target", "shards"]
    return full.select(*shown).unionByName(edge.select(*shown))


def mixed(docs: DataFrame, seed: int = 11, **options) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: each document as often as drawn, by shard, shuffled within a shard."""
    copies = draw(sized(docs), seed=seed, **options).select("row", "key", F.posexplode("shards").alias("nth", "shard"))
    shuffled = copies.repartition("shard").sortWithinPartitions("shard", F.xxhash64("key", "nth", F.lit(seed + 3)))
    return shuffled.select("row.*")
