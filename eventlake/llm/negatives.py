"""Hard negatives by exact search with lists shared by clusters of anchors.

Anchors are clustered by angle. For a cluster, the angle between its centroid
and a candidate, less the angle of its farthest member, bounds the candidate's
inner product with every member. Candidates are sorted by that bound once for
each cluster (each block of candidates holds its share of the list), and every
member walks the list until the bound certifies that nothing further counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from eventlake.llm.tables import sampled, small_batches, stored

FIT_ROWS = 8192      # anchors that the centroids are fitted to
MOST_CLUSTERS = 256
GROUP, BLOCK = 1024, 4096  # members of a cluster, and candidates, that meet in one cell
STEP = 512           # candidates that a member takes from its list at once
ROUNDS = 8           # a round has this many times the candidates of the one before
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
SLACK = 1e-6         # relative, far above what angles lose in floating point

_PAYLOAD = {"ids": pa.binary(), "labels": pa.binary(), "width": pa.int32(), "kind": pa.string(), "payload": pa.binary()}
_GROUP = pa.schema({"cluster": pa.int32(), "part": pa.int64(), "anchor_ids": pa.list_(pa.int64()), "norm": pa.float64(), "radius": pa.float64(), **_PAYLOAD})
_BLOCK = pa.schema({"block": pa.int64(), "bounds": pa.list_(pa.float64()), **_PAYLOAD})


class Vectors(NamedTuple):
    ids: np.ndarray
    labels: np.ndarray
    values: np.ndarray  # float64 (rows x width); integers inside


def _packed(ids: np.ndarray, labels: np.ndarray, lists: pa.Array) -> dict:
    """Vectors as bytes of the narrowest integers that hold them; shorter ones end in zeros."""
    n = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    width = int(n.max(initial=0))
    most = int(max(flat.max(initial=0), -1 - flat.min(initial=0)))
    kind = next(k for k in ("i2", "i4", "i8") if most <= np.iinfo(k).max)
    values = np.zeros((len(n), width), kind)
    values[np.repeat(np.arange(len(n)), n), np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    return {"ids": ids.astype("<i8").tobytes(), "labels": labels.astype("<i8").tobytes(), "width": width, "kind": kind, "payload": values.tobytes()}


def _unpacked(row: dict, prefix: str = "") -> Vectors:
    ids = np.frombuffer(row[prefix + "ids"], "<i8")
    values = np.frombuffer(row[prefix + "payload"], row[prefix + "kind"]).reshape(len(ids), row[prefix + "width"])
    return Vectors(ids, np.frombuffer(row[prefix + "labels"], "<i8"), values.astype(np.float64) if row[prefix + "kind"] != "i8" else values)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors; those beyond 64 bits stay at their limits."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if width == 0:
        return np.zeros((len(a), len(b)))
    x, y = a.astype(np.float64), b.astype(np.float64)
    if width * np.abs(x).max(initial=0) * np.abs(y).max(initial=0) < 2.0**53:
        return x @ y.T
    exact = np.array([[int(x) for x in row] for row in a], object) @ np.array([[int(x) for x in row] for row in b], object).T
    return np.clip(exact, LEAST, MOST).astype(np.int64)


def _angles(values: np.ndarray, centroid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Angle of each vector to a unit vector, and its length; a zero vector has no bound but its length."""
    values = values.astype(np.float64)
    norm = np.sqrt((values * values).sum(1))
    width = min(values.shape[1], len(centroid))
    cosine = (values[:, :width] @ centroid[:width]) / np.where(norm > 0, norm, 1)
    return np.arccos(np.clip(cosine, -1, 1)), norm


def bounds(angle: np.ndarray, norm: np.ndarray, radius: float) -> np.ndarray:
    """What a unit vector within ``radius`` of the centroid can have as inner product with each candidate at most."""
    return norm * (np.cos(np.clip(angle - radius, 0, np.pi)) + SLACK)


def _units(values: np.ndarray) -> np.ndarray:
    norm = np.sqrt((values * values).sum(1, keepdims=True))
    return values / np.where(norm > 0, norm, 1)


def fit_centroids(vectors: list[list[int]], k: int, turns: int = 8) -> np.ndarray:
    """Unit centroids by spherical k-means, begun at vectors spread evenly over the given order."""
    width = max((len(v) for v in vectors), default=0)
    units = _units(np.array([v + [0] * (width - len(v)) for v in vectors], np.float64).reshape(len(vectors), width))
    if not len(units):
        return units
    centroids = units[np.linspace(0, len(units) - 1, min(k, len(units))).astype(int)]
    for _ in range(turns):
        nearest = (units @ centroids.T).argmax(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, units)
        moved = np.sqrt((sums * sums).sum(1)) > 0
        centroids = np.where(moved[:, None], _units(sums), centroids)
    return centroids


def _best(key: np.ndarray, score: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first ``n`` of each key by score (high first) and id, and the rank of each among them."""
    order = np.lexsort((ids, -score, key))
    sorted_key = key[order]
    rank = np.arange(len(order)) - np.searchsorted(sorted_key, sorted_key)
    return order[rank < n], rank[rank < n]


def walk(members: Vectors, cap: np.ndarray, floor: np.ndarray, candidates: Vectors, centroid: np.ndarray, same: bool, n: int):
    """The first ``n`` candidates of each goal: rows of (goal, score, id).

    A member has several goals, each with a cap and a floor (members x goals):
    candidates of the same label (or of others) with floor <= score <= cap. The list is sorted by bound
    once; a member walks it until its length times the bound is below all its
    floors, which rise to the ``n``-th best score found.
    """
    angle, length = _angles(members.values, centroid)
    far, norm = _angles(candidates.values, centroid)
    bound = bounds(far, norm, angle.max(initial=0))
    order = np.argsort(-bound, kind="stable")
    floor, goals = floor.copy(), cap.shape[1]
    key, score, ids = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    for at in range(0, len(order), STEP):
        alive = np.flatnonzero(length * bound[order[at]] + SLACK >= floor.min(1))
        if not len(alive):
            break
        take = order[at:at + STEP]
        scores = _products(members.values[alive], candidates.values[take])
        hit = ((candidates.labels[take] == members.labels[alive][:, None]) == same) & (candidates.ids[take] != members.ids[alive][:, None])
        r, c = np.nonzero(hit & (scores >= floor[alive].min(1)[:, None]) & (scores <= cap[alive].max(1)[:, None]))
        found, who = scores[r, c].astype(np.int64), alive[r]
        e, g = np.nonzero((found[:, None] <= cap[who]) & (found[:, None] >= floor[who]))
        if len(e):
            key, score, ids = (np.concatenate(x) for x in ((key, who[e] * goals + g), (score, found[e]), (ids, candidates.ids[take[c[e]]])))
            kept, rank = _best(key, score, ids, n)
            key, score, ids = key[kept], score[kept], ids[kept]
            full = rank == n - 1
            floor.reshape(-1)[key[full]] = np.maximum(floor.reshape(-1)[key[full]], score[full])
    return key, score, ids


def _walks(centroids: np.ndarray, same: bool, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                members, goals = _unpacked(row), 1 + max(x["goal"] for x in row["goals"])
                cap, floor = np.full((len(members.ids), goals), LEAST), np.full((len(members.ids), goals), MOST)
                for x in row["goals"]:
                    cap[x["slot"], x["goal"]], floor[x["slot"], x["goal"]] = x["cap"], x["floor"]
                key, score, ids = walk(members, cap, floor, _unpacked(row, "c_"), centroids[row["cluster"]], same, n)
                k = len(key)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["cluster"]] * k, pa.int32()), pa.array([row["part"]] * k, pa.int64()), pa.array((key // goals).astype(np.int32)),
                     pa.array((key % goals).astype(np.int32)), pa.array(score), pa.array(ids)], ["cluster", "part", "slot", "goal", "score", "id"])
    return run


_FOUND = "cluster int, part long, slot int, goal int, score long, id long"
_GOAL = ["cluster", "part", "slot", "goal"]


def _ranked(found: DataFrame, n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*_GOAL).orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= n)


def _searched(goals: DataFrame, groups: DataFrame, blocks: DataFrame, centroids: np.ndarray, rounds: int, same: bool, n: int) -> DataFrame:
    """The first ``n`` candidates of each goal (``cluster, part, slot, goal, cap, floor``), over all blocks.

    Each round has ``ROUNDS`` times as many blocks as the one before and goes
    out from the floors found so far, so a block returns few rows. A group
    meets only blocks whose bound reaches the lowest of its floors.
    """
    found = None
    for turn in range(rounds, -1, -1):
        goals = stored(goals, "goals")
        by_group = goals.groupBy("cluster", "part").agg(F.collect_list(F.struct("slot", "goal", "cap", "floor")).alias("goals"), F.min("floor").alias("least"))
        asked = groups.drop("anchor_ids", "radius").join(by_group, ["cluster", "part"])
        now = blocks.where(F.col("round") == turn)
        reach = now.select("block", F.posexplode("bounds").alias("cluster", "bound"))
        cells = reach.join(asked.select("cluster", "part", "norm", "least"), "cluster").where(F.col("norm") * F.col("bound") + SLACK >= F.col("least"))
        pairs = cells.select("block", "cluster", "part").join(asked.drop("norm", "least"), ["cluster", "part"]).join(
            now.select("block", *[F.col(c).alias(f"c_{c}") for c in ("ids", "labels", "width", "kind", "payload")]), "block")
        with small_batches(goals.sparkSession, 8):
            new = stored(pairs.drop("block").mapInArrow(_walks(centroids, same, n), _FOUND), "found")
        found = stored(_ranked(new if found is None else found.drop("rank").union(new), n), "best")
        if turn:
            reached = found.where(F.col("rank") == n).select(*_GOAL, F.col("score").alias("reached"))
            goals = goals.join(reached, _GOAL, "left").withColumn("floor", F.greatest("floor", "reached")).drop("reached")
    return found


def hard_negatives(rows: DataFrame, anchors: Column, n_positives: int = 5, n_negatives: int = 5, low: int = 80, high: int = 100,
                   group: int = GROUP, block: int = BLOCK) -> DataFrame:
    """For each anchor and each of its positives the hardest rows of other labels.

    ``rows`` has ``vec_id`` (long), ``label`` (int) and ``vector`` (array of
    long); ``anchors`` is a condition on them. Scores are inner products. An
    anchor's positives are its first rows of the same label, by score (high
    first) and ``vec_id``; the negatives of a positive with score p are the
    first rows of other labels with low * p <= 100 * score <= high * p.

    Rows with a null in any of the three columns or in the vector take no
    part. A row with the anchor's own ``vec_id`` is no partner of it;
    identical anchors count once, any other repeated row stands for itself.
    Missing components of a shorter vector count as zero.

    The driver holds centroids (up to 256, fitted to 8,192 anchors at most)
    and a radius for each; all anchors and candidates are searched exactly.
    """
    spark = rows.sparkSession
    complete = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull())
    rows = rows.where(complete).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("vector").cast("array<long>").alias("vector"))
    asked = stored(rows.where(anchors).distinct(), "anchors")
    fitted = [r["vector"] for r in sampled(asked, "vec_id", FIT_ROWS).orderBy("vec_id", "label", "vector").collect()]
    centroids = fit_centroids(fitted, min(MOST_CLUSTERS, max(1, round(asked.count() ** 0.5))))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _unpacked(_packed(batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2))).values
            width = min(values.shape[1], centroids.shape[1])
            nearest = (values[:, :width].astype(np.float64) @ centroids[:, :width].T).argmax(1) if len(centroids) else np.zeros(len(values), np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest.astype(np.int32))], ["vec_id", "label", "vector", "cluster"])

    clustered = stored(asked.mapInArrow(placed, "vec_id long, label long, vector array<long>, cluster int"), "clustered")
    sizes = clustered.groupBy("cluster").agg(F.count("*").alias("n"))
    dealt = clustered.join(sizes, "cluster").withColumn("part", F.pmod(F.xxhash64("vec_id", "label", F.lit(3)), F.ceil(F.col("n") / group).cast("long")))

    def gathered(key: tuple, own: pa.Table) -> pa.Table:
        own = own.sort_by([("vec_id", "ascending"), ("label", "ascending")]).combine_chunks()
        lists = own.column("vector").combine_chunks()
        out = _packed(own.column("vec_id").to_numpy(), own.column("label").to_numpy(), lists)
        angle, norm = _angles(_unpacked(out).values, centroids[key[0].as_py()])
        out |= {"cluster": key[0].as_py(), "part": key[1].as_py(), "anchor_ids": own.column("vec_id").to_pylist(), "norm": float(norm.max()), "radius": float(angle.max())}
        return pa.Table.from_pylist([out], _GROUP)

    groups = stored(dealt.groupBy("cluster", "part").applyInArrow(gathered, from_arrow_schema(_GROUP)), "groups")
    radius = np.zeros(len(centroids))
    for r in groups.groupBy("cluster").agg(F.max("radius").alias("radius")).collect():
        radius[r["cluster"]] = r["radius"]

    def boxed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                out = _packed(part.column(0).to_numpy(), part.column(1).to_numpy(), part.column(2))
                values = _unpacked(out).values
                out |= {"block": number, "bounds": [float(bounds(*_angles(values, c), r).max()) for c, r in zip(centroids, radius, strict=True)]}
                number += 1
                yield pa.RecordBatch.from_pylist([out], _BLOCK)

    with small_batches(spark, block):
        blocks = stored(rows.mapInArrow(boxed, from_arrow_schema(_BLOCK)), "blocks")
    n_blocks, rounds = blocks.count(), 0
    while ROUNDS ** (rounds + 1) <= n_blocks:
        rounds += 1
    chance = F.pmod(F.xxhash64("block", F.lit(11)), F.lit(ROUNDS ** rounds))
    turn = sum((F.when(chance % ROUNDS ** k == 0, 1).otherwise(0) for k in range(1, rounds + 1)), F.lit(0))
    blocks = blocks.withColumn("round", turn)

    slots = groups.select("cluster", "part", F.posexplode("anchor_ids").alias("slot", "anchor_id"))
    any_score = slots.select("cluster", "part", "slot", F.lit(0).alias("goal"), F.lit(MOST).alias("cap"), F.lit(LEAST).alias("floor"))
    positives = _searched(any_score, groups, blocks, centroids, rounds, True, n_positives)
    positives = positives.select("cluster", "part", "slot", F.col("rank").alias("goal"), F.col("score").alias("positive_score"), F.col("id").alias("positive_id"))
    # percent * score / 100, rounded down or up, without leaving 64 bits.
    score = F.col("positive_score")
    rest = F.pmod(score, F.lit(100))
    hundreds = (score - rest).cast("decimal(19,0)") / 100
    cap, floor = (hundreds.cast("long") * p + f(rest * p / 100).cast("long") for p, f in ((high, F.floor), (low, F.ceil)))
    within = positives.select("cluster", "part", "slot", "goal", cap.alias("cap"), floor.alias("floor")).where("floor <= cap")
    negatives = _searched(within, groups, blocks, centroids, rounds, False, n_negatives)
    return negatives.join(positives, _GOAL).join(slots, ["cluster", "part", "slot"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
