from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlake.llm import negatives, queries

ROWS = "vec_id long, label int, vector array<long>"


def plain(rows, anchors, low=80, high=100):
    """All scores, one anchor at a time; identical anchors count once."""
    rows = [(i, c, v) for i, c, v in rows if i is not None and c is not None and v is not None and None not in v]
    out = []
    for a, label, v in {(i, c, tuple(v)) for i, c, v in rows if anchors(i)}:
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, c == label) for i, c, w in rows if i != a)
        for p, i, own in [s for s in scored if s[2]][:5]:
            fit = [(-s, j) for s, j, same in scored if not same and low * -p <= 100 * -s <= high * -p][:5]
            out.extend((a, i, k, j, -p, s) for k, (s, j) in enumerate(fit, 1))
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def clustered(rng, n, width=8, tight=0.3):
    centers = rng.normal(size=(6, width))
    rows = []
    for i in range(n):
        v = centers[rng.integers(6)] + rng.normal(size=width) * tight
        rows.append((i, int(rng.integers(4)), [math.floor(x * 100) for x in v]))
    return rows


@pytest.mark.parametrize("tight", [0.1, 5.0])
def test_equals_all_scores_over_several_rounds(spark, tight):
    """Small blocks and groups, so that there are several rounds, parts of clusters and floors from earlier rounds."""
    rng = np.random.default_rng(2)
    rows = clustered(rng, 900, tight=tight)
    rows += [(2000 + k, 1, [50, 50, 0, 0, 0, 0, 0, 1]) for k in range(200)]  # one very common vector
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    got = found(negatives.hard_negatives(df, F.col("vec_id") % 20 == 0, group=7, block=16))
    assert got == plain(rows, lambda i: i % 20 == 0)


def test_edge_rows(spark):
    rows = [(0, 1, [3, 4]), (0, 1, [3, 4]), (0, 2, [1, 1]), (100, 1, []), (1, 1, [3, 4, 9]), (2, 1, [6]), (3, 2, [3, 3]), (4, 2, [3, 3]), (4, 2, [3, 3]), (5, 3, [0, 0]),
            (6, None, [1, 1]), (7, 1, None), (8, 2, [1, None]), (None, 2, [3, 4]), (9, 2, [-3, -4]), (10, 1, [-1, 0]), (200, 2, [-5, -5])]
    df = spark.createDataFrame(rows, ROWS).withColumn("score", F.lit("x")).withColumn("id", F.lit(1))
    assert found(negatives.hard_negatives(df, F.col("vec_id") % 100 == 0)) == plain(rows, lambda i: i % 100 == 0)
    large = [(k, k % 2, [(1 << 31) + k, -(1 << 30), k]) for k in range(40)]
    got = found(negatives.hard_negatives(spark.createDataFrame(large, ROWS), F.col("vec_id") % 10 == 0))
    assert got == plain(large, lambda i: i % 10 == 0)
    assert found(negatives.hard_negatives(df.limit(0), F.col("vec_id") % 100 == 0)) == []
    assert found(negatives.hard_negatives(df, F.col("vec_id") == 77)) == []
    assert found(negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, low=50, high=130)) == plain(rows, lambda i: i % 100 == 0, 50, 130)


def test_walk_ends_early_and_misses_nothing():
    rng = np.random.default_rng(4)
    members = rng.integers(80, 120, (5, 16)).astype(float)
    candidates = np.concatenate([rng.integers(60, 140, (50, 16)), rng.integers(-5, 5, (5000, 16))]).astype(float)
    own = negatives.Vectors(np.arange(5), np.zeros(5, np.int64), members)
    others = negatives.Vectors(np.arange(100, 100 + len(candidates)), np.zeros(len(candidates), np.int64), candidates)
    centroid = members.sum(0) / np.linalg.norm(members.sum(0))
    cap, floor = np.full((5, 1), negatives.MOST), np.full((5, 1), negatives.LEAST)
    taken = []
    whole = negatives._products
    try:
        negatives._products = lambda a, b: taken.append(len(b)) or whole(a, b)
        key, score, ids = negatives.walk(own, cap, floor, others, centroid, True, 5)
    finally:
        negatives._products = whole
    assert sum(taken) < len(candidates) / 4  # the bound has certified the rest
    for k in range(5):
        best = sorted(zip(-(candidates @ members[k]), others.ids, strict=True))[:5]
        assert sorted(zip(-score[key == k], ids[key == k], strict=True)) == best


def test_query_leaves_out_broken_vectors(spark, tmp_path):
    rng = random.Random(6)
    rows = [(i, rng.randrange(10), [rng.uniform(-1, 1) for _ in range(4)]) for i in range(300)]
    rows[5] = (5, 1, [float("nan"), 0.0, 0.0, 0.0])
    rows[6] = (6, 1, [float("inf"), 0.0, 0.0, 0.0])
    rows[7] = (7, None, [1.0, 0.0, 0.0, 0.0])
    rows[8] = (8, 1, None)
    rows[9] = (9, 1, [None, 1.0, 0.0, 0.0])
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    usable = [(i, None if c is None else (c + 1) % 10 if i % 7 == 0 else c, None if v is None else [math.floor(256 * float(np.float32(x))) for x in v])
              for i, c, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    assert found(queries.op13_negatives(spark, str(tmp_path))) == plain(usable, lambda i: i % 100 == 0)
