from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest

from eventlake.llm import neardup, queries
from eventlake.llm.components import components
from eventlake.llm.text import blocks
from tests.llm.conftest import PROSE

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {k: k + 32 for k in range(65, 91)}


def plain_set(text, size):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(zip(*(words[k:] for k in range(size)), strict=False)) if len(words) >= size else frozenset([tuple(words)])


def plain_components(texts, size, percent=80):
    """By comparing all pairs that share a shingle."""
    sets = {i: plain_set(t, size) for i, t in texts}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    holders = {}
    for i, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(i)
    seen = set()
    for same in holders.values():
        for i in same:
            for j in same:
                if i < j and (i, j) not in seen:
                    seen.add((i, j))
                    common = len(sets[i] & sets[j])
                    if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                        a, b = find(i), find(j)
                        root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("size", [2, 5])
def test_shingle_sets(documents, size):
    texts = [t for _, t in documents[:200]] + [None, "", "one", "One two", "a b c d", "a b a b a b"]
    for block in blocks(pa.array(texts)):
        keys, bounds = neardup.shingle_sets(block, size)
        assert np.diff(bounds).tolist() == [len(plain_set(t, size)) for t in texts[block.first:block.first + block.n]]


def test_components_of_documents(spark, documents):
    """The corpus' smaller half, and chains of texts that drift apart, which only links of links hold together."""
    rng = np.random.default_rng(3)
    texts = [(i, t) for i, t in documents[:250] if len(t) < 3000]
    for chain in range(3):
        words = [f"w{rng.integers(10**6)}" for _ in range(60)]
        for step in range(12):
            words[(step * 5) % 60] = f"v{chain}x{step}"
            texts.append((10_000 + 100 * chain + step, " ".join(words)))
    expected = plain_components(texts, 2)
    found = neardup.near_duplicates(spark.createDataFrame(texts, "id long, text string"), size=2).collect()
    assert {r["id"]: (r["n_shingles"], r["component_id"]) for r in found} == expected
    assert len(set(expected.values())) < len(expected)


def test_estimate_is_corrected_for_chance(spark):
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 4000).astype(np.uint64)
    for share in (0.0, 0.5, 0.8, 1.0):
        n = 1000
        common = int(2 * n * share / (1 + share))
        a, b = np.sort(pool[:n]), np.sort(np.concatenate([pool[:common], pool[n:2 * n - common]]))
        low = neardup.minima(np.concatenate([a, b]), np.array([0, n, 2 * n]))
        x, y = neardup.packed_bits(low).tolist()
        from pyspark.sql import functions as F
        row = spark.createDataFrame([(x, y)], "x array<long>, y array<long>").select(neardup.estimate(F.col("x"), F.col("y"))).first()
        assert abs(row[0] - share) < 0.13


def test_edge_rows(edge, nothing, spark):
    kept = neardup.drop_near_duplicates(edge)
    assert kept.columns == edge.columns
    ids = [r["doc_id"] for r in kept.collect()]
    # Rows without an id stay; of the repeated rows one stays; 5 repeats the text of 4 and has 23 of 28 shingles in common with it.
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 6, 7]
    assert ids.count(None) == 1
    rows = neardup.near_duplicates(spark.createDataFrame([(None, PROSE), (3, PROSE.upper()), (9, PROSE), (1, None), (2, " ")], "id long, text string")).collect()
    found = {r["id"]: (r["n_shingles"] > 0, r["component_id"]) for r in rows}
    assert found == {None: (True, 3), 3: (True, 3), 9: (True, 3), 1: (False, 1), 2: (False, 2)}
    assert neardup.drop_near_duplicates(nothing).count() == 0


def test_rows_of_one_id_with_different_texts(spark):
    other = " ".join(f"w{k}" for k in range(40))
    near = other.replace("w7 ", "x ")
    rows = [(5, PROSE), (5, other), (5, PROSE), (7, near), (8, PROSE), (9, None), (9, "")]
    found = neardup.near_duplicates(spark.createDataFrame(rows, "id long, text string"), size=2).collect()
    assert sorted((r["id"], r["component_id"]) for r in found) == [(5, 5), (5, 5), (5, 5), (7, 5), (8, 5), (9, 9), (9, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r["doc_id"], r["text"]) for r in neardup.drop_near_duplicates(docs, size=2).collect()]
    assert len(kept) == 3 and set(kept[:3]) >= {(5, PROSE), (5, other)} and {i for i, _ in kept} == {5, 9}


def test_query_on_short_sets_long_texts_and_a_large_group(spark, tmp_path):
    """The registered query against brute force: sets of 4 to 40 at a similarity of 0.80 and just below, and a group beyond a cell."""
    rng = np.random.default_rng(5)
    texts, at = [], 0

    def add(words):
        nonlocal at
        texts.append((at, " ".join(words)))
        at += 1

    for n in (4, 5, 8, 9, 12, 15, 16, 20, 24, 28, 32, 36, 40):
        for turn in range(12):
            words = [f"k{n}t{turn}x{k}" for k in range(n + 1)]  # n shingles
            add(words)
            add(words + [f"y{k}" for k in range(n // 4)])      # the union is n // 4 larger: 0.80 if 4 divides n
            add(words + [f"z{turn}y{k}" for k in range(n // 4 + 1)])  # below 0.80
    base = [f"b{k}" for k in range(120)]
    for k in range(300):  # near copies whose pairs are partly linked
        words = list(base)
        for place in rng.choice(120, 8, replace=False):
            words[place] = f"c{k}p{place}"
        add(words)
    add([f"l{k}" for k in rng.integers(0, 3000, 60_000)])
    add(texts[-1][1].split()[:50_000])
    expected = plain_components(texts, 2)
    assert len({c for _, c in expected.values()}) < 0.8 * len(texts)
    spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op2_neardup(spark, str(tmp_path)).collect()}
    assert found == expected
    rows = spark.createDataFrame(texts, "id long, text string")
    cells = neardup.near_duplicates(rows, size=2, stars=1, cell_rows=40).collect()
    assert {r["id"]: (r["n_shingles"], r["component_id"]) for r in cells} == expected


def test_connected_components(spark):
    links = [(1, 2), (3, 2), (4, 3), (10, 9), (9, 8), (20, 21)] + [(100 + k, 101 + k) for k in range(40)]
    nodes = sorted({x for pair in links for x in pair} | {77})
    found = components(spark.createDataFrame([(x,) for x in nodes], "id long"), spark.createDataFrame(links, "a long, b long")).collect()
    expected = {1: 1, 2: 1, 3: 1, 4: 1, 10: 8, 9: 8, 8: 8, 20: 20, 21: 20, 77: 77} | {100 + k: 100 for k in range(41)}
    assert {r["id"]: r["component"] for r in found} == expected
