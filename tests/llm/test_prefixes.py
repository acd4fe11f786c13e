from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import pytest

from eventlake.llm import prefixes, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TURNS = "conv_id long, turn long, role string, text string"


def plain(rows):
    """By lists of whole conversations."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:]
    nodes = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = {}
    for path, members in nodes.items():
        below = [p for p in nodes if p[:len(path)] == path]
        saved = sum((len(nodes[p]) - 1) * len(WORD.findall(p[-1][1])) for p in below if p)
        ends = ",".join(str(c) for c in sorted(c for c in members if len(whole[c]) == len(path)))
        parent = min(nodes[path[:-1]]) if path else None
        leaves = sum(1 for p in below if not any(q[:-1] == p for q in nodes if q))
        out[(min(members), len(path))] = (parent, len(members), sum(1 for p in below if len(p) == len(path) + 1), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
    assert len(out) == len(nodes)
    return out


def trie_of(spark, rows, tmp_path, name="t"):
    spark.createDataFrame(rows, TURNS).withColumn("depth", _lit(1)).write.parquet(f"{tmp_path}/{name}/conversations.parquet")
    found = queries.op11_prefixes(spark, f"{tmp_path}/{name}").collect()
    assert len({(r["conv_id"], r["depth"]) for r in found}) == len(found)
    return {(r["conv_id"], r["depth"]): (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"]) for r in found}


def _lit(value):
    from pyspark.sql import functions as F
    return F.lit(value)


def edge_rows():
    long = "word " * 5000
    rows = [(None, 0, "user", "nobody's"), (1, None, None, None), (1, 0, "user", "one two"), (1, 0, "user", "one two"), (1, 0, "user", "another"),
            (2, 0, "user", None), (2, 1, None, long), (3, 5, "", ""), (-7, 0, "user", "minus"), (-7, 1, "a", "b c"), (-20, 0, "x", "y"), (0, 0, "s", "shared start"),
            (0, 1, "u", "shared\tsecond"), (27, 0, "u", "lost"), (61, 1, "u", "x"), (61, 2, "u", "y"), (61, 3, "u", "z"), (61, 4, "u", "w"), (20, 9, "\x1f", "a:b"), (40, 0, "a", ":b"), (60, 0, "a:", "b")]
    return rows


def test_edge_rows_equal_the_plain_trie(spark, tmp_path):
    assert trie_of(spark, edge_rows(), tmp_path) == plain(edge_rows())


@pytest.mark.parametrize("seed", [1, 2])
def test_random_tables_equal_the_plain_trie(spark, tmp_path, monkeypatch, seed):
    """Few different texts, so that many prefixes are shared; a large group of copies; a long conversation in many stretches."""
    monkeypatch.setattr(prefixes, "STRETCH", 3)
    monkeypatch.setattr(prefixes, "IDS_BITS", 2)
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(-30, 200), 90):
        for turn in range(rng.randrange(1, 6)):
            rows.append((conv, turn, rng.choice("ab"), rng.choice(["x", "y z", "x", None])))
    for conv in range(1000, 1060):
        rows.extend((conv, turn, "u", f"copy {turn}") for turn in range(4))
    rows.extend((2000, turn, "u", f"long {turn % 5}") for turn in range(40))
    rows.extend((2001, turn, "u", f"long {turn % 5}") for turn in range(23))
    rng.shuffle(rows)
    assert trie_of(spark, rows, tmp_path) == plain(rows)


def test_no_conversations(spark, tmp_path):
    assert trie_of(spark, [], tmp_path, "empty") == {}
    assert trie_of(spark, [(None, 1, "a", "b")], tmp_path, "nameless") == {}
    lone = [(7, 0, "a", "b")]  # its own turns give way to those of an absent conversation
    assert trie_of(spark, lone, tmp_path, "turnless") == plain(lone)


def test_end_lists_are_whole(spark):
    turns = spark.createDataFrame([(c, 1, "u", "same") for c in range(9)], "conv_id long, place long, role string, text string")
    trie = prefixes.prefix_trie(turns, turns.select("conv_id"))
    ends = trie.ends.collect()
    assert [(r["conv_id"], r["depth"], sorted(r["ids"])) for r in ends] == [(0, 1, list(range(9)))]
