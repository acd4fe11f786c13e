"""Prefix trie of conversations by whole-sequence collapse.

Identical conversations become one weighted sequence with the list of those
that end there. Sequences that are proper prefixes of others are found by an
anti-join; the rest are the leaves. Weighted prefixes are then aggregated. A
prefix is known by its depth and 128 bits: the exclusive or of digests of
(place, role, text), so running values can be cut anywhere and put together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.tables import stored

WORD = r"[^\x20\x09-\x0D]+"
STRETCH = 4096  # turns of one conversation that are summed in one task
IDS_BITS = 12   # ids that share all but these low bits are listed together


class Trie(NamedTuple):
    nodes: DataFrame  # conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    ends: DataFrame   # conv_id, depth, part, ids: sorted stretches of the conversations that end at a node, in the order of part


def placed(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` (from 1, by turn, null first, ties by role and text), ``role``, ``text`` of each turn with a conversation.

    Turns are dealt out by ranges, so a conversation of any length is spread
    over tasks; counts of the ranges before give each its first place.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    first = F.col("turn").asc_nulls_first()
    dealt = rows.repartitionByRange("conv_id", first, F.substring("role", 1, 16), F.substring("text", 1, 32))
    ordered = Window.partitionBy("range", "conv_id").orderBy(first, "role", "text")
    local = stored(dealt.withColumn("range", F.spark_partition_id()).withColumn("inner", F.row_number().over(ordered)).drop("turn"), "placed")
    counts = local.groupBy("conv_id", "range").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("conv_id").orderBy("range")) - F.col("n"))
    # Two conversations of a range at most go on in or come from another.
    return local.join(before.where("before > 0").select("conv_id", "range", "before"), ["conv_id", "range"], "left").select(
        "conv_id", (F.col("inner") + F.coalesce("before", F.lit(0))).alias("place"), "role", "text")


def rebuilt(turns: DataFrame, group: int = 20, shared: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns come from the first of their group, and all ids.

    Of conversation c - c % ``group`` the first h turns come before c's own
    turns after its first h, where h is crc32 of c in decimal modulo
    ``shared``. Returns ``conv_id``, ``place``, ``role``, ``text``, and the
    ``conv_id`` of every conversation, also of those left without a turn.
    """
    rows = placed(turns)
    h = F.crc32(F.col("conv_id").cast("string")) % shared
    lengths = rows.groupBy("conv_id").agg(F.least(F.max("place"), F.lit(shared)).alias("n"))
    origin = (F.col("conv_id") - F.col("conv_id") % group).alias("origin")
    convs = lengths.select("conv_id", origin, h.alias("h")).join(lengths.select(F.col("conv_id").alias("origin"), "n"), "origin", "left")
    convs = stored(convs.select("conv_id", "origin", "h", F.least("h", F.coalesce("n", F.lit(0))).alias("taken")), "origins")
    first = rows.where((F.col("place") < shared) & (F.col("conv_id") % group == 0)).withColumnRenamed("conv_id", "origin")
    given = convs.where("h > 0").join(first, "origin").where("place <= h").select("conv_id", "place", "role", "text")
    own = rows.where(F.col("place") > h)
    short = convs.where("taken < h").select("conv_id", (F.col("h") - F.col("taken")).alias("lack"))
    own = own.join(short, "conv_id", "left").select("conv_id", (F.col("place") - F.coalesce("lack", F.lit(0))).alias("place"), "role", "text")
    return given.union(own), convs.select("conv_id")


def _halves(digest: Column) -> list[Column]:
    return [F.conv(F.substring(digest, at, 16), 16, -10).cast("long") for at in (1, 17)]


def _running(turns: DataFrame) -> DataFrame:
    """Each turn's prefix: ``conv_id``, ``depth``, ``a``, ``b`` (its 128 bits), ``words``, ``upto`` (words of all turns so far).

    Sums run within stretches of turns; those of later stretches get what the
    ones before add up to.
    """
    turn = F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text"))
    a, b = _halves(F.md5(F.concat_ws(":", F.col("place").cast("string"), turn)))
    rows = turns.select("conv_id", F.col("place").cast("long").alias("depth"), a.alias("a"), b.alias("b"),
                        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"), F.floor((F.col("place") - 1) / STRETCH).alias("stretch"))
    sums = {"a": F.bit_xor("a"), "b": F.bit_xor("b"), "upto": F.sum("words")}
    so_far = Window.partitionBy("conv_id", "stretch").orderBy("depth")
    inner = rows.select("conv_id", "depth", "stretch", "words", *[c.over(so_far).alias(k) for k, c in sums.items()])
    long = rows.where("stretch > 0").select("conv_id").distinct()
    whole = rows.join(long, "conv_id", "left_semi").groupBy("conv_id", "stretch").agg(*[c.alias(k) for k, c in sums.items()])
    earlier = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    before = whole.select("conv_id", "stretch", F.bit_xor("a").over(earlier).alias("a0"), F.bit_xor("b").over(earlier).alias("b0"), F.sum("upto").over(earlier).alias("upto0"))
    later = inner.where("stretch > 0").join(before.where("stretch > 0"), ["conv_id", "stretch"]).select(
        "conv_id", "depth", "words", F.col("a").bitwiseXOR(F.col("a0")).alias("a"), F.col("b").bitwiseXOR(F.col("b0")).alias("b"), (F.col("upto") + F.col("upto0")).alias("upto"))
    return inner.where("stretch = 0").select(*later.columns).union(later)


def prefix_trie(turns: DataFrame, convs: DataFrame) -> Trie:
    """Nodes of the trie of whole conversations, and the conversations that end at each.

    ``turns`` has ``conv_id``, ``place`` (1, 2, ... in each conversation),
    ``role`` and ``text``; ``convs`` the distinct ids, with or without turns.
    A node is named by its smallest member and its depth; the root has depth 0
    and no parent. ``saved_tokens`` sums (members - 1) times the words of the
    last turn over a node's subtree. Without conversations there is no node.

    Copies of a conversation are folded before their turns go on, and every
    sum over a node's members is combined before it is shuffled.
    """
    key = ["depth", "a", "b"]
    prefixes = stored(_running(turns), "running")
    lasts = prefixes.groupBy("conv_id").agg(F.max(F.struct("depth", "a", "b", "upto")).alias("last"))
    empty = F.struct(F.lit(0).cast("long").alias("depth"), *[F.lit(0).cast("long").alias(c) for c in ("a", "b", "upto")])
    wholes = stored(convs.select(F.col("conv_id").cast("long").alias("conv_id")).join(lasts, "conv_id", "left").select(
        "conv_id", F.coalesce("last", empty).alias("last")).select("conv_id", "last.*"), "wholes")
    sequences = stored(wholes.groupBy(*key, "upto").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("weight")), "sequences")
    least, members, spoken, deepest = sequences.agg(F.min("conv_id"), F.sum("weight"), F.sum(F.col("weight") * F.col("upto")), F.max("depth")).first()
    sized = sequences.select("conv_id", "weight", F.col("upto").alias("total"), F.col("depth").alias("length"))
    paths = stored(prefixes.join(sized, "conv_id"), "paths")
    proper = paths.where("depth < length").select(*key).distinct()
    leaves = sequences.where("depth > 0").join(proper, key, "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    owners = paths.groupBy(*key).agg(F.min("conv_id").alias("owner"))
    after = F.col("total") - F.col("upto") + F.col("words")  # words from this turn to the end
    walked = stored(paths.join(owners, key).join(leaves, "conv_id", "left").select(
        "conv_id", "depth", "length", "owner", "words", "weight", F.coalesce("leaf", F.lit(0)).alias("leaf"), after.alias("after")), "walked")
    # A sequence owns the nodes from some depth on: those of which it is the smallest member.
    owned = walked.where("owner = conv_id").groupBy("conv_id").agg(F.min("depth").alias("own_from"), F.max("after").alias("own_words"))
    fresh = F.when(F.col("depth") >= F.col("own_from"), F.col("after")).otherwise(F.coalesce("own_words", F.lit(0)))
    sums = walked.join(owned, "conv_id", "left").groupBy("owner", "depth").agg(
        F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"), (F.sum(F.col("weight") * F.col("after")) - F.sum(fresh)).alias("saved_tokens"))
    sums = sums.withColumnRenamed("owner", "conv_id")
    above = walked.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("owner").alias("above"))
    below = stored(sums.join(above, ["conv_id", "depth"], "left").select(
        "*", F.when(F.col("depth") == 1, F.lit(least)).otherwise(F.col("above")).cast("long").alias("parent_conv_id")).drop("above"), "nodes")
    children = below.groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    fresh_words = owned.agg(F.sum("own_words")).first()[0] or 0
    # A root without children is a leaf itself.
    n_leaves = leaves.count() if deepest else 1
    top = turns.sparkSession.range(0 if least is None else 1).select(
        F.lit(least).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(members).cast("long").alias("n_convs"),
        F.lit(n_leaves).cast("long").alias("n_leaves"), F.lit((spoken or 0) - fresh_words).cast("long").alias("saved_tokens"), F.lit(None).cast("long").alias("parent_conv_id"))
    nodes = below.unionByName(top).join(children, ["conv_id", "depth"], "left").select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens")
    lists = wholes.groupBy(*key, F.shiftright("conv_id", IDS_BITS).alias("part")).agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    named = walked.where("depth = length").select("conv_id", F.col("owner").alias("node")).join(sequences.select("conv_id", *key), "conv_id").select(*key, "node")
    if least is not None:
        named = named.union(sequences.where("depth = 0").select(*key, F.lit(least).cast("long").alias("node")))
    ends = lists.join(named, key).select(F.col("node").alias("conv_id"), "depth", "part", "ids")
    return Trie(nodes, ends)


def _joined_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's parts, comma-joined; rows come sorted by node and part, and only the state of one hash is held."""
    node, state = None, None
    for batch in batches:
        done = []
        for conv, depth, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "depth", "text")), strict=True):
            if (conv, depth) != node:
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = (conv, depth), hashlib.sha256(text.encode())
            else:
                state.update(f",{text}".encode())
        yield _hash_rows(done)
    if node is not None:
        yield _hash_rows([(*node, state.hexdigest())])


def _hash_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.string()), strict=True)], ["conv_id", "depth", "ends_sha256"])


def ends_digest(ends: DataFrame) -> DataFrame:
    """``conv_id``, ``depth``, ``ends_sha256``: SHA-256 of a node's whole end list in decimal, comma-joined.

    A list in one part is hashed in place. One in several parts goes to one
    task as a stream of parts of up to 4,096 ids, as SHA-256 reads its input in order.
    """
    text = ends.select("conv_id", "depth", "part", F.array_join(F.col("ids").cast("array<string>"), ",").alias("text"))
    many = ends.groupBy("conv_id", "depth").agg(F.count("*").alias("parts")).where("parts > 1").select("conv_id", "depth")
    one = text.join(many, ["conv_id", "depth"], "left_anti").select("conv_id", "depth", F.sha2("text", 256).alias("ends_sha256"))
    streamed = text.join(many, ["conv_id", "depth"], "left_semi").repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "part")
    return one.union(streamed.select("conv_id", "depth", "text").mapInArrow(_joined_hashes, "conv_id long, depth long, ends_sha256 string"))
