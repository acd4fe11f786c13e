"""Language-model scores from a weighted backoff automaton over smoothed bigrams.

Every word of the training texts is a state, as is the beginning of a text,
and there is one empty state. From the empty state
every token leads on with its smoothed unigram probability. From state u, a
bigram arc to v weighs log10((c(u, v) - D) / c(u) + b(u) p(v)); any other token
takes the failure arc, of weight log10 b(u), to the empty state, where b(u) is
what the discounts and the bigrams left out leave over. A token leads to its
own state, or the empty one: one pass from left to right carries the state.

The model is never in one place. Texts become blocks of token numbers with a
list of the block's different tokens. Each block asks for the corpus counts of its
different bigrams, packed by ranges of their hashes, then for the counts and discounted
masses of its tokens, and gets back the piece of the automaton that it needs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm import packing
from eventlake.llm.tables import stored
from eventlake.llm.text import LOWER, Hasher, blocks, mix, words

STATE_SHARE = 0          # of the training tokens: every word of them is a state
LEAST_PAIR = 1           # so no bigram is left out
DISCOUNT = 0.75
BLOCK_BYTES = 8 << 20   # of text whose requests are made together
BUCKET_TOKENS = 1 << 21  # whose bigrams are counted together
BEGIN, END = 0, 1        # stand for the beginning and the end token among the 64-bit word hashes


def _token_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, train, text) as block rows: ids, lengths, the sorted hashes of the block's tokens, and each token's place there."""
    part, seq, size = TaskContext.get().partitionId(), 0, 0
    held: list[tuple[list, list, np.ndarray, np.ndarray]] = []

    def row() -> pa.RecordBatch:
        vocabulary, token = np.unique(np.concatenate([x[2] for x in held]), return_inverse=True)
        fields = [(part << 32) + seq, sum((x[0] for x in held), []), sum((x[1] for x in held), []), np.concatenate([x[3] for x in held]).tolist(),
                  vocabulary.tobytes(), packing.encode(token.astype(np.uint32))]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([f], k) for f, k in zip(fields, kinds, strict=True)],
                                          ["block", "ids", "train", "lengths", "vocabulary", "tokens"])

    for batch in batches:
        for block in blocks(batch.column(2)):
            lowered = LOWER[block.data]
            found = words(block)
            hashes = Hasher(lowered)(found.starts, found.ends)
            hashes[hashes <= END] += np.uint64(2)
            lengths = np.diff(found.bounds)
            part_of = batch.slice(block.first, block.n)
            held.append((part_of.column(0).to_pylist(), part_of.column(1).to_pylist(),
                         np.insert(hashes, found.bounds[1:], np.uint64(END)), (lengths + 1).astype(np.int32)))
            size += len(block.data)
            if size >= BLOCK_BYTES:
                yield row()
                seq, size, held = seq + 1, 0, []
    if held:
        yield row()


def _pairs(block: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each token of a block: its place, the place of the one before it, and the hash of both.

    The beginning of a text has the place after all tokens.
    """
    keys = np.append(np.frombuffer(block["vocabulary"], np.uint64), np.uint64(BEGIN))
    token = packing.decode(block["tokens"]).astype(np.int64)
    before = np.concatenate([[0], token[:-1]])
    before[np.cumsum([0, *block["lengths"]])[:-1]] = len(keys) - 1
    return token, before, mix(keys[before] * np.uint64(0x9E3779B97F4A7C15) + keys[token])


def _in_training(block: dict) -> np.ndarray:
    return np.repeat(np.array(block["train"], bool), block["lengths"])


def _counted_pairs(asked: pa.Table, least_pair: int) -> pa.Table:
    """Answers to all requests of one range of hashes: corpus counts, and marks on one request of each bigram."""
    keys = [np.cumsum(packing.unpacked(x), dtype=np.uint64) for x in asked.column("keys").to_pylist()]
    ends = np.cumsum([len(x) for x in keys])[:-1]
    _, first, at = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    n = np.concatenate([packing.unpacked(x) for x in asked.column("n").to_pylist()])
    count = np.bincount(at, weights=n).astype(np.int64)
    count[count < least_pair] = 0
    once = np.zeros(len(at), bool)
    once[first] = True
    return pa.table([asked.column("block"), asked.column("bucket"), pa.array([packing.packed(x) for x in np.split(count[at], ends)], pa.binary()),
                     pa.array([np.packbits(x).tobytes() for x in np.split(once, ends)], pa.binary())], ["block", "bucket", "counts", "once"])


def _token_requests(left: pa.Table, right: pa.Table) -> pa.Table:
    """For each block and different token: its place, hash, count in training texts, and discounted mass of the bigrams marked here."""
    answers, out = right.sort_by("bucket"), []
    for block in left.to_pylist():
        token, before, pair = _pairs(block)
        _, first = np.unique(pair, return_index=True)
        count = np.concatenate([packing.unpacked(x) for x in answers.column("counts").to_pylist()]).astype(np.int64)
        once = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(y) // 8) for x, y in zip(
            answers.column("once").to_pylist(), answers.column("counts").to_pylist(), strict=True)]).astype(bool)
        kept = once & (count > 0)
        keys = np.append(np.frombuffer(block["vocabulary"], np.int64), BEGIN)
        mass = np.bincount(before[first[kept]], weights=count[kept] - DISCOUNT, minlength=len(keys))
        n = np.bincount(token[_in_training(block)], minlength=len(keys))
        n[-1] = sum(block["train"])
        out.append(pa.table([pa.array(np.full(len(keys), block["block"])), pa.array(np.arange(len(keys), dtype=np.int32)), pa.array(keys),
                             pa.array(n.astype(np.int32)), pa.array(mass)], ["block", "place", "key", "n", "mass"]))
    schema = pa.schema([("block", pa.int64()), ("place", pa.int32()), ("key", pa.int64()), ("n", pa.int32()), ("mass", pa.float64())])
    return pa.concat_tables([x.cast(schema) for x in out]) if out else schema.empty_table()


def score_texts(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", least_pair: int = LEAST_PAIR) -> DataFrame:
    """Scores every whole text under a model of the rows where ``train`` holds.

    Tokens are the words, ASCII letters in lower case, and one end token.
    ``base_score`` sums log10((c + 0.1) / (N + 0.1 (V + 1))) with corpus counts;
    these are the automaton's unigrams as well, the unseen sharing one place.
    ``score`` is the automaton's. A null or empty text is an end token only.
    Repeated rows count and score each; a null id stays null. Without training
    rows all tokens are unseen.

    Bigrams are counted by ranges of their hashes, to which each block sends one
    row with its different bigrams there, words by a window over (block, word): a key
    counts once for each block that holds it, however often. The ranges become
    more as the corpus grows. The driver holds two totals.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text_col).cast("string").alias("text"))
    text_blocks = stored(rows.mapInArrow(
        _token_blocks, "block long, ids array<long>, train array<boolean>, lengths array<int>, vocabulary binary, tokens binary"), "lm-blocks")
    all_tokens = text_blocks.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda x, y: x + y))).first()[0] or 0
    buckets = max(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), all_tokens // BUCKET_TOKENS)

    def ask_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.array([(k << 64) // buckets for k in range(1, buckets)], np.uint64)
        for batch in batches:
            for block in batch.to_pylist():
                keys, at = np.unique(_pairs(block)[2], return_inverse=True)
                count = np.bincount(at[_in_training(block)], minlength=len(keys))
                bounds = np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])
                some = np.flatnonzero(np.diff(bounds))
                spans = [slice(bounds[k], bounds[k + 1]) for k in some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), block["block"])), pa.array(some.astype(np.int32)),
                     pa.array([packing.packed(np.diff(keys[x], prepend=np.uint64(0))) for x in spans], pa.binary()),
                     pa.array([packing.packed(count[x]) for x in spans], pa.binary())], ["block", "bucket", "keys", "n"])

    pairs = text_blocks.select("block", "train", "lengths", "vocabulary", "tokens").mapInArrow(ask_pairs, "block long, bucket int, keys binary, n binary")
    paired = stored(pairs.groupBy("bucket").applyInArrow(
        lambda asked: _counted_pairs(asked, least_pair), "block long, bucket int, counts binary, once binary"), "lm-pairs")
    asked = text_blocks.select("block", "train", "lengths", "vocabulary", "tokens").groupBy("block").cogroup(paired.groupBy("block")).applyInArrow(
        _token_requests, "block long, place int, key long, n int, mass double")
    by_key = Window.partitionBy("key")
    counted = stored(asked.select("block", "place", "key", F.sum("n").over(by_key).alias("c"), F.sum("mass").over(by_key).alias("mass"),
                                  (F.min("block").over(by_key) == F.col("block")).alias("once")).where("c > 0"), "lm-tokens")
    total = counted.where(F.col("once") & (F.col("key") != BEGIN)).agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n, v = int(total["n"]), int(total["v"])

    def traverse(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        is_pair = pc.is_valid(right.column("counts"))
        of_tokens, of_pairs = right.filter(pc.invert(is_pair)), right.filter(is_pair).sort_by("place")
        for block in left.to_pylist():
            token, before, pair = _pairs(block)
            count, mass = np.zeros((2, len(block["vocabulary"]) // 8 + 1))
            place = of_tokens.column("place").to_numpy()
            count[place], mass[place] = of_tokens.column("c").to_numpy(), of_tokens.column("mass").to_numpy()
            unigram = (count + 0.1) / (n + 0.1 * (v + 1))
            failure = np.where(count > 0, (count - mass) / np.maximum(count, 1), 1.0)
            # From a state: a bigram arc if there is one, else the failure arc; from the empty state: the unigram.
            p = unigram[token] * failure[before]
            _, at = np.unique(pair, return_inverse=True)
            arc = np.concatenate([packing.unpacked(x) for x in of_pairs.column("counts").to_pylist()]).astype(np.int64)[at]
            has = arc > 0
            p[has] += (arc[has] - DISCOUNT) / count[before[has]]
            first = np.cumsum([0, *block["lengths"]])[:-1]
            known = np.add.reduceat((count[token] > 0).astype(np.int64), first)
            out.append(pa.table([pa.array(block["ids"], pa.int64()), pa.array(block["lengths"], pa.int64()), pa.array(known),
                                 pa.array(np.full(len(known), n)), pa.array(np.add.reduceat(np.log10(unigram[token]), first)),
                                 pa.array(np.add.reduceat(np.log10(p), first))],
                                ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]))
        schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
                            ("base_score", pa.float64()), ("score", pa.float64())])
        return pa.concat_tables([x.cast(schema) for x in out]) if out else schema.empty_table()

    answers = counted.select("block", "place", "c", "mass", F.lit(None).cast("binary").alias("counts")).union(
        paired.select("block", F.col("bucket").alias("place"), F.lit(None).cast("long"), F.lit(None).cast("double"), "counts"))
    return text_blocks.select("block", "ids", "lengths", "vocabulary", "tokens").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        traverse, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
