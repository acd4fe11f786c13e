"""Toxicity by multiple-instance learning: sentences are scored, a noisy-or joins them, documents carry the labels."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.tables import sampled
from eventlake.llm.text import LOWER, Block, Hasher, blocks, row_sums, runs, views

BUCKETS = 1 << 18
BEGINNINGS = (5, 7)  # bytes of a word's beginning that count as features besides the whole word
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?\n")] = True


@dataclass(frozen=True)
class Sentences:
    """Sentences with at least one word, of one block."""

    bucket: np.ndarray  # of each feature: the words, and their beginnings
    words: np.ndarray   # each sentence's first feature; one more at the end
    rows: np.ndarray    # each row's first sentence; one more at the end
    starts: np.ndarray  # byte bounds within the block
    ends: np.ndarray


def sentences(block: Block) -> Sentences:
    """Sentences end at ``. ! ?`` or a line feed; words are runs of letters, digits and non-ASCII bytes, in lower case."""
    data = LOWER[block.data]
    word_starts, word_ends = runs(_IN_WORD[data])
    starts, ends = runs(~_ENDS[data])
    first = np.searchsorted(word_starts, starts)
    filled = first < np.searchsorted(word_starts, ends)
    starts, ends = starts[filled], ends[filled]
    hashes = Hasher(data)
    cuts = [word_ends, *(np.minimum(word_starts + n, word_ends) for n in BEGINNINGS)]
    keys = np.stack([hashes(word_starts, cut) * np.uint64(2 * k + 1) for k, cut in enumerate(cuts)], axis=1)
    bucket = (keys >> np.uint64(40)).astype(np.int64).ravel() & (BUCKETS - 1)
    bounds = np.append(first[filled], len(word_starts)) * len(cuts)
    return Sentences(bucket, bounds, np.searchsorted(starts, block.rows), starts, ends)


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return np.exp(-_softplus(-z))


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray  # float32, one for each bucket
    bias: float

    def sentence_logits(self, s: Sentences) -> np.ndarray:
        return self.bias + row_sums(self.weights[s.bucket].astype(np.float64), s.words)


def _owners(bounds: np.ndarray, low: int, high: int) -> np.ndarray:
    """The sentence of each of the features ``low`` to ``high``, where ``bounds`` has each sentence's first."""
    first, last = np.searchsorted(bounds, [low, high - 1], side="right") - 1
    return np.repeat(np.arange(first, last + 1), np.diff(np.clip(bounds[first:last + 2], low, high)))


def _pieces(n: int, step: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Features piece by piece, as the values of all of them at once would fill the driver."""
    return ((at, min(n, at + step)) for at in range(0, n, step))


@dataclass(frozen=True)
class Features:
    """The features that count, of documents one after the other."""

    used: np.ndarray    # their buckets
    word: np.ndarray    # each feature's place in ``used``
    bounds: np.ndarray  # each sentence's first feature; one more at the end
    rows: np.ndarray    # each document's first sentence; one more at the end


def common_features(buckets: list[memoryview], lengths: list[memoryview], least_docs: int = 4) -> Features:
    """Of each document come its features' buckets and the number of features of each sentence, as 32-bit integers.

    Features of under ``least_docs`` documents are left out; the rest is held once.
    """
    rows = np.cumsum([0, *(len(x) // 4 for x in lengths)])
    holders = np.zeros(BUCKETS, np.int32)
    for held in buckets:
        holders[np.unique(np.frombuffer(held, np.int32))] += 1
    used = np.flatnonzero(holders >= least_docs)
    place = np.full(BUCKETS, -1, np.int32)
    place[used] = np.arange(len(used))
    word = np.empty(sum(np.count_nonzero(holders[np.frombuffer(x, np.int32)] >= least_docs) for x in buckets), np.int32)
    bounds, at = np.zeros(rows[-1] + 1, np.int64), 0
    for low, held, sizes in zip(rows[:-1], buckets, lengths, strict=True):
        found = place[np.frombuffer(held, np.int32)]
        ends = np.cumsum(np.frombuffer(sizes, np.int32))
        bounds[low + 1:low + 1 + len(ends)] = at + np.append(0, np.cumsum(found >= 0))[ends]
        found = found[found >= 0]
        word[at:at + len(found)] = found
        at += len(found)
    return Features(used, word, bounds, rows)


def fit_noisy_or(features: Features, y: np.ndarray, steps: int = 120, rate: float = 0.15, sparsity: float = 2e-4) -> ToxicityModel:
    """Fits sentence weights to document labels.

    A document is toxic unless none of its sentences is: P = 1 - prod(1 - p_s).
    With q = -log(1 - P) = sum of softplus(z_s), the gradient of the log loss
    by z_s is p_s for a clean document and -p_s (1 - P) / P for a toxic one. Adam
    steps over all rows, each shrinking weights towards zero; features left out carry no weight.
    """
    weights = np.zeros(BUCKETS)
    n = len(y)
    if not n or not y.any():
        return ToxicityModel(weights.astype(np.float32), -20.0)
    used, word, bounds = features.used, features.word, features.bounds
    sentence_row = np.repeat(np.arange(n, dtype=np.int32), np.diff(features.rows))
    per_doc = max(1.0, len(sentence_row) / n)
    w, bias = np.zeros(len(used)), float(np.log(y.mean() / per_doc + 1e-9))
    m, v, mb, vb = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
    y_s = y[sentence_row]
    for step in range(1, steps + 1):
        z = np.zeros(len(sentence_row))
        for low, high in _pieces(len(word)):
            z += np.bincount(_owners(bounds, low, high), w[word[low:high]], len(z))
        z = bias + z
        p = _sigmoid(z)
        q = np.bincount(sentence_row, _softplus(z), n)
        ratio = np.exp(-q) / np.maximum(-np.expm1(-q), 1e-9)
        by_sentence = np.where(y_s > 0, -p * ratio[sentence_row], p) / n
        grad = np.zeros(len(used))
        for low, high in _pieces(len(word)):
            grad += np.bincount(word[low:high], by_sentence[_owners(bounds, low, high)], len(used))
        grad = grad + 1e-6 * w
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        mb, vb = 0.9 * mb + 0.1 * by_sentence.sum(), 0.99 * vb + 0.01 * by_sentence.sum() ** 2
        up = rate * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        scale = up / (np.sqrt(v) + 1e-7)
        w = w - scale * m
        w = np.sign(w) * np.maximum(np.abs(w) - sparsity * scale, 0)
        bias -= up * mb / (np.sqrt(vb) + 1e-7)
    weights[used] = w
    return ToxicityModel(weights.astype(np.float32), float(bias))


def train_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = 5_000) -> ToxicityModel:
    """A model of ``labels.toxic``, from the whole texts of about ``max_rows`` labelled documents at most.

    Rows with a null id or label are left out; an id with two labels counts
    as toxic if one of them says so. Without toxic rows nothing is toxic.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = sampled(known, "doc_id", max_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(2)):
                s = sentences(block)
                rows = []
                for r in range(block.n):
                    a, b = s.rows[r], s.rows[r + 1]
                    rows.append((s.bucket[s.words[a]:s.words[b]].astype(np.int32).tobytes(),
                                 np.diff(s.words[a:b + 1]).astype(np.int32).tobytes()))
                part = batch.slice(block.first, block.n)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *(pa.array(x, pa.binary()) for x in zip(*rows, strict=True))],
                    ["doc_id", "toxic", "buckets", "lengths"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.join(F.broadcast(known), "doc_id").select("doc_id", F.col("toxic").cast("int"), "text")
    data = rows.mapInArrow(run, "doc_id long, toxic int, buckets binary, lengths binary").toArrow()
    buckets, lengths = ([held for chunk in data.column(c).chunks for held in views(chunk)] for c in ("buckets", "lengths"))
    order = pc.sort_indices(data, [("doc_id", "ascending"), ("buckets", "ascending")]).to_pylist()
    toxic = (data.column("toxic").to_numpy()[order] > 0).astype(float)
    features = common_features([buckets[i] for i in order], [lengths[i] for i in order])
    del data, buckets, lengths  # the driver holds the features once while it fits
    pa.default_memory_pool().release_unused()
    return fit_noisy_or(features, toxic)


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = 0.3, sentence_threshold: float = 0.1) -> DataFrame:
    """Each document's probability of being toxic, and its offending sentences.

    ``spans`` lists the sentences whose own probability reaches
    ``sentence_threshold``: byte bounds in the UTF-8 text, text and score. A
    null, empty or wordless text scores 0 and has no spans. Repeated rows each
    give a row, a null id stays null.
    """
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("sentence", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                s = sentences(block)
                z = model.sentence_logits(s)
                score = -np.expm1(-row_sums(_softplus(z), s.rows))
                spans: list[list[dict]] = [[] for _ in range(block.n)]
                p = _sigmoid(z)
                bad = np.flatnonzero(p >= sentence_threshold)
                owner = np.searchsorted(s.rows, bad, side="right") - 1
                for k, r in zip(bad, owner, strict=True):
                    a, b = int(s.starts[k]), int(s.ends[k])
                    spans[r].append({"start": a - int(block.rows[r]), "end": b - int(block.rows[r]),
                                     "sentence": block.data[a:b].tobytes().decode("utf-8", "replace"), "score": float(p[k])})
                part = batch.slice(block.first, block.n)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.clip(score, 0, 1)), pa.array((score >= threshold).astype(np.int32)),
                     pa.array(spans, pa.list_(span))], ["doc_id", "score", "predicted", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, predicted int, spans array<struct<start: long, end: long, sentence: string, score: double>>")


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3) -> DataFrame:
    """The documents whose score stays under the threshold, with the columns they came with."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(names.index("text")).cast(pa.string())
            score = [-np.expm1(-row_sums(_softplus(model.sentence_logits(s)), s.rows)) for s in map(sentences, blocks(texts))]
            yield batch.filter(pa.array(np.concatenate([np.zeros(0), *score]) < threshold))

    names = docs.columns
    return docs.mapInArrow(run, docs.schema)
