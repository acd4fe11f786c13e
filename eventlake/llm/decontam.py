"""Benchmark decontamination: passages of documents query a BM25 index of test items, with block-max pruning.

The index is the small side: items are cut into parts of ``PART`` words, each
term has a posting list with its BM25 impact on a part, divided by the part's
score for itself, so a passage that holds a whole part scores 1. Parts form
blocks of ``BLOCK``; a list keeps its maximum and its maximum within each block. For
all passages of many texts at once, the WAND test goes from coarse to fine: the sum of a
passage's list maxima, then of its maxima in each block, must reach the
threshold before the parts of that block are scored. Nothing that
reaches the threshold is missed. What is retrieved is verified by word overlap.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.tables import stored
from eventlake.llm.text import LOWER, Block, Hasher, Words, blocks, shingles, words

PART = 64              # words; a passage has twice as many and starts every PART words
BLOCK = 16
K1, B = 1.2, 0.75
GRAM = 3
GROUP_BYTES = 8 << 20  # of item text in one index, which is sent to every executor
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_ENDS = np.isin(np.arange(256), list(b".!?\n"))


def _terms(block: Block) -> tuple[Words, np.ndarray]:
    """Words are runs of letters, digits and non-ASCII bytes, in lower case."""
    lowered = block._replace(data=LOWER[block.data])
    found = words(lowered, _IN_WORD)
    return found, Hasher(lowered.data)(found.starts, found.ends)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Item parts as term hashes, and where the answer begins: the last sentence, else the last quarter of the words."""
    for batch in batches:
        for block in blocks(batch.column(1)):
            found, hashes = _terms(block)
            ends = np.concatenate([[0], np.cumsum(_ENDS[block.data])])
            out = []
            for r in range(block.n):
                a, b = int(found.bounds[r]), int(found.bounds[r + 1])
                for low in range(a, b, PART):
                    high = min(b, low + PART)
                    breaks = low + 1 + np.flatnonzero(ends[found.starts[low + 1:high]] > ends[found.ends[low:high - 1]])
                    answer = int(breaks[-1]) if len(breaks) else high - max(1, (high - low) // 4)
                    out.append((batch.column(0)[block.first + r].as_py(), hashes[low:high].tobytes(), answer - low))
            columns = list(zip(*out, strict=True)) if out else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, (pa.int64(), pa.binary(), pa.int32()), strict=True)],
                                             ["item_id", "terms", "answer"])


@dataclass(frozen=True)
class Index:
    item: list            # each part's item id
    grams: list[tuple[np.ndarray, np.ndarray]]  # n-gram hashes of each part's question and answer
    vocabulary: np.ndarray  # sorted term hashes
    list_max: np.ndarray
    block_first: np.ndarray  # each term's first entry in block_of, block_max
    block_of: np.ndarray
    block_max: np.ndarray
    posting_first: np.ndarray  # each (term, block) entry's first posting
    part: np.ndarray
    impact: np.ndarray

    @property
    def n_blocks(self) -> int:
        return -(-len(self.item) // BLOCK)


def _grams(hashes: np.ndarray) -> np.ndarray:
    size = min(GRAM, len(hashes))
    return np.unique(shingles(hashes, np.array([0, len(hashes)]), size)[0]) if size else np.empty(0, np.uint64)


def build_index(parts: list[tuple], frequency: dict[int, int], n_parts: int, mean_words: float) -> Index:
    """``parts``: (item id, term hashes, answer) in the order of the index; ``frequency``: parts that hold a term, of ``n_parts``."""
    term, part, impact, grams = [], [], [], []
    for k, (_, hashes, answer) in enumerate(parts):
        keys, tf = np.unique(hashes, return_counts=True)
        df = np.array([frequency[int(x)] for x in keys.view(np.int64)], float)
        idf = np.log1p((n_parts - df + 0.5) / (df + 0.5))
        score = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(hashes) / mean_words))
        term.append(keys)
        part.append(np.full(len(keys), k))
        impact.append(score / score.sum())
        grams.append((_grams(hashes[:answer]), _grams(hashes[answer:])))
    empty = np.empty(0)
    term, part, impact = (np.concatenate(x) if x else empty.astype(t) for x, t in ((term, np.uint64), (part, int), (impact, float)))
    order = np.lexsort((part, term))
    term, part, impact = term[order], part[order], impact[order]
    vocabulary, at = np.unique(term, return_inverse=True)
    entry_key, posting_first = np.unique(at * (len(parts) + 1) + part // BLOCK, return_index=True)
    entry_term, block_of = np.divmod(entry_key, len(parts) + 1)
    block_max = np.maximum.reduceat(impact, posting_first) if len(impact) else empty
    block_first = np.searchsorted(entry_term, np.arange(len(vocabulary) + 1))
    list_max = np.maximum.reduceat(block_max, block_first[:-1]) if len(impact) else empty
    return Index([x[0] for x in parts], grams, vocabulary, list_max, block_first, block_of, block_max,
                 np.append(posting_first, len(part)), part, impact)


def _spread(first: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All entries of the given rows of a table of ranges: which of ``rows``, and the entry."""
    n = first[rows + 1] - first[rows]
    which = np.repeat(np.arange(len(rows)), n)
    return which, first[rows][which] + np.arange(len(which)) - (np.cumsum(n) - n)[which]


def retrieve(index: Index, passage: np.ndarray, term: np.ndarray, n_passages: int, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passages, parts and scores with a score of ``threshold`` or more; (passage, term) pairs are distinct."""
    none = np.empty(0, int), np.empty(0, int), np.empty(0)
    near = threshold * (1 - 1e-9)
    bound = np.bincount(passage, index.list_max[term], n_passages)
    live = bound[passage] >= near
    passage, term = passage[live], term[live]
    if not len(passage):
        return none
    shown, passage = np.unique(passage, return_inverse=True)
    which, entry = _spread(index.block_first, term)
    cell = passage[which] * index.n_blocks + index.block_of[entry]
    bound = np.bincount(cell, index.block_max[entry], len(shown) * index.n_blocks)
    live = bound[cell] >= near
    which, entry, cell = which[live], entry[live], cell[live]
    if not len(entry):
        return none
    again, posting = _spread(index.posting_first, entry)
    key, at = np.unique(passage[which][again] * len(index.item) + index.part[posting], return_inverse=True)
    score = np.bincount(at, index.impact[posting])
    hit = score >= near
    found, part = np.divmod(key[hit], len(index.item))
    return shown[found], part, score[hit]


def block_leaks(block: Block, index: Index, threshold: float, overlap: float) -> list[tuple]:
    """(row, part, score, question overlap, answer overlap, byte start, byte end), the best passage for each row and part."""
    found, hashes = _terms(block)
    if not len(index.vocabulary):
        return []
    place = np.minimum(np.searchsorted(index.vocabulary, hashes), len(index.vocabulary) - 1)
    known = np.flatnonzero(index.vocabulary[place] == hashes)
    row = found.row[known]
    # Passages are numbered through the block; word k of a row is in passages k // PART and the one before.
    per_row = -(-np.diff(found.bounds) // PART)
    first = np.concatenate([[0], np.cumsum(per_row)])
    own = first[row] + (known - found.bounds[row]) // PART
    before = own > first[row]
    pair = np.unique(np.concatenate([own * len(index.vocabulary) + place[known], (own[before] - 1) * len(index.vocabulary) + place[known][before]]))
    passage, term = np.divmod(pair, len(index.vocabulary))
    best: dict[tuple[int, int], tuple] = {}
    for p, k, score in zip(*retrieve(index, passage, term, int(first[-1]), threshold), strict=True):
        r = int(np.searchsorted(first, p, side="right")) - 1
        low = int(found.bounds[r] + (p - first[r]) * PART)
        high = min(low + 2 * PART, int(found.bounds[r + 1]))
        grams = np.concatenate([shingles(hashes[low:high], np.array([0, high - low]), n)[0] for n in range(1, GRAM + 1)])
        question, answer = (float(np.isin(g, grams).mean()) if len(g) else 1.0 for g in index.grams[k])
        if question >= overlap and answer >= overlap and ((r, k) not in best or best[r, k][2] < score):
            best[r, k] = (r, int(k), float(score), question, answer, int(found.starts[low] - block.rows[r]), int(found.ends[high - 1] - block.rows[r]))
    return list(best.values())


def indexes(items: DataFrame, id_col: str = "item_id", text_col: str = "text", least_words: int = 5,
            group_bytes: int = GROUP_BYTES) -> Iterator[Index]:
    """Indexes that together hold all items, each of about ``group_bytes`` of item text at most.

    Term frequencies and the mean length are those of all items, so results
    don't depend on the grouping. Parts of under ``least_words`` words are too
    short to be evidence and left out.
    """
    text = F.col(text_col).cast("string")
    size = items.agg(F.sum(F.octet_length(text))).first()[0] or 0
    rows = items.select(F.col(id_col).cast("long").alias("item_id"), text.alias("text"))
    parts = rows.mapInArrow(_parts, "item_id long, terms binary, answer int").where(F.octet_length("terms") >= 8 * least_words)
    parts = stored(parts, "item-parts")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [np.unique(np.frombuffer(x, np.int64)) for x in batch.column(1).to_pylist()]
            at = np.repeat(np.arange(len(hashes)), [len(x) for x in hashes])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(np.concatenate([np.empty(0, np.int64), *hashes]))], ["group", "term"])

    total = parts.agg(F.count("*").alias("n"), F.avg(F.octet_length("terms") / 8).alias("mean")).first()
    groups = max(1, -(-size // group_bytes))
    grouped = parts.withColumn("group", F.pmod(F.xxhash64("terms"), F.lit(groups)))
    held = grouped.select("group", "terms").mapInArrow(split, "group long, term long")
    frequency = stored(held.groupBy("term").agg(F.count("*").alias("n")).join(held.distinct(), "term"), "item-terms")
    for g in range(groups):
        mine = grouped.where(F.col("group") == g).select("item_id", "terms", "answer").toArrow().sort_by(
            [("item_id", "ascending"), ("terms", "ascending")]).to_pylist()
        known = {r["term"]: r["n"] for r in frequency.where(F.col("group") == g).select("term", "n").toLocalIterator()}
        yield build_index([(r["item_id"], np.frombuffer(r["terms"], np.uint64), r["answer"]) for r in mine], known, total["n"], total["mean"] or 1.0)


def find_leaks(docs: DataFrame, items: DataFrame, threshold: float = 0.5, overlap: float = 0.5,
               id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Documents that hold a benchmark item: one row for each pair, with the best passage.

    ``score`` is the BM25 score of the passage relative to the item's own,
    ``question_overlap`` and ``answer_overlap`` are the shares of the three-word runs
    of either that stand in the passage; all must reach their thresholds.
    ``start`` and ``end`` are byte bounds of the passage in the UTF-8 text.
    Null and empty texts hold nothing; repeated documents and items each give
    their rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, start long, end long"

    def finder(index: Index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block in blocks(batch.column(1)):
                    found = block_leaks(block, index, threshold, overlap)
                    if found:
                        row, part, *rest = zip(*found, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(pa.array([block.first + r for r in row])), pa.array([index.item[k] for k in part], pa.int64()),
                             *map(pa.array, rest)], [x.split()[0] for x in schema.split(", ")])
        return run

    out = None
    for index in indexes(items, **options):
        found = rows.mapInArrow(finder(index), schema)
        out = found if out is None else out.union(found)
    return out


def drop_leaks(docs: DataFrame, items: DataFrame, threshold: float = 0.5, overlap: float = 0.5, text_col: str = "text", **options) -> DataFrame:
    """The documents that hold no benchmark item, with the columns they came with."""
    at = docs.columns.index(text_col)

    def keeper(index: Index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for block in blocks(batch.column(at).cast(pa.string())):
                    for r, *_ in block_leaks(block, index, threshold, overlap):
                        clean[block.first + r] = False
                yield batch.filter(pa.array(clean))
        return run

    for index in indexes(items, **options):
        docs = docs.mapInArrow(keeper(index), docs.schema)
    return docs
