"""Quality rules: gradient-boosted trees over document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.tables import sampled
from eventlake.llm.text import CONTINUES, SPACE, Block, Hasher, blocks, row_sums, runs, shingles, words

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_chars_all",
          "n_letters", "n_digits", "n_stops", "n_upper", "n_distinct")
FEATURES = ("log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "words_per_line",
            "letter_share", "digit_share", "stop_share", "upper_share", "distinct_share")
# Fixed direction of a feature's effect: +1 may only raise the score, -1 only lower it.
MONOTONE = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1}


def _marked(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_SYMBOLS = _marked(b"#*$%&|<>")
_DIGITS = _marked(b"0123456789")
_UPPER = _marked(bytes(range(65, 91)))
_LETTERS = _marked(bytes([*range(65, 91), *range(97, 123), *range(0xC2, 0xF5)]))
_STOPS = _marked(b".,;:!?")


def block_counts(block: Block) -> np.ndarray:
    """``COUNTS`` of each row of a block, over its whole text."""
    data, rows = block.data, block.rows
    found = words(block)
    hashes = Hasher(data)
    out = np.zeros((block.n, len(COUNTS)), np.int64)

    def per_row(table: np.ndarray) -> np.ndarray:
        return row_sums(table[data], rows)

    n_words = np.diff(found.bounds)
    points = per_row(~CONTINUES) - 1  # without the line feed that ends a row
    out[:, 0] = n_words
    out[:, 1] = points + 1 - per_row(SPACE)
    out[:, 2] = per_row(_SYMBOLS)
    out[:, 6] = points
    out[:, 7], out[:, 8] = per_row(_LETTERS), per_row(_DIGITS)
    out[:, 9], out[:, 10] = per_row(_STOPS), per_row(_UPPER)

    line_starts, line_ends = runs(data != 10)
    has_word = np.searchsorted(found.starts, line_ends) > np.searchsorted(found.starts, line_starts)
    line_starts, line_ends = line_starts[has_word], line_ends[has_word]
    line_row = np.searchsorted(rows, line_starts, side="right") - 1
    out[:, 5] = np.bincount(line_row, minlength=block.n)
    out[:, 3] = out[:, 5] - _distinct_per_row(hashes(line_starts, line_ends), line_row, block.n)

    by_word = hashes(found.starts, found.ends)
    out[:, 11] = _distinct_per_row(by_word, found.row, block.n)
    keys, at = shingles(by_word, found.bounds, 3)
    owner = found.row[at]
    order = np.lexsort((keys, owner))
    same = (keys[order][1:] == keys[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    again = np.zeros(len(keys), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    covered = np.zeros(len(found.starts) + 3, bool)
    for k in range(3):
        covered[at[again] + k] = True
    out[:, 4] = row_sums(covered[:len(found.starts)], found.bounds)
    return out


def _distinct_per_row(keys: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    return np.bincount(owner[new], minlength=n)


def features(counts: np.ndarray) -> np.ndarray:
    """``FEATURES`` from ``COUNTS``."""
    c = dict(zip(COUNTS, counts.T.astype(np.float64), strict=True))
    n_words, chars = np.maximum(c["n_words"], 1), np.maximum(c["n_chars_all"], 1)
    lines = np.maximum(c["n_lines"], 1)
    return np.stack([
        np.log1p(c["n_words"]), c["word_chars"] / n_words, c["n_symbols"] / n_words, c["n_dup_lines"] / lines,
        c["n_repeat_words"] / n_words, n_words / lines, c["n_letters"] / chars, c["n_digits"] / chars,
        c["n_stops"] / n_words, c["n_upper"] / chars, c["n_distinct"] / n_words], axis=1)


@dataclass(frozen=True)
class Trees:
    """Complete binary trees, flattened: node k of a tree has its children at 2k+1 and 2k+2."""

    feature: np.ndarray    # trees x inner nodes
    threshold: np.ndarray  # a value above goes right; infinite where a node isn't split
    leaf: np.ndarray       # trees x leaves
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of the label for each row of features."""
        depth = int(np.log2(self.leaf.shape[1]))
        total, every = np.full(len(x), self.base), np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[every, feature[node]] > threshold[node])
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray, n_trees: int = 60, depth: int = 4, rate: float = 0.15,
              bins: int = 64, least: float = 5.0, ridge: float = 1.0, monotone: dict[str, int] | None = None) -> Trees:
    """Newton boosting of the logistic loss on binned features.

    A split on a constrained feature that would order its sides against the
    constraint is refused, and the midpoint of an accepted one bounds all leaves
    below either side, so the whole tree is monotone in that feature.
    """
    signs = [(MONOTONE if monotone is None else monotone).get(f, 0) for f in FEATURES]
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.empty(0) for j in range(m)]
    codes = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(m)], axis=1) if n else x.astype(int)
    share = np.clip(y.mean() if n else 1.0, 1e-4, 1 - 1e-4)
    base = float(np.log(share / (1 - share)))
    inner = (1 << depth) - 1
    feature = np.zeros((n_trees, inner), np.int64)
    threshold = np.full((n_trees, inner), np.inf)
    leaf = np.zeros((n_trees, inner + 1))
    margin = np.full(n, base)
    flat = codes + np.arange(m) * bins
    for t in range(n_trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        at = np.zeros(n, np.int64)
        low, high = np.full(2 * inner + 1, -np.inf), np.full(2 * inner + 1, np.inf)
        for k in range(2 * inner + 1):
            mine = np.flatnonzero(at == k)
            if k >= inner:
                value = -grad[mine].sum() / (hess[mine].sum() + ridge)
                leaf[t, k - inner] = rate * np.clip(value, low[k], high[k])
                margin[mine] += leaf[t, k - inner]
                continue
            g = np.bincount(flat[mine].ravel(), np.repeat(grad[mine], m), m * bins).reshape(m, bins)
            h = np.bincount(flat[mine].ravel(), np.repeat(hess[mine], m), m * bins).reshape(m, bins)
            gl, hl = np.cumsum(g, 1)[:, :-1], np.cumsum(h, 1)[:, :-1]
            gr, hr = g.sum(1, keepdims=True) - gl, h.sum(1, keepdims=True) - hl
            wl = np.clip(-gl / (hl + ridge), low[k], high[k])
            wr = np.clip(-gr / (hr + ridge), low[k], high[k])
            gain = -(gl * wl + 0.5 * (hl + ridge) * wl**2 + gr * wr + 0.5 * (hr + ridge) * wr**2)
            whole = np.clip(-g[0].sum() / (h[0].sum() + ridge), low[k], high[k])
            gain += g[0].sum() * whole + 0.5 * (h[0].sum() + ridge) * whole**2
            gain[(hl < least * 0.05) | (hr < least * 0.05)] = -np.inf
            for j, sign in enumerate(signs):
                gain[j, len(edges[j]):] = -np.inf
                if sign:
                    gain[j, sign * (wr[j] - wl[j]) < 0] = -np.inf
            low[[2 * k + 1, 2 * k + 2]], high[[2 * k + 1, 2 * k + 2]] = low[k], high[k]
            j, b = divmod(int(gain.argmax()), bins - 1)
            if not gain[j, b] > 1e-9:
                at[mine] = 2 * k + 1
                continue
            feature[t, k], threshold[t, k] = j, edges[j][b]
            at[mine] = 2 * k + 1 + (codes[mine, j] > b)
            if signs[j]:
                mid = (wl[j, b] + wr[j, b]) / 2
                left, right = 2 * k + 1, 2 * k + 2
                if signs[j] > 0:
                    high[left], low[right] = mid, mid
                else:
                    low[left], high[right] = mid, mid
    return Trees(feature, threshold, leaf, base)


_COUNT_SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)


def _batch_counts(texts: pa.Array) -> np.ndarray:
    return np.concatenate([np.zeros((0, len(COUNTS)), np.int64), *map(block_counts, blocks(texts))])


def _id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def document_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``COUNTS`` of each row's whole text. A null or empty text has zeros; a null id stays null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, _batch_counts(batch.column(1)).T)], ["doc_id", *COUNTS])

    return _id_and_text(docs, id_col, text_col).mapInArrow(run, _COUNT_SCHEMA)


def train_quality(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> Trees:
    """Trees fitted to ``labels.quality`` of about ``max_rows`` labelled rows at most.

    Rows whose label or id is null are left out, an id labelled twice counts
    twice. Without labelled rows every text passes.
    """
    known = sampled(labels.where("doc_id is not null and quality is not null").select("doc_id", "quality"), "doc_id", max_rows)
    rows = document_counts(docs.join(F.broadcast(known.select("doc_id").distinct()), "doc_id", "left_semi"))
    data = rows.join(F.broadcast(known), "doc_id").orderBy("doc_id", *COUNTS).toArrow()
    counts = np.stack([data.column(c).to_numpy() for c in COUNTS], axis=1) if data.num_rows else np.zeros((0, len(COUNTS)))
    return fit_trees(features(counts), (data.column("quality").to_numpy() > 0).astype(float))


def quality_rules(docs: DataFrame, model: Trees, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = 0.5, least_words: int = 50, most_repeated: int = 50) -> DataFrame:
    """Counts, base rules and the trees' verdict for each document.

    ``base_failed``: fewer than ``least_words`` words, or more than
    ``most_repeated`` percent of them in repeated three-word windows. ``kept``
    is false for those, else whether ``score`` reaches ``threshold``. A null
    or empty text fails the base rules. Repeated rows each give a row, a null
    id stays null.
    """
    shown = COUNTS[:5]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = _batch_counts(batch.column(1))
            score = model.score(features(counts))
            n, repeated = counts[:, 0], counts[:, COUNTS.index("n_repeat_words")]
            failed = (n < least_words) | (100 * repeated > most_repeated * n)
            out = [batch.column(0), *map(pa.array, (*counts.T[:len(shown)], score, failed, ~failed & (score >= threshold)))]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", *shown, "score", "base_failed", "kept"])

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in shown) + ", score double, base_failed boolean, kept boolean"
    return _id_and_text(docs, id_col, text_col).mapInArrow(run, schema)
