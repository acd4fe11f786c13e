"""Language of a text by a byte convolutional network, trained and applied in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.text import Block, blocks

WINDOW = 256
WIDTHS = (2, 3, 4)
HALO = max(WIDTHS) - 1
LEAST_DOCS = 16  # of a language
UNKNOWN = "und"


@dataclass
class ByteNet:
    """Byte embedding, filters of several widths, maximum over a window, softmax."""

    embed: np.ndarray    # 256 x E
    filters: np.ndarray  # (widest * E) x filters, zero beyond a filter's width
    shift: np.ndarray
    out: np.ndarray      # filters x languages
    out_shift: np.ndarray
    languages: list[str]

    def log_probabilities(self, windows: np.ndarray, batch: int = 64) -> np.ndarray:
        """Of each window of WINDOW + HALO bytes."""
        parts = [np.zeros((0, len(self.languages)), np.float32)]
        for i in range(0, len(windows), batch):
            peak, _ = self._peaks(windows[i:i + batch])
            logits = np.maximum(peak + self.shift, 0) @ self.out + self.out_shift
            logits -= logits.max(1, keepdims=True)
            parts.append(logits - np.log(np.exp(logits).sum(1, keepdims=True)))
        return np.concatenate(parts)

    def _peaks(self, windows: np.ndarray, where: bool = False):
        x = self.embed[windows]
        n, size = len(windows), x.shape[2]
        cols = np.lib.stride_tricks.as_strided(
            x, (n, WINDOW, (HALO + 1) * size), (x.strides[0], x.strides[1], x.strides[2])).reshape(n * WINDOW, -1)
        hit = (cols @ self.filters).reshape(n, WINDOW, -1)
        if not where:
            return hit.max(1), None
        at = hit.argmax(1)
        return np.take_along_axis(hit, at[:, None], 1)[:, 0], (at, cols.reshape(n, WINDOW, -1))


def windows(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All of a block's windows, each one's row and its bytes within the row; zeros beyond a text's end."""
    size = np.diff(block.rows) - 1
    count = -(-size // WINDOW)
    row = np.repeat(np.arange(block.n), count)
    offset = (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * WINDOW
    start = block.rows[row] + offset
    left = size[row] - offset
    padded = np.concatenate([block.data, np.zeros(WINDOW + HALO, np.uint8)])
    cut = np.lib.stride_tricks.sliding_window_view(padded, WINDOW + HALO)[start]
    short = np.flatnonzero(left < WINDOW + HALO)
    cut = np.ascontiguousarray(cut)
    cut[short] *= np.arange(WINDOW + HALO) < left[short, None]
    return cut, row, np.minimum(left, WINDOW)


def fit_bytes(x: np.ndarray, y: np.ndarray, languages: list[str], embed: int = 8, per_width: int = 10,
              epochs: int = 6, batch: int = 64, rate: float = 0.01, seed: int = 5) -> ByteNet:
    """Adam on the cross entropy; through the maximum, gradients reach each filter's best position only."""
    rng = np.random.default_rng(seed)
    f = per_width * len(WIDTHS)
    wide = np.repeat(WIDTHS, per_width)
    used = (np.arange((HALO + 1) * embed)[:, None] < wide * embed).astype(np.float32)
    net = ByteNet(rng.normal(0, 0.5, (256, embed)).astype(np.float32),
                  (rng.normal(0, 0.3, used.shape) * used).astype(np.float32), np.zeros(f, np.float32),
                  rng.normal(0, 0.1, (f, max(1, len(languages)))).astype(np.float32),
                  np.zeros(max(1, len(languages)), np.float32), languages)
    if len(languages) < 2:
        return net
    params = [net.embed, net.filters, net.shift, net.out, net.out_shift]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), batch):
            xb, yb = x[order[i:i + batch]], y[order[i:i + batch]]
            n = len(xb)
            peak, (at, cols) = net._peaks(xb, where=True)
            hidden = np.maximum(peak + net.shift, 0)
            logits = hidden @ net.out + net.out_shift
            prob = np.exp(logits - logits.max(1, keepdims=True))
            prob /= prob.sum(1, keepdims=True)
            prob[np.arange(n), yb] -= 1
            prob /= n
            back = (prob @ net.out.T) * (hidden > 0)
            picked = cols[np.arange(n)[:, None], at]           # n x f x widest*E
            d_filters = np.einsum("nf,nfk->kf", back, picked) * used
            d_cols = (back[:, :, None] * net.filters.T[None]).reshape(n, f, HALO + 1, embed)
            touched = xb[np.arange(n)[:, None, None], at[:, :, None] + np.arange(HALO + 1)]
            d_embed = np.zeros_like(net.embed)
            np.add.at(d_embed, touched.ravel(), d_cols.reshape(-1, embed))
            grads = [d_embed, d_filters, back.sum(0), hidden.T @ prob, prob.sum(0)]
            step += 1
            for p, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def train_language(rows: DataFrame, max_docs: int = 4000, windows_per_doc: int = 4, seed: int = 5) -> ByteNet:
    """A network for the values of ``lang``, from columns ``doc_id text lang``.

    Fits about ``max_docs`` documents, shared evenly by the languages
    and chosen by a hash of the id, ``windows_per_doc`` windows spread over
    each. Every value is learned, from about ``LEAST_DOCS`` documents at least if
    it has them, so many languages take more than ``max_docs``. Rows with a
    null text or language teach nothing; without any, every text is ``und``.
    """
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null")
    rows = rows.where(F.col("text").rlike(r"\p{L}"))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).collect()
    languages = sorted(r["lang"] for r in counts)
    if not languages:
        return fit_bytes(np.zeros((0, WINDOW + HALO), np.uint8), np.zeros(0, int), [])
    spark, share = rows.sparkSession, max(LEAST_DOCS, max_docs / len(languages))
    rates = spark.createDataFrame([(r["lang"], int((1 << 32) * min(1.0, share / r["n"]))) for r in counts],
                                  "lang string, rate long")
    chosen = rows.join(F.broadcast(rates), "lang").where(
        F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 32)) <= F.col("rate")).select("doc_id", "lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(2)):
                cut, row, _ = windows(block)
                rank = np.arange(len(row)) - np.searchsorted(row, row)
                total = np.bincount(row, minlength=block.n)[row]
                # The k-th of n windows starts a new one of windows_per_doc equal shares.
                take = np.flatnonzero((rank * windows_per_doc) % np.maximum(total, windows_per_doc) < windows_per_doc)
                part = batch.take(pa.array(block.first + row[take]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([x.tobytes() for x in cut[take]], pa.binary())],
                    ["doc_id", "lang", "window"])

    data = chosen.mapInArrow(run, "doc_id long, lang string, window binary").toArrow().sort_by(
        [("doc_id", "ascending"), ("window", "ascending")])
    x = np.frombuffer(b"".join(data.column("window").to_pylist()), np.uint8).reshape(-1, WINDOW + HALO)
    y = np.searchsorted(languages, data.column("lang").to_numpy(zero_copy_only=False).astype(str))
    return fit_bytes(x, y, languages, seed=seed)


def identify_language(docs: DataFrame, net: ByteNet, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Language and probability for each document, from all windows of its whole text.

    A document's log-probabilities are its windows' mean, each counted by its
    bytes. Null texts and texts without a letter are ``und`` with score 0, as
    is everything when the network knows no language. Repeated rows each give
    a row, a null id stays null.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*net.languages, UNKNOWN], dtype=object)
        for batch in batches:
            best, score = [np.zeros(0, int)], [np.zeros(0)]
            for block in blocks(batch.column(1)):
                cut, row, weight = windows(block)
                total = np.zeros((block.n, len(net.languages) or 1))
                if net.languages:
                    np.add.at(total, row, net.log_probabilities(cut) * weight[:, None])
                mean = total / np.maximum(np.bincount(row, weight, block.n), 1)[:, None]
                prob = np.exp(mean - mean.max(1, keepdims=True))
                prob /= prob.sum(1, keepdims=True)
                best.append(prob.argmax(1))
                score.append(prob.max(1))
            lettered = batch.column(2).to_numpy(zero_copy_only=False).astype(bool) & bool(net.languages)
            best, score = np.concatenate(best), np.concatenate(score)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names[np.where(lettered, best, len(net.languages))], pa.string()),
                 pa.array(np.where(lettered, np.clip(score, 0, 1), 0.0))], ["doc_id", "lang_pred", "score"])

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                       F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")
