"""Token ids of a corpus as packed binary segments in document order."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlake.llm import packing
from eventlake.llm.text import SPACE, Block, Hasher, blocks
from eventlake.session import shared_dir

SEGMENT_IDS = 1 << 19
# White space beyond ASCII, and the special token: such texts are encoded in one piece.
_WHOLE = re.compile(rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80|<\|endoftext\|>")
_KEPT_PIECES, _KEPT_IDS = 1 << 20, 1 << 23


def _tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceEncoder:
    """A byte-level BPE tokenizer, applied once to each different piece of text.

    A single space between two characters that are no white space always
    starts a new token, so a text may be cut there: the ids of its pieces,
    one after the other, are the ids of the text. Pieces met before are
    looked up by a 64-bit hash; the memory for them is bounded.
    """

    _open: dict[str, PieceEncoder] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.size = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.size[i] = len(token)  # one character for each byte
        self._forget()

    @classmethod
    def opened(cls, path: str) -> PieceEncoder:
        """One encoder for each worker process, kept between tasks."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def _forget(self) -> None:
        self.keys = np.empty(0, np.uint64)
        self.at, self.n = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, np.uint32)

    def _cuts(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        data = block.data
        blank = SPACE[data]
        cut = np.zeros(len(data), bool)
        cut[1:-1] = (data[1:-1] == 32) & ~blank[:-2] & ~blank[2:]
        cut[block.rows[:-1]] = False
        for hit in _WHOLE.finditer(data):
            r = np.searchsorted(block.rows, hit.start(), side="right") - 1
            cut[block.rows[r]:block.rows[r + 1]] = False
        filled = np.diff(block.rows) > 1
        cut[block.rows[:-1][filled]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))
        # The last piece of a row ends before its line feed.
        row = np.searchsorted(block.rows, starts, side="right")
        return starts, np.minimum(ends, block.rows[row] - 1)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        # In small batches, as the library's encodings are many times as large as their ids.
        return [np.array(x.ids, np.uint32) for k in range(0, len(texts), 32)
                for x in self.tokenizer.encode_batch_fast(texts[k:k + 32], add_special_tokens=False)]

    def _encode_pieces(self, pieces: list[bytes], joined: np.ndarray, group: int = 256) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after the other, and how many each has. ``joined`` marks those that may be run together."""
        count = np.zeros(len(pieces), np.int64)
        found: list[tuple[int, np.ndarray]] = []
        alone = np.flatnonzero(~joined)
        for i, ids in zip(alone, self._encode([pieces[i].decode("utf-8", "replace") for i in alone]), strict=True):
            count[i] = len(ids)
            found.append((int(i), ids))
        others = np.flatnonzero(joined)
        groups = [others[i:i + group] for i in range(0, len(others), group)]
        for part, ids in zip(groups, self._encode([b"".join(pieces[i] for i in p).decode() for p in groups]), strict=True):
            ends = np.cumsum([len(pieces[i]) for i in part])
            bounds = np.searchsorted(np.cumsum(self.size[ids]), ends, side="left") + 1
            count[part] = np.diff(bounds, prepend=0)
            found.extend(zip(part.tolist(), np.split(ids, bounds[:-1]), strict=True))
        found.sort(key=lambda x: x[0])
        return np.concatenate([np.empty(0, np.uint32), *(ids for _, ids in found)]), count

    def encode_block(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block's rows, and how many each row has."""
        starts, ends = self._cuts(block)
        hashed, first, inverse = np.unique(Hasher(block.data)(starts, ends), return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, hashed)
        known = (place < len(self.keys)) & (self.keys[np.minimum(place, max(0, len(self.keys) - 1))] == hashed) \
            if len(self.keys) else np.zeros(len(hashed), bool)
        new = np.flatnonzero(~known)
        if len(new):
            raw = block.data.tobytes()
            a, b = starts[first[new]], ends[first[new]]
            pieces = [raw[i:j] for i, j in zip(a, b, strict=True)]
            alone = (block.data[a] != 32) | SPACE[block.data[b - 1]] | (b - a > 64) | np.isin(a, block.rows)
            ids, count = self._encode_pieces(pieces, ~alone)
            if len(self.keys) + len(new) > _KEPT_PIECES or len(self.ids) + len(ids) > _KEPT_IDS:
                old = self._encoded(place[known])
                self._forget()
                self._learn(hashed[known], *old)
            self._learn(hashed[new], ids, count)
            place = np.searchsorted(self.keys, hashed)
        ids, count = self._encoded(place[inverse])
        per_row = np.bincount(np.searchsorted(block.rows, starts, side="right") - 1, count, block.n)
        return ids, per_row.astype(np.int64)

    def _learn(self, keys: np.ndarray, ids: np.ndarray, count: np.ndarray) -> None:
        at = len(self.ids) + np.cumsum(count) - count
        self.ids = np.concatenate([self.ids, ids])
        merged = np.searchsorted(self.keys, keys)
        self.keys, self.at, self.n = (np.insert(x, merged, y) for x, y in ((self.keys, keys), (self.at, at), (self.n, count)))

    def _encoded(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, n = self.at[places], self.n[places]
        inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        return self.ids[np.repeat(at, n) + inner], n


def write_tokens(docs: DataFrame, path: str, tokenizer: str = "byte_bpe_50k.json", end_id: int = 2,
                 segment_ids: int = SEGMENT_IDS, block_bytes: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes every whole text, appends ``end_id`` and writes the ids in ascending order of the document id.

    Rows are dealt out by ranges of the id (null first, repeated ids by a hash
    of the text and then the text) and sorted within. Each partition writes
    segments of whole documents with ``segment_ids`` ids or a little more; a
    segment is a row with its place (``part``, ``seq``), the documents' ids and
    lengths, and the coded values (see ``packing``). A null text is empty. The
    text is shuffled, not its ids, and it is encoded once.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder.opened(_tokenizer_path(tokenizer))
        part, seq = TaskContext.get().partitionId(), 0
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []

        def segment() -> pa.RecordBatch:
            doc_ids = pa.concat_arrays([x[0] for x in held])
            ids, lengths = (np.concatenate([x[k] for x in held]) for k in (1, 2))
            return pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([seq]), pa.array([len(ids)]), pa.array([doc_ids.to_pylist()], pa.list_(pa.int64())),
                 pa.array([lengths.tolist()], pa.list_(pa.int64())), pa.array([packing.encode(ids)], pa.binary())],
                ["part", "seq", "n_ids", "doc_ids", "lengths", "payload"])

        for batch in batches:
            for block in blocks(batch.column(1), block_bytes):
                ids, lengths = encoder.encode_block(block)
                ids = np.insert(ids, np.cumsum(lengths), end_id)
                held.append((batch.column(0).slice(block.first, block.n), ids, lengths + 1))
                if sum(len(x[1]) for x in held) >= segment_ids:
                    yield segment()
                    seq, held = seq + 1, []
        if held:
            yield segment()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text")
    ordered.mapInArrow(run, "part long, seq long, n_ids long, doc_ids array<long>, lengths array<long>, payload binary") \
        .write.option("compression", "uncompressed").parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row for each document of a written corpus: its place, length and checksum, from the decoded segments.

    ``start`` counts the ids before a document: sums over partitions, then over
    a partition's segments, then within the segment.
    """
    segments = spark.read.parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw = packing.decode(row["payload"]).astype("<u4").tobytes()
                ends = np.cumsum(row["lengths"])
                begins = ends - row["lengths"]
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begins, ends, strict=True)]
                n = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * n, pa.int64()), pa.array([row["seq"]] * n, pa.int64()), pa.array(begins),
                     pa.array(row["doc_ids"], pa.int64()), pa.array(row["lengths"], pa.int64()), pa.array(crc, pa.int64())],
                    ["part", "seq", "inner", "doc_id", "n_tokens", "ids_crc32"])

    sizes = segments.select("part", "seq", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("total"))
    parts = parts.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("part_start"))
    seqs = sizes.select("part", "seq", (F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")).alias("seq_start"))
    starts = seqs.join(parts, "part").select("part", "seq", (F.col("seq_start") + F.col("part_start")).alias("segment_start"))
    decoded = segments.select("part", "seq", "doc_ids", "lengths", "payload").mapInArrow(
        run, "part long, seq long, inner long, doc_id long, n_tokens long, ids_crc32 long")
    return decoded.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("segment_start") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def tokenized(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Writes a corpus (to a fresh shared folder unless given one) and reads its documents back."""
    path = path or shared_dir(docs.sparkSession, "tokens")
    write_tokens(docs, path)
    return read_documents(docs.sparkSession, path)
