"""Encoding and decoding with SentencePiece vocabularies of the merge type (BPE with byte fallback)."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.text import Block, Hasher, blocks
from eventlake.llm.tokens import _tokenizer_path

_SPACE = "▁"  # the mark that stands for a space inside pieces
_LOST = "�".encode()  # what a byte that is no text decodes to
_KEPT_CHUNKS, _KEPT_IDS = 1 << 21, 1 << 24


class Table:
    """Byte strings by id, laid end to end, to spell many ids at once."""

    def __init__(self, values: list[bytes]):
        self.data = np.frombuffer(b"".join(values), np.uint8)
        self.n = np.array([len(v) for v in values], np.int64)
        self.at = np.cumsum(self.n) - self.n

    def spell(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All bytes of the ids, and how many each has."""
        n = self.n[ids]
        return self.data[np.repeat(self.at[ids] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))], n


class PieceModel:
    """A merge-type vocabulary. Pieces are merged here; the library only opens the file and checks the result."""

    _open: dict[str, PieceModel] = {}

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = sp = SentencePieceProcessor(model_file=path)
        size = sp.vocab_size()
        if sp.normalize(" a  \tb") != f"{_SPACE * 2}a{_SPACE * 2}\tb" or any(map(sp.is_unused, range(size))):
            raise ValueError(f"{path}: only vocabularies without unused pieces that keep all white space and put one before a text are read")
        self.special = np.array([sp.is_control(i) for i in range(size)])
        self.byte = np.array([sp.is_byte(i) for i in range(size)])
        self.unknown = sp.unk_id()
        pieces = [sp.id_to_piece(i) for i in range(size)]
        merged = [i for i in range(size) if not self.special[i] and not self.byte[i] and i != self.unknown]
        self.ids = {pieces[i]: i for i in merged}
        self.cost = {pieces[i]: -sp.get_score(i) for i in merged}
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        # A text may be cut before a space that follows something else, unless a piece reaches across.
        self.cut = not any(_SPACE in p.lstrip(_SPACE) for p in self.ids)
        spelled = [b"" if self.special[i] else bytes([int(p[3:5], 16)]) if self.byte[i] else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)]
        spelled[self.unknown] = sp.decode([self.unknown]).encode()
        self.surface = Table(spelled)
        self.spaced = np.array([p.startswith(_SPACE) for p in pieces])
        self._forget()

    @classmethod
    def opened(cls, path: str) -> PieceModel:
        """One model for each worker process, kept between tasks."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def _forget(self) -> None:
        self.keys = np.empty(0, np.uint64)
        self.at, self.n = np.empty(0, np.int64), np.empty(0, np.int64)
        self.known = np.empty(0, np.int32)

    def merge(self, text: str) -> list[int]:
        """Ids of a text whose spaces are marks: merges the adjacent pair with the best score, the leftmost of equals, until none is left.

        The agenda is a heap of pairs by cost and place. A pair is out of date
        if one of its symbols has been merged away, or has grown meanwhile.
        """
        cost = self.cost
        symbols: list[str] = list(text)
        last = len(symbols) - 1
        before, after = list(range(-1, last)), list(range(1, last + 2))
        agenda = []
        for i in range(last):
            c = cost.get(symbols[i] + symbols[i + 1])
            if c is not None:
                agenda.append((c, i, i + 1, len(symbols[i]) + len(symbols[i + 1])))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, size = heapq.heappop(agenda)
            a, b = symbols[left], symbols[right]
            if not a or not b or len(a) + len(b) != size:
                continue
            symbols[left], symbols[right] = whole, _ = a + b, ""
            follower = after[left] = after[right]
            if follower <= last:
                before[follower] = left
                c = cost.get(whole + symbols[follower])
                if c is not None:
                    heapq.heappush(agenda, (c, left, follower, size + len(symbols[follower])))
            leader = before[left]
            if leader >= 0:
                c = cost.get(symbols[leader] + whole)
                if c is not None:
                    heapq.heappush(agenda, (c, leader, left, len(symbols[leader]) + size))
        out: list[int] = []
        for s in symbols:
            if s:
                found = self.ids.get(s)
                if found is None:
                    out.extend(self.byte_ids[b] for b in s.encode())
                else:
                    out.append(found)
        return out

    def _new(self, chunks: list[str], check: bool) -> list[list[int]]:
        found = [self.merge(c.replace(" ", _SPACE)) for c in chunks]
        if check:  # the library puts a space before a text itself
            for chunk, own, other in zip(chunks, found, self.library.encode([c[1:] for c in chunks], num_threads=1), strict=True):
                if own != other and len(chunk) > 1:
                    raise ValueError(f"{chunk[:80]!r}: merged to {own[:40]}, the library has {other[:40]}")
        return found

    def encode_block(self, block: Block, check: bool) -> tuple[np.ndarray, np.ndarray]:
        """All ids of rows that begin with their space, and how many each row has; chunks met before are looked up by a 64-bit hash."""
        data = block.data
        start = np.zeros(len(data), bool)
        if self.cut:
            start[1:] = (data[1:] == 32) & (data[:-1] != 32)
        start[block.rows[:-1][np.diff(block.rows) > 1]] = True
        starts = np.flatnonzero(start)
        row = np.searchsorted(block.rows, starts, side="right") - 1
        ends = np.minimum(np.append(starts[1:], len(data)), block.rows[row + 1] - 1)
        hashed, first, inverse = np.unique(Hasher(data)(starts, ends), return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, hashed)
        old = np.zeros(len(hashed), bool)
        if len(self.keys):
            old = self.keys[np.minimum(place, len(self.keys) - 1)] == hashed
        new = np.flatnonzero(~old)
        if len(new):
            raw = data.tobytes()
            chunks = [raw[i:j].decode("utf-8", "replace") for i, j in zip(starts[first[new]], ends[first[new]], strict=True)]
            merged = self._new(chunks, check)
            n = np.array([len(x) for x in merged], np.int64)
            ids = np.array([i for x in merged for i in x], np.int32)
            if len(self.keys) + len(new) > _KEPT_CHUNKS or len(self.known) + len(ids) > _KEPT_IDS:
                kept = self._looked_up(place[old])
                self._forget()
                self._learn(hashed[old], *kept)
            self._learn(hashed[new], ids, n)
            place = np.searchsorted(self.keys, hashed)
        ids, n = self._looked_up(place[inverse])
        return ids, np.bincount(row, n, block.n).astype(np.int64)

    def _learn(self, keys: np.ndarray, ids: np.ndarray, n: np.ndarray) -> None:
        at = len(self.known) + np.cumsum(n) - n
        self.known = np.concatenate([self.known, ids])
        into = np.searchsorted(self.keys, keys)
        self.keys, self.at, self.n = (np.insert(x, into, y) for x, y in ((self.keys, keys), (self.at, at), (self.n, n)))

    def _looked_up(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = self.n[places]
        return self.known[np.repeat(self.at[places] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))], n

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 of rows of ids, end to end, and how many bytes each row has.

        Control ids are silent, the space put before a text is taken off, and
        each byte that is part of no character becomes U+FFFD.
        """
        data, n = self.surface.spell(ids)
        ends = np.cumsum(lengths)
        row = np.repeat(np.arange(len(lengths)), lengths)
        loud = np.flatnonzero(~self.special[ids])
        heads = loud[np.unique(row[loud], return_index=True)[1]]
        heads = heads[self.spaced[ids[heads]] & ~self.byte[ids[heads]]]
        begins = np.cumsum(n) - n
        kept = np.ones(len(data), bool)
        kept[begins[heads]] = False
        n[heads] -= 1
        data = data[kept]
        sizes = np.bincount(row, n, len(lengths)).astype(np.int64)
        if not self.byte[ids].any() or _is_text(data):
            return data, sizes
        out = []
        for a, b, x, y in zip(ends - lengths, ends, np.cumsum(sizes) - sizes, np.cumsum(sizes), strict=True):
            own = data[x:y].tobytes()
            out.append(own if _is_text(own) else self._mended(ids[a:b], n[a:b], own))
        return np.frombuffer(b"".join(out), np.uint8), np.array([len(x) for x in out], np.int64)

    def _mended(self, ids: np.ndarray, n: np.ndarray, raw: bytes) -> bytes:
        out, at = [], 0
        held = b""
        for byte, k in zip([*self.byte[ids].tolist(), False], [*n.tolist(), 0], strict=True):
            if byte:
                held += raw[at:at + k]
            else:
                if held:
                    out.append(_characters(held))
                    held = b""
                out.append(raw[at:at + k])
            at += k
        return b"".join(out)


def _is_text(data: np.ndarray | bytes) -> bool:
    try:
        bytes(data).decode()
    except UnicodeDecodeError:
        return False
    return True


def _characters(raw: bytes) -> bytes:
    """Whole characters as they are, any other byte as U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        size = next((k for k in range(1, 5) if at + k <= len(raw) and _is_text(raw[at:at + k])), 0)
        out.append(raw[at:at + size] if size else _LOST)
        at += max(size, 1)
    return b"".join(out)


def _lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    bounds = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=bounds[1:])
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, kind))


def _strings(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    bounds = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=bounds[1:])
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data)))


def encode_pieces(docs: DataFrame, model: str = "piece_bpe_32k.model", end_id: int | None = 2, check: bool = True, decoded: bool = False,
                  block_bytes: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every whole text: ``id_col``, ``ids`` (array of int, ``end_id`` at the end), with ``decoded`` the text that they decode to.

    Null and empty texts have the end id alone; each row of a repeated id is
    encoded; other columns aren't returned. A text of any length is encoded
    whole: it is cut into chunks at its spaces where no piece reaches across
    one, and each distinct chunk is merged once for each Arrow batch at most.
    With ``check`` the library encodes those chunks as well and the job fails
    where it differs.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = PieceModel.opened(_tokenizer_path(model))
        end = np.array([] if end_id is None else [end_id], np.int32)
        for batch in batches:
            texts = pc.replace_substring(batch.column(1), _SPACE, " ")
            texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(pa.scalar(" ", texts.type), texts, pa.scalar("", texts.type)))
            for block in blocks(texts, block_bytes):
                ids, n = pieces.encode_block(block, check)
                if len(end):
                    ids, n = np.insert(ids, np.cumsum(n), end[0]), n + 1
                out = [batch.column(0).slice(block.first, block.n), _lists(ids, n, pa.int32())]
                if decoded:
                    out.append(_strings(*pieces.decode(ids, n)))
                yield pa.RecordBatch.from_arrays(out, ["id", "ids", "decoded"][:len(out)])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, ids array<int>" + ", decoded string" * decoded).withColumnRenamed("id", id_col)


def decode_pieces(rows: DataFrame, model: str = "piece_bpe_32k.model", id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The text of each row of ids: ``id_col`` and ``decoded``; null and empty lists give the empty text, an id outside the vocabulary fails."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = PieceModel.opened(_tokenizer_path(model))
        for batch in batches:
            lists = batch.column(1)
            n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), _strings(*pieces.decode(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), n))], ["id", "decoded"])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(
        run, f"id {kind}, decoded string").withColumnRenamed("id", id_col)
