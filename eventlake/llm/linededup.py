"""Repeated passages by content-defined pieces of lines.

A line is a run of words up to a line feed or the end of a sentence. In lines of
``SPAN`` words or more, each word whose hash is the least of ``SPAN`` neighbouring
ones ends a piece, so equal text is cut alike wherever it stands. From each piece on, and up to each
piece, the least run of pieces with enough words is a window: every shared run
of whole lines with that many words is made of such windows, however many lines it
has, and so is every other shared run but for ``SPAN`` words at most on either side. Windows found
more than once are joined to runs, and these are compared byte by byte with their first place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.packing import packed, unpacked
from eventlake.llm.tables import perhaps_among, stored
from eventlake.llm.text import Block, Hasher, blocks, combined, words

SPAN = 10
BLOCK_BYTES = 8 << 20       # of text whose windows are asked for together
BUCKET_BYTES = 16 << 20     # of text whose windows are counted together


@dataclass(frozen=True)
class Lines:
    """Pieces of the lines of a block."""

    starts: np.ndarray  # bytes, first word to last word
    ends: np.ndarray
    n_words: np.ndarray
    rows: np.ndarray    # each row's first piece; one more at the end


def lines(block: Block) -> Lines:
    found = words(block)
    n = len(found.starts)
    last = np.zeros(n, bool)
    last[found.bounds[1:][np.diff(found.bounds) > 0] - 1] = True
    feeds = np.concatenate([[0], np.cumsum(block.data == 10)])
    last[:-1] |= feeds[found.starts[1:]] > feeds[found.ends[:-1]]
    last |= np.isin(block.data[found.ends - 1], list(b".!?"))
    if n >= SPAN:  # the least hash of each window of SPAN words within a line ends a piece
        line = np.cumsum(last) - last
        inside = np.flatnonzero(line[:-SPAN + 1] == line[SPAN - 1:])
        hashes = Hasher(block.data)(found.starts, found.ends)
        last[inside + np.lib.stride_tricks.sliding_window_view(hashes, SPAN)[inside].argmin(1)] = True
    stop = np.flatnonzero(last)
    begin = np.concatenate([[0], stop[:-1] + 1]) if n else stop
    starts, ends = found.starts[begin], found.ends[stop]
    return Lines(starts, ends, stop - begin + 1, np.searchsorted(starts, block.rows))


def windows(n_words: np.ndarray, rows: np.ndarray, least_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The least runs of pieces with enough words within a row: first piece and end of those that start at a piece, then of the others, which end at one."""
    upto = np.concatenate([[0], np.cumsum(n_words)])
    piece = np.arange(len(n_words))
    begin, end = (np.repeat(x, np.diff(rows)) for x in (rows[:-1], rows[1:]))
    until = np.searchsorted(upto, upto[:-1] + least_words)
    low = piece[until <= end]
    high = until[low]
    since = np.searchsorted(upto, upto[1:] - least_words, side="right") - 1
    back = piece[since >= begin]
    back = back[until[since[back]] != back + 1]
    return low, high, since[back], back + 1


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of one id and text are one document."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(id_col).cast("long"), text).alias("key"), text.alias("text"))


def _packed_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, text) as block rows: keys, pieces of each row, and the hash and words of each piece."""
    part, seq, size = TaskContext.get().partitionId(), 0, 0
    held: list[tuple[list, np.ndarray, np.ndarray, np.ndarray]] = []

    def row() -> pa.RecordBatch:
        fields = [(part << 32) + seq, sum((x[0] for x in held), []), *(np.concatenate([x[k] for x in held]) for k in (1, 2, 3))]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
        fields = [*fields[:2], fields[2].tolist(), fields[3].tobytes(), fields[4].astype(np.uint8).tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([f], k) for f, k in zip(fields, kinds, strict=True)], ["block", "keys", "pieces", "hashes", "words"])

    for batch in batches:
        for block in blocks(batch.column(1)):
            found = lines(block)
            held.append((batch.column(0).slice(block.first, block.n).to_pylist(), np.diff(found.rows), Hasher(block.data)(found.starts, found.ends), found.n_words))
            size += len(block.data)
            if size >= BLOCK_BYTES:
                yield row()
                seq, size, held = seq + 1, 0, []
    if held:
        yield row()


def _unpacked_lines(block: dict, least_words: int) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Piece hashes, each row's first piece and the windows of a block row."""
    rows = np.cumsum([0, *block["pieces"]])
    return np.frombuffer(block["hashes"], np.uint64), rows, windows(np.frombuffer(block["words"], np.uint8).astype(np.int64), rows, least_words)


def _repeated(asked: pa.Table) -> pa.Table:
    """For all requests of one range of hashes: which stand in several places."""
    keys = [np.cumsum(unpacked(x), dtype=np.uint64) for x in asked.column("hashes").to_pylist()]
    several = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(k)) for x, k in zip(asked.column("several").to_pylist(), keys, strict=True)])
    _, at, n = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    again = np.split((n[at] > 1) | (several > 0), np.cumsum([len(x) for x in keys])[:-1])
    return pa.table([asked.column("block"), asked.column("bucket"), pa.array([len(x) for x in keys], pa.int32()),
                     pa.array([np.packbits(x).tobytes() for x in again], pa.binary())], ["block", "bucket", "n", "again"])


_PIECE = "doc_id long, key long, low int, high int, word long, word_end long, start long, end long, body binary"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The asked runs of pieces of each document: their bytes, and places counted in words and bytes."""
    names = ["doc_id", "key", "low", "high", "word", "word_end", "start", "end", "body"]
    for batch in batches:
        for block in blocks(batch.column(2)):
            found, raw = lines(block), block.data.tobytes()
            joined = b"\n".join([raw[x:y] for x, y in zip(found.starts.tolist(), found.ends.tolist(), strict=True)])
            at = np.concatenate([[0], np.cumsum(found.ends - found.starts + 1)])
            word = np.concatenate([[0], np.cumsum(found.n_words)])
            spans = batch.column(3).slice(block.first, block.n)
            low, high = (x.to_numpy() for x in spans.flatten().flatten())
            row = np.repeat(np.arange(block.n), spans.value_lengths().to_numpy())
            begin, owner = found.rows[row], pa.array(block.first + row)
            a, b = begin + low, begin + high
            body = [joined[x:y] for x, y in zip(at[a].tolist(), (at[b] - 1).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(owner), batch.column(1).take(owner), pa.array(low), pa.array(high), pa.array(word[a] - word[begin]), pa.array(word[b] - word[begin]),
                 pa.array(found.starts[a] - block.rows[row]), pa.array(found.ends[b - 1] - block.rows[row]), pa.array(body, pa.binary())], names)


def repeated_passages(docs: DataFrame, least_lines: int = 2, least_words: int = 30, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Passages that stand in another place of the corpus as well, one row each; the first place is left out.

    ``start`` and ``end`` are byte bounds in the document's UTF-8 text,
    ``first_doc_id`` is the document of the first place (the smallest id, where
    parts have several). A passage is a run of pieces of lines of which each is part of
    ``least_words`` neighbouring words, bounded by pieces, that also stand, byte by byte but for the space between
    pieces, in an earlier place that doesn't overlap; ``n_lines`` counts its pieces. Every shared run of whole lines with
    that many words is found in full, and of any other shared run all but ``SPAN``
    words at most on either side. First is what has the
    smallest hash of id and text, then what stands first in the text. Rows of
    the same id and text are one document. Null and empty texts have no lines.

    Blocks of documents ask by ranges of hashes, packed, which of their windows
    stand in several places; only those become rows. A window that is everywhere is joined
    with its single first place. Of texts only those with a run to
    compare are shuffled, and runs, not windows, carry their text to the comparison.
    """
    rows = _keyed(docs, id_col, text_col)
    packed_lines = stored(rows.select("key", "text").mapInArrow(
        _packed_lines, "block long, keys array<long>, pieces array<int>, hashes binary, words binary"), "line-blocks")
    text_blocks = packed_lines.count()
    buckets = max(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), text_blocks * BLOCK_BYTES // BUCKET_BYTES)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.array([(k << 64) // buckets for k in range(1, buckets)], np.uint64)
        for batch in batches:
            for block in batch.to_pylist():
                pieces, _, (low, high, _, _) = _unpacked_lines(block, least_words)
                hashes, n = np.unique(combined(pieces, low, high), return_counts=True)
                bounds = np.concatenate([[0], np.searchsorted(hashes, edges), [len(hashes)]])
                some = np.flatnonzero(np.diff(bounds))
                spans = [slice(bounds[k], bounds[k + 1]) for k in some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), block["block"])), pa.array(some.astype(np.int32)),
                     pa.array([packed(np.diff(hashes[x], prepend=np.uint64(0))) for x in spans], pa.binary()),
                     pa.array([np.packbits(n[x] > 1).tobytes() for x in spans], pa.binary())], ["block", "bucket", "hashes", "several"])

    def repeated_windows(left: pa.Table, right: pa.Table) -> pa.Table:
        answers, out = right.sort_by("bucket"), []
        again = [np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(answers.column("again").to_pylist(), answers.column("n").to_pylist(), strict=True)]
        for block in left.to_pylist() if again else []:
            pieces, rows, (low, high, back_low, back_high) = _unpacked_lines(block, least_words)
            hashes = combined(pieces, low, high)
            _, at = np.unique(hashes, return_inverse=True)
            kept = np.concatenate(again)[at] > 0
            marked = np.zeros(len(pieces), bool)
            marked[low[kept]] = True
            back = marked[back_low]  # whose part, the window from the same piece on, stands elsewhere as well
            low, high = np.concatenate([low[kept], back_low[back]]), np.concatenate([high[kept], back_high[back]])
            row = np.searchsorted(rows, low, side="right") - 1
            out.append(pa.table([pa.array(np.array(block["keys"], np.int64)[row]), pa.array((low - rows[row]).astype(np.int32)),
                                 pa.array((high - rows[row]).astype(np.int32)), pa.array(combined(pieces, low, high).view(np.int64))],
                                ["key", "low", "high", "hash"]))
        schema = pa.schema([("key", pa.int64()), ("low", pa.int32()), ("high", pa.int32()), ("hash", pa.int64())])
        return pa.concat_tables([x.cast(schema) for x in out]) if out else schema.empty_table()

    answers = packed_lines.mapInArrow(ask, "block long, bucket int, hashes binary, several binary").groupBy("bucket").applyInArrow(
        _repeated, "block long, bucket int, n int, again binary")
    found = stored(packed_lines.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        repeated_windows, "key long, low int, high int, hash long"), "line-windows")
    firsts = found.groupBy("hash").agg(F.min(F.struct("key", "low")).alias("at"), F.count("*").alias("n")).where("n > 1")
    firsts = stored(firsts.select("hash", F.col("at.key").alias("first_key"), F.col("at.low").alias("first_low")), "line-firsts")
    links = found.join(firsts, "hash").where("key != first_key or low >= first_low + high - low").withColumn("shift", F.col("low") - F.col("first_low"))
    together = Window.partitionBy("key", "first_key", "shift").orderBy("low", "high")
    apart = F.coalesce((F.col("low") > F.max("high").over(together.rowsBetween(Window.unboundedPreceding, -1))).cast("int"), F.lit(1))
    runs = links.withColumn("apart", apart).withColumn("run", F.sum("apart").over(together.rowsBetween(Window.unboundedPreceding, 0))).groupBy(
        "key", "first_key", "shift", "run").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    runs = stored(runs.select("key", "low", "high", "first_key", (F.col("low") - F.col("shift")).alias("first_low"),
                              (F.col("high") - F.col("shift")).alias("first_high")), "line-runs")
    spans = runs.select("key", "low", "high").union(runs.select("first_key", "first_low", "first_high")).distinct()
    asked = spans.groupBy("key").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    texts = perhaps_among(rows, spans.select("key"), "key").join(asked, "key").dropDuplicates(["key"]).select("doc_id", "key", "text", "spans")
    pieces = stored(texts.mapInArrow(_pieces, _PIECE), "line-pieces")
    other = pieces.select(F.col("key").alias("first_key"), F.col("low").alias("first_low"), F.col("high").alias("first_high"),
                          F.col("doc_id").alias("first_doc_id"), F.col("body").alias("first_body"))
    covered = runs.join(pieces, ["key", "low", "high"]).join(other, ["first_key", "first_low", "first_high"]).where("body = first_body").select(
        "key", "doc_id", "first_doc_id", F.col("low").alias("line"), F.col("high").alias("line_end"), "word", "word_end", "start", "end")
    # Runs that touch or overlap make one passage.
    upto = Window.partitionBy("key").orderBy("line", "line_end", "first_doc_id").rowsBetween(Window.unboundedPreceding, -1)
    opens = F.coalesce((F.col("line") > F.max("line_end").over(upto)).cast("int"), F.lit(1))
    numbered = covered.withColumn("opens", opens).withColumn(
        "passage", F.sum("opens").over(Window.partitionBy("key").orderBy("line", "line_end", "first_doc_id")))
    passages = numbered.groupBy("key", "passage").agg(
        F.min("doc_id").alias("doc_id"), F.min("start").alias("start"), F.max("end").alias("end"),
        (F.max("line_end") - F.min("line")).alias("n_lines"), (F.max("word_end") - F.min("word")).alias("n_words"),
        F.min("first_doc_id").alias("first_doc_id"))
    return passages.where((F.col("n_lines") >= least_lines) & (F.col("n_words") >= least_words)).drop("passage")


def remove_passages(docs: DataFrame, passages: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with their passages cut out of the text; other columns, and texts without one, stay as they are."""
    name = "passages_of_row"
    while name in docs.columns:
        name += "_"
    spans = passages.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias(name)).withColumnRenamed("key", name + "_key")
    key = F.xxhash64(F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    joined = docs.join(spans, key == F.col(name + "_key"), "left").drop(name + "_key")
    names, at = docs.columns, docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, cuts in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                raw, upto, kept = (text or "").encode(), 0, []
                for cut in cuts or []:
                    kept.append(raw[upto:cut["start"]].rstrip(b" "))
                    upto = cut["end"]
                texts.append(b"".join([*kept, raw[upto:]]).decode() if cuts else text)
            columns = [pa.array(texts, pa.string()) if k == at else batch.column(k) for k in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return joined.mapInArrow(run, docs.schema)
