"""Fixity audit of WARC archives by Merkle trees.

An archive is a folder of WARC files. A file's records, in the order of their
offsets, are the leaves of a tree: groups of ``FANOUT`` neighbours are hashed
together until one root is left, and the roots of the files, by name, go on
to the root of the archive. Two replicas with one root are equal. If the roots
differ, only children of differing nodes are compared, level by level, down to
the corrupt byte ranges.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm.tables import stored
from eventlake.session import shared_dir

FANOUT = 16
NAME_DIGITS = 4  # depth of the tree above the files
_LENGTH = re.compile(rb"\r\nContent-Length: *(\d+)\r\n", re.I)
_ID = re.compile(rb"\r\nWARC-Record-ID: *<urn:page:(-?\d+|null)>\r\n", re.I)
_END = b"\r\n\r\n"


def record(id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> Column:
    """A page as a WARC response record without its closing line feeds. Nulls: empty body, no target address, id ``null``."""
    body = F.coalesce(F.col(body_col).cast("string"), F.lit(""))
    address = F.when(F.col(url_col).isNotNull(), F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace(F.col(url_col).cast("string"), r"[\r\n]", ""), F.lit("\r\n")))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(">\r\n"),
        F.coalesce(address, F.lit("")), F.lit("Content-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body)


def write_archive(pages: DataFrame, path: str, records_per_file: int = 4000, id_col: str = "page_id", **columns: str) -> None:
    """Writes pages as compressed WARC files, ordered by id over all files (null first, ties by content)."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), record(id_col, **columns).alias("value"))
    ordered = rows.repartitionByRange(F.col("id").asc_nulls_first(), F.xxhash64("value")).sortWithinPartitions(F.col("id").asc_nulls_first(), "value")
    ordered.select("value").write.option("lineSep", _END.decode()).option("compression", "gzip") \
        .option("maxRecordsPerFile", records_per_file).text(path)


def _digest(*parts: bytes) -> bytes:
    found = hashlib.sha256()
    for part in parts:
        found.update(part)
    return found.digest()


def file_tree(data: bytes) -> list[tuple]:
    """All nodes of a file's tree: (level, number, first byte, last byte, record id or null, hash).

    Records are found by their lengths. Bytes that are no record, as after a
    damaged header, form one leaf up to the next header that can be read.
    """
    leaves, at = [], 0
    while at < len(data):
        head = data.find(_END, at)
        length = _LENGTH.search(data, at, head + 2) if head >= 0 and data.startswith(b"WARC/", at) else None
        stop = head + len(_END) + int(length[1]) + len(_END) if length else len(data) + 1
        if stop > len(data) or data[stop - len(_END):stop] != _END:
            following = data.find(b"\r\n\r\nWARC/1.1\r\n", at + 1)
            stop = len(data) if following < 0 else following + len(_END)
        named = _ID.search(data, at, head + 2) if head >= 0 else None
        leaves.append((0, len(leaves), at, stop, int(named[1]) if named and named[1] != b"null" else None, _digest(b"\x00", data[at:stop])))
        at = stop
    nodes, level = list(leaves), leaves
    while len(level) > 1 or not nodes:
        if not level:
            return [(0, 0, 0, 0, None, _digest(b"\x00"))]
        groups = [level[k:k + FANOUT] for k in range(0, len(level), FANOUT)]
        level = [(g[0][0] + 1, k, g[0][2], g[-1][3], None, _digest(b"\x01", *(x[5] for x in g))) for k, g in enumerate(groups)]
        nodes.extend(level)
    return nodes


def hash_archive(files: DataFrame) -> DataFrame:
    """Nodes of the trees of all files; ``files`` has ``path`` and ``content`` as the binary file source gives them.

    ``file`` is the name within the folder. A file's root has its greatest
    level. Compressed files are opened; one that can't be has a single leaf.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    data = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
                except (OSError, EOFError):
                    data = content
                nodes = file_tree(data)
                columns = [[path.rpartition("/")[2]] * len(nodes), *zip(*nodes, strict=True)]
                kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)],
                                                 ["file", "level", "number", "start", "end", "record_id", "hash"])

    schema = "file string, level int, number long, start long, end long, record_id long, hash binary"
    return files.select("path", "content").mapInArrow(run, schema)


def stored_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _roots(nodes: DataFrame) -> DataFrame:
    """Each file's root, and where its name stands in the archive's tree: the hexadecimal digits of the name's hash."""
    top = nodes.groupBy("file").agg(F.max(F.struct("level", "hash")).alias("top"))
    return top.select("file", F.substring(F.sha2("file", 256), 1, NAME_DIGITS).alias("prefix"), "top.level", "top.hash")


def archive_tree(nodes: DataFrame) -> DataFrame:
    """The archive's tree above its files: ``prefix`` and ``hash``; the archive's root has the empty prefix.

    A node with n digits is over the at most 16 nodes with one digit more;
    nodes with all digits are over the files of that prefix, by name.
    """
    level = _roots(nodes).select("prefix", F.concat("file", F.lit(":"), F.hex("hash")).alias("part"))
    level = level.groupBy("prefix").agg(F.sha2(F.concat_ws(",", F.array_sort(F.collect_list("part"))), 256).alias("hash"))
    out = level
    for digits in range(NAME_DIGITS - 1, -1, -1):
        part = F.concat("prefix", F.lit(":"), "hash")
        level = level.groupBy(F.substring("prefix", 1, digits).alias("prefix")).agg(
            F.sha2(F.concat_ws(",", F.array_sort(F.collect_list(part))), 256).alias("hash"))
        out = out.union(level)
    return stored(out, "archive-tree")


def _differing_files(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Files whose roots differ, found from the archives' roots downwards: ``file`` and either root's level."""
    trees = [archive_tree(expected), archive_tree(found).withColumnRenamed("hash", "other")]
    open_nodes = None
    for digits in range(NAME_DIGITS + 1):
        a, b = (t.where(F.length("prefix") == digits) for t in trees)
        both = a.join(b, "prefix", "full").where(~F.col("hash").eqNullSafe(F.col("other"))).select("prefix")
        if open_nodes is not None:
            both = both.join(open_nodes.withColumnRenamed("prefix", "above"), F.substring("prefix", 1, digits - 1) == F.col("above"), "left_semi")
        open_nodes = both
    open_nodes = stored(open_nodes, "open-prefixes")
    a = _roots(expected).join(open_nodes, "prefix", "left_semi").select("file", "level", "hash")
    b = _roots(found).join(open_nodes, "prefix", "left_semi").select("file", F.col("level").alias("level_b"), F.col("hash").alias("hash_b"))
    apart = a.join(b, "file", "full").where(~F.col("hash").eqNullSafe(F.col("hash_b")))
    return stored(apart.select("file", "level", "level_b", F.lit(0).cast("long").alias("number")), "differing-files")


def locate_corruption(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Byte ranges in which the replica ``found`` differs from ``expected``; both are stored tables of nodes.

    Roots of files are compared first; below a file whose root differs, a node
    is looked at only if its parent differs. Returns ``file``, ``start``,
    ``end`` (of the expected record), ``record_id`` and ``state``: ``corrupt``,
    or ``missing`` where the replica has no such file or leaf, or ``extra``
    where only the replica has it. Equal replicas give no row.
    """
    apart = _differing_files(expected, found)
    top = apart.agg(F.max(F.greatest(F.coalesce("level", F.lit(0)), F.coalesce("level_b", F.lit(0))))).first()[0]
    if top is None:
        return expected.select("file", "start", "end", "record_id", F.lit("").alias("state")).limit(0)
    # A node is open if it is the root of a differing file, or its parent differs.
    differing = None
    for level in range(top, -1, -1):
        open_nodes = apart.where(F.greatest("level", "level_b") == level).select("file", "number")
        if differing is not None:
            children = F.sequence(F.col("number") * FANOUT, F.col("number") * FANOUT + FANOUT - 1)
            open_nodes = open_nodes.union(differing.select("file", F.explode(children).alias("number")))
        x, y = (t.where(F.col("level") == level).select("file", "number", "start", "end", "record_id", "hash").join(
            open_nodes, ["file", "number"], "left_semi") for t in (expected, found))
        y = y.select("file", "number", *[F.col(c).alias(f"{c}_b") for c in ("start", "end", "record_id", "hash")])
        differing = stored(x.join(y, ["file", "number"], "full").where(~F.col("hash").eqNullSafe(F.col("hash_b"))), "differing-nodes")
    state = F.when(F.col("hash").isNull(), "extra").when(F.col("hash_b").isNull(), "missing").otherwise("corrupt")
    return differing.select("file", F.coalesce("start", "start_b").alias("start"), F.coalesce("end", "end_b").alias("end"),
                            F.coalesce("record_id", "record_id_b").alias("record_id"), state.alias("state"))


def damaged(files: DataFrame, divisor: int, remainder: int) -> DataFrame:
    """A drill: the same files, with the last byte of the body flipped in records whose id leaves ``remainder``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for content in batch.column(1).to_pylist():
                data = bytearray(gzip.decompress(content))
                for level, _, _, stop, record_id, _ in file_tree(bytes(data)):
                    if level == 0 and record_id is not None and record_id % divisor == remainder:
                        data[stop - len(_END) - 1] ^= 1
                out.append(bytes(data))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["path", "content"])

    return files.select("path", "content").mapInArrow(run, "path string, content binary")


def audited(pages: DataFrame, divisor: int, remainder: int) -> DataFrame:
    """Archives pages, damages a replica, and tells for each record whether the audit finds it ``intact`` or ``corrupt``."""
    spark, path = pages.sparkSession, shared_dir(pages.sparkSession, "warc")
    write_archive(pages, path)
    files = stored_files(spark, path)
    expected = stored(hash_archive(files), "nodes")
    found = stored(hash_archive(damaged(files, divisor, remainder)), "replica-nodes")
    bad = locate_corruption(expected, found).select("file", "start", "state")
    leaves = expected.where("level = 0 and end > 0")
    return leaves.join(bad, ["file", "start"], "left").select(
        F.col("record_id").alias("page_id"), (F.col("end") - F.col("start")).alias("n_bytes"), F.lower(F.hex("hash")).alias("digest"),
        F.coalesce("state", F.lit("intact")).alias("state"))
