"""Folding of the folders that micro-batches leave into few files for each partition.

A table written batch by batch has a folder for each (partition, batch): 17,280
a day at a trigger of five seconds. ``fold_batches`` gathers the closed batches
into a table beside it, by partition, with the batch id as a column. A row in a
ledger says up to which batch that has happened; readers take folded rows up to
there and the folders of later batches. So every step can be repeated:

1. closed batches are written to partitions of the next fold; without a row in
   the ledger nobody reads them, and a repetition replaces them;
2. the ledger gets its row, in one file: from now on readers take the fold;
3. the folders of the folded batches are removed; what a crash leaves of them
   is passed over by readers and removed by the next fold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.sinks.base import overwrite_partitions

_LEDGER = "upto long, fold long"


def _beside(path: str, name: str) -> str:
    return f"{path.rstrip('/')}-{name}"


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _folders(spark: SparkSession, path: str, depth: int) -> list:
    """Paths of the folders ``depth`` levels below: one listing for each level, no data is read."""
    fs, where = _files(spark, path + "/*" * depth)
    return [s.getPath() for s in fs.globStatus(where) or [] if s.isDirectory()]


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """``fold`` and ``upto``, the last batch in it, of every fold."""
    at = _beside(path, "ledger")
    overwrite_partitions(spark.createDataFrame([], _LEDGER), at, ["fold"])
    return spark.read.schema(_LEDGER).parquet(at)


def _last_fold(spark: SparkSession, path: str) -> tuple[int, int]:
    row = ledger(spark, path).agg(F.max("fold").alias("fold"), F.max("upto").alias("upto")).first()
    return (-1, -1) if row["fold"] is None else (row["fold"], row["upto"])


def fold_batches(
    spark: SparkSession, path: str, schema: T.StructType, partition_by: tuple[str, ...] = ("event_date",),
    keep_open: int = 1, until: int = 3,
) -> int | None:
    """Folds all batches of a table but the newest ``keep_open``; returns the last folded batch, or None if there is none to fold.

    ``schema`` is that of the table without ``batch_id``. A batch is closed when
    the checkpoint can't run it again, which holds for all but the newest one.
    Rows are gathered by partition with the rebalancing hint, so the size of
    a partition gives its number of files. One folding job at a time may run.
    ``until`` stops after a step (1 to 3), for tests of a crash.
    """
    number, folded = _last_fold(spark, path)
    depth = len(partition_by) + 1
    batches = {int(p.getName().split("=")[1]) for p in _folders(spark, path, depth) if p.getName().startswith("batch_id=")}
    closed = sorted(batches)[:-keep_open] if keep_open else sorted(batches)
    fresh = [b for b in closed if b > folded]
    upto = max(fresh, default=folded)
    if fresh:
        full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
        rows = spark.read.schema(full).parquet(path).where((F.col("batch_id") > folded) & (F.col("batch_id") <= upto))
        overwrite_partitions(rows.withColumn("fold", F.lit(number + 1).cast("long")), _beside(path, "folded"), [*partition_by, "fold"])
        if until == 1:
            return None
        mark = spark.createDataFrame([(upto, number + 1)], _LEDGER).coalesce(1)
        overwrite_partitions(mark, _beside(path, "ledger"), ["fold"])
    if until == 2:
        return upto
    for folder in _folders(spark, path, depth):
        name = folder.getName()
        if name.startswith("batch_id=") and int(name.split("=")[1]) <= upto:
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return upto if fresh else None


def read_folded(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of a table, folded or not, with their ``batch_id``; each is read from one place only."""
    number, upto = _last_fold(spark, path)
    full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    recent = spark.read.schema(full).parquet(path).where(F.col("batch_id") > upto)
    if number < 0:
        return recent
    folds = spark.read.schema(T.StructType([*full.fields, T.StructField("fold", T.LongType())])).parquet(_beside(path, "folded"))
    return folds.where(F.col("fold") <= number).select(*full.names).union(recent.select(*full.names))


def file_count(spark: SparkSession, path: str, partition_by: tuple[str, ...] = ("event_date",)) -> int:
    """Data files of a table, folded and not, from listings alone."""
    found = 0
    for at in (path, _beside(path, "folded")):
        fs, where = _files(spark, at + "/*" * (len(partition_by) + 2))
        found += sum(1 for s in fs.globStatus(where) or [] if s.isFile() and not s.getPath().getName().startswith(("_", ".")))
    return found
