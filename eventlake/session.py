"""Session settings the transforms rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

# Settings that may be changed on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot keys are normal in event data: let a skewed join partition be split.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles a method of over 8,000 bytes: a stage with one runs operator by
    # operator instead, whose code is split.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Merge sessions on the map side, so a hot user ships sessions, not events.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # A join of two streams keeps one store for each partition, not four; a running query keeps its checkpoint's format.
    "spark.sql.streaming.join.stateFormatVersion": "3",
    "spark.sql.parquet.compression.codec": "zstd",
}

# Settings of what streams write, which stays on disk for the whole run.
STREAM_CONF = {
    # Shuffle files go when their micro-batch has ended, not when the driver's JVM next collects garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Eight bytes and statistics, not twelve bytes without.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
}


def build_session(
    app_name: str = "eventlake",
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for the jobs in ``eventlake.plans``.

    The master is left to ``spark-submit`` unless given, and the shuffle width
    is left to the cluster default unless given in ``extra``: a stateful query
    freezes it in its checkpoint, so it belongs to the deployment.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**RUNTIME_CONF, **(extra or {})}.items():
        builder = builder.config(name, str(value))
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else has built."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


@contextmanager
def stream_settings(spark: SparkSession) -> Iterator[None]:
    """Applies ``STREAM_CONF`` to what is written inside; a query started inside keeps it, as it clones the session."""
    before = {name: spark.conf.get(name, None) for name in STREAM_CONF}
    for name, value in STREAM_CONF.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def ship_package(spark: SparkSession) -> None:
    """Gives this package to the executors, for clusters that don't have it installed."""
    source = Path(__file__).parent
    target = Path(tempfile.mkdtemp(prefix="eventlake-")) / "eventlake.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(source.rglob("*.py")):
            archive.write(path, path.relative_to(source.parent))
    spark.sparkContext.addPyFile(str(target))


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    Only where the session names no ``spark.checkpoint.dir`` (tests, a laptop)
    is a temporary folder of this machine used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="eventlake-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Removes a folder of ``shared_dir`` that nobody reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
