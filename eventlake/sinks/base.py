"""Micro-batch writing: outcome, tolerance, metrics, parking and fan-out.

Writers run on the executors. Files are keyed by the micro-batch id and keyed
stores by the data, so a batch that the same checkpoint runs again leaves the
destination as one run would. A batch id says nothing once the checkpoint is
lost and the input is cut anew: then readers of files take one row for each
idempotency token (``once_per_token``). Topics are appended to, at least once.
"""

from __future__ import annotations

import time
from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.functions.tokens import idempotency_token
from eventlake.operators.changes import latest_changes

# Defaults of a destination.
BATCH_ROWS = 1_000
MAX_FAILURE_FRACTION = 0.0
METRICS_SCHEMA = (
    "sink_name string, batch_id long, records_written long, records_failed long, "
    "duration_ms long, records_parked long"
)
# Errors that mean an unreachable store, by the names of their types.
OUTAGES = ("ConnectionError", "ConnectionRefusedError", "ConnectionResetError", "TimeoutError")


class SinkFailure(RuntimeError):
    """Raised when a batch fails beyond the tolerance; it stops the stream."""


@dataclass(frozen=True)
class BatchOutcome:
    sink_name: str
    batch_id: int
    records_written: int
    records_failed: int
    duration_ms: int
    error: Exception | None = None
    records_parked: int = 0
    first_error: str | None = None

    @property
    def failure_rate(self) -> float:
        """Share of failed rows; a write that raised has failed altogether, whatever its rows."""
        if self.error is not None:
            return 1.0
        total = self.records_written + self.records_failed
        return self.records_failed / total if total else 0.0


class Sink(ABC):
    """A destination that takes micro-batches."""

    def __init__(
        self, name: str, max_failure_fraction: float = MAX_FAILURE_FRACTION,
        metrics_path: str | None = None,
    ):
        self.name = name
        self.first_error: str | None = None
        self.max_failure_fraction = max_failure_fraction
        self.metrics_path = metrics_path

    @abstractmethod
    def write(self, batch: DataFrame, batch_id: int) -> tuple[int, int]:
        """Write one micro-batch; returns (written, failed) rows."""

    def run(self, batch: DataFrame, batch_id: int) -> BatchOutcome:
        """Write and time one batch.

        A write that raises counts no rows: how many there were would take the
        whole batch once more, and the error alone decides.
        """
        began, error, self.first_error = time.perf_counter(), None, None
        try:
            written, failed = self.write(batch, batch_id)
        except Exception as raised:
            written, failed, error = 0, 0, raised
        took = int((time.perf_counter() - began) * 1000)
        return BatchOutcome(self.name, batch_id, written, failed, took, error,
                            first_error=self.first_error)

    def foreach_batch(self) -> Callable[[DataFrame, int], None]:
        """Callback for ``writeStream.foreachBatch``: write, record, halt on breach."""

        def on_batch(batch: DataFrame, batch_id: int) -> None:
            outcome = self.run(batch, batch_id)
            if self.metrics_path:
                record_outcomes(batch.sparkSession, [outcome], self.metrics_path)
            if outcome.error is not None or outcome.failure_rate > self.max_failure_fraction:
                raise SinkFailure(
                    f"{self.name} could not store {outcome.failure_rate:.2%} of batch {batch_id}, "
                    f"tolerated are {self.max_failure_fraction:.2%}; first error: "
                    f"{outcome.error or outcome.first_error or 'rows refused'}"
                ) from outcome.error

        return on_batch


def record_outcomes(spark: SparkSession, outcomes: list[BatchOutcome], path: str) -> None:
    """Outcome rows as a table partitioned by sink and batch; a replayed batch replaces its own."""
    rows = [(o.sink_name, o.batch_id, o.records_written, o.records_failed, o.duration_ms,
             o.records_parked)
            for o in outcomes]
    frame = spark.createDataFrame(rows, METRICS_SCHEMA)
    overwrite_partitions(frame, path, ["sink_name", "batch_id"])


def overwrite_partitions(
    df: DataFrame, path: str, partitions: list[str], fmt: str = "parquet", **options
) -> None:
    """Replace exactly the partitions present in ``df``.

    Rows are gathered by partition first, so a partition gets few files instead
    of one per task; the rebalancing hint lets adaptive execution split a
    partition that holds much of the data.
    """
    # A single new partition, as a micro-batch number is, needs no gathering.
    gather = [c for c in partitions if c not in ("batch_id", "parked_batch")]
    if gather:
        df = df.hint("rebalance", *gather)
    (
        df.write.format(fmt).mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").options(**options)
        .partitionBy(*partitions).save(path)
    )


def write_counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Run ``write`` and return the number of rows, counted by the same job."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return seen.get["n"]


class PartitionSink(Sink):
    """Sink that hands rows to a client opened on the executor.

    ``open_client`` is called once per task and returns a function taking a list
    of row dictionaries and returning one outcome per row: true if it is stored,
    false or a text (the reason) if it is refused. Rows
    never pass the driver; it receives counts and the first error.

    With ``rejects_path`` the rows that are not stored become a table of
    (status, reason, token, row) in the same pass, a partition for each batch.
    The status is ``refused`` (by the store), ``unreachable`` (the call raised
    one of ``outages``) or ``failed`` (it raised something else); rows of status
    ``stored`` are counts without a row, ``n`` each.
    """

    def __init__(self, name: str, open_client, rows_per_call: int = BATCH_ROWS, rejects_path: str | None = None,
                 outages: tuple[str, ...] = OUTAGES, **kwargs):
        super().__init__(name, **kwargs)
        if not callable(open_client):
            raise ValueError(f"sink {name} needs a function that opens its client")
        self.open_client, self.rows_per_call = open_client, rows_per_call
        self.rejects_path, self.outages = rejects_path, outages
        self.counts: dict[str, int] = {}

    def shape(self, batch: DataFrame) -> DataFrame:
        """Rows as the client takes them."""
        return batch

    @property
    def as_they_come(self) -> bool:
        """Whether the client takes the rows of a batch unshaped, each by itself."""
        return type(self).shape is PartitionSink.shape

    def _sent(self, batch: DataFrame) -> DataFrame:
        """What became of the rows; they are sent whenever this is evaluated."""
        open_client, size, outages = self.open_client, self.rows_per_call, self.outages

        def send(batches: Iterator) -> Iterator:
            import pyarrow as pa

            store, stored, kind = open_client(), 0, None
            for records in batches:
                row, token = records.column("row"), records.column("token")
                kind = row.type
                for start in range(0, records.num_rows, size):
                    rows = row.slice(start, size).to_pylist()
                    try:
                        verdicts = list(store(rows))
                        status = "refused"
                    except Exception as raised:  # the whole call failed
                        known = {t.__name__ for t in type(raised).__mro__} & set(outages)
                        status = "unreachable" if known else "failed"
                        verdicts = [f"{type(raised).__name__}: {raised}"] * len(rows)
                    verdicts += [False] * (len(rows) - len(verdicts))
                    lost = [i for i, v in enumerate(verdicts[:len(rows)]) if isinstance(v, str) or not v]
                    stored += len(rows) - len(lost)
                    if lost:
                        places = pa.array([start + i for i in lost], pa.int64())
                        reasons = [v if isinstance(v, str) else "refused" for v in (verdicts[i] for i in lost)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([status] * len(lost)), pa.array(reasons), pa.array([1] * len(lost)), token.take(places), row.take(places)],
                            ["status", "reason", "n", "token", "row"])
            if kind is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(["stored"]), pa.nulls(1, pa.string()), pa.array([stored]), pa.nulls(1, pa.string()), pa.nulls(1, kind)],
                    ["status", "reason", "n", "token", "row"])

        shaped = self.shape(batch)
        rows = shaped.select(F.struct(*[F.col(f"`{c}`") for c in shaped.columns]).alias("row"), idempotency_token(shaped).alias("token"))
        return rows.mapInArrow(send, rejects_schema(shaped.schema))

    def write(self, batch: DataFrame, batch_id: int) -> tuple[int, int]:
        def n_of(status: str) -> Column:
            return F.coalesce(F.sum(F.when(F.col("status") == status, F.col("n"))), F.lit(0)).alias(status)

        statuses = ("stored", "refused", "unreachable", "failed")
        error = F.min(F.when(F.col("status").isin("unreachable", "failed"), F.col("reason"))).alias("error")
        sent = self._sent(batch)
        if self.rejects_path:
            seen = Observation()
            numbered = sent.observe(seen, *map(n_of, statuses), error).withColumn("batch_id", F.lit(batch_id).cast("long"))
            overwrite_partitions(numbered, self.rejects_path, ["batch_id"])
            total = seen.get
        else:
            total = sent.agg(*map(n_of, statuses), error).first().asDict()
        self.first_error, self.counts = total["error"], {s: total[s] for s in statuses}
        return total["stored"], sum(total[s] for s in statuses[1:])


def rejects_schema(row_schema: T.StructType) -> T.StructType:
    """Table of what a ``PartitionSink`` could not store, without its ``batch_id``."""
    return T.StructType([
        T.StructField("status", T.StringType()), T.StructField("reason", T.StringType()), T.StructField("n", T.LongType()),
        T.StructField("token", T.StringType()), T.StructField("row", row_schema)])


def rejected_rows(spark: SparkSession, rejects_path: str, row_schema: T.StructType) -> DataFrame:
    """Refused, unreachable and failed rows of all batches: ``batch_id``, ``status``, ``reason``, ``token`` and the row's columns."""
    full = T.StructType([*rejects_schema(row_schema).fields, T.StructField("batch_id", T.LongType())])
    rows = spark.read.schema(full).parquet(rejects_path).where("status <> 'stored'")
    return rows.select("batch_id", "status", "reason", "token", "row.*")


class ParkingSink(Sink):
    """Writes to ``sink`` and, during an outage of its store, to files to be replayed later.

    An outage is an error whose type (or the type a client raised in a task) is
    among ``outages``. Anything else, a wrong column or refused rows, fails as it
    would without parking. Parked rows are neither written nor failed.

    Where the client takes rows as they come, only the rows of the calls that
    found no store are parked, whatever other tasks have stored. A sink that
    shapes its rows to keys, and one that writes all or nothing, parks the whole
    batch: sent again, it leaves what sending it once leaves.
    """

    def __init__(self, sink: Sink, parking_path: str, outages: tuple[str, ...] = OUTAGES):
        super().__init__(sink.name, sink.max_failure_fraction, sink.metrics_path)
        self.sink, self.parking_path, self.outages = sink, parking_path, outages
        if isinstance(sink, PartitionSink):
            sink.outages = outages
            sink.rejects_path = sink.rejects_path or f"{parking_path.rstrip('/')}-rejects"

    def write(self, batch: DataFrame, batch_id: int) -> tuple[int, int]:
        outcome = self.run(batch, batch_id)
        if outcome.error is not None:
            raise outcome.error
        return outcome.records_written, outcome.records_failed

    def _is_outage(self, outcome: BatchOutcome) -> bool:
        if outcome.error is not None:
            return any(t.__name__ in self.outages for t in type(outcome.error).__mro__)
        counts = self.sink.counts if isinstance(self.sink, PartitionSink) else {}
        return counts.get("unreachable", 0) > 0 and counts.get("failed", 0) == 0

    def run(self, batch: DataFrame, batch_id: int) -> BatchOutcome:
        outcome = self.sink.run(batch, batch_id)
        if isinstance(self.sink, PartitionSink) and self.sink.as_they_come and outcome.error is None:
            n = self.sink.counts["unreachable"]
            if n:
                own = self.sink.rejects_path.rstrip("/")
                rows = batch.sparkSession.read.schema(rejects_schema(batch.schema)).parquet(f"{own}/batch_id={batch_id}")
                self._park(rows.where("status = 'unreachable'").select("row.*"), batch_id)
            return BatchOutcome(self.name, batch_id, outcome.records_written, outcome.records_failed - n, outcome.duration_ms,
                                records_parked=n, first_error=outcome.first_error)
        if outcome.failure_rate <= self.max_failure_fraction or not self._is_outage(outcome):
            return outcome
        return BatchOutcome(self.name, batch_id, 0, 0, outcome.duration_ms, records_parked=self._park(batch, batch_id))

    def _park(self, rows: DataFrame, batch_id: int) -> int:
        parked = rows.withColumn("parked_batch", F.lit(batch_id).cast("long"))
        return write_counted(parked, lambda df: overwrite_partitions(df, self.parking_path, ["parked_batch"]))


def _retired(spark: SparkSession, parking_path: str) -> DataFrame:
    """Batch ids that were replayed: one row each in a table next to the parked rows."""
    path = f"{parking_path.rstrip('/')}-retired"
    overwrite_partitions(
        spark.createDataFrame([], "n int, parked_batch long"), path, ["parked_batch"])
    return spark.read.schema("n int, parked_batch long").parquet(path)


def parked_batches(spark: SparkSession, parking_path: str, schema) -> DataFrame:
    """Rows waiting for replay with their batch id; the schema needs no files to exist."""
    full = T.StructType([*schema.fields, T.StructField("parked_batch", T.LongType())])
    rows = spark.read.schema(full).parquet(parking_path)
    return rows.join(_retired(spark, parking_path), "parked_batch", "left_anti").select(
        *[f.name for f in schema.fields], "parked_batch")


def replay_parked(spark: SparkSession, parking_path: str, schema, sink: Sink) -> list[BatchOutcome]:
    """Give every parked batch to ``sink`` again, under its own batch id, and retire it.

    A batch that fails again stays parked; where the client takes rows as they
    come, only those of its rows that found no store again. Refused rows of a replay go to a table of their
    own (``-replayed``), beside those of the first time. The loop runs over batch ids (a short
    list of folder names), not over rows.
    """
    if isinstance(sink, PartitionSink) and sink.as_they_come:
        sink = ParkingSink(sink, parking_path)
    first = sink.sink if isinstance(sink, ParkingSink) else sink
    if isinstance(first, PartitionSink) and first.rejects_path:
        first.rejects_path = f"{first.rejects_path.rstrip('/').removesuffix('-replayed')}-replayed"
    waiting = parked_batches(spark, parking_path, schema)
    ids = [r[0] for r in waiting.select("parked_batch").distinct().orderBy(1).toLocalIterator()]
    outcomes = []
    for i in ids:
        outcome = sink.run(waiting.where(F.col("parked_batch") == i).drop("parked_batch"), i)
        if outcome.failure_rate <= sink.max_failure_fraction and not outcome.records_parked:
            done = spark.createDataFrame([(1, i)], "n int, parked_batch long")
            overwrite_partitions(done, f"{parking_path.rstrip('/')}-retired", ["parked_batch"])
        outcomes.append(outcome)
    return outcomes


def once_per_token(df: DataFrame, newest: str = "batch_id") -> DataFrame:
    """One row for each idempotency token, the one of the highest ``newest``.

    For tables whose input was written again under other batch ids.
    """
    rows = df.withColumn("__token", idempotency_token(df))
    return latest_changes(rows, ["__token"], [newest]).drop("__token")


def fan_out(sinks: list[Sink]) -> Callable[[DataFrame, int], None]:
    """One callback feeding several sinks from one computed batch.

    The batch is persisted while it is written, so the shared plan runs once. A
    lost executor only costs the recomputation of its cached partitions.
    """
    callbacks = [s.foreach_batch() for s in sinks]

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for callback in callbacks:
                callback(batch, batch_id)
        finally:
            batch.unpersist()

    return on_batch
