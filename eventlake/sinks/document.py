"""Search store: rotating index, stable document id, JSON source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.functions.tokens import idempotency_token, index_name, record_json
from eventlake.sinks.base import PartitionSink


def documents(
    df: DataFrame, index_pattern: str, time_col: str = "event_time",
    position: list[str] | None = None, id_col: str | None = None,
) -> DataFrame:
    """(_index, _id, _source); with ``position`` only the newest row per document stays.

    The id is the idempotency token, or a key column where the store is to hold
    one document per key.
    """
    token = idempotency_token(df)
    doc_id = F.coalesce(F.col(id_col).cast("string"), token) if id_col else token
    rows = df.select(
        index_name(index_pattern, F.col(time_col)).alias("_index"), doc_id.alias("_id"), record_json(df).alias("_source"),
        F.struct(*(position or [F.lit(0).alias("none")])).alias("__p"),
    )
    if not position:
        return rows.drop("__p")
    return rows.groupBy("_index", "_id").agg(F.max_by("_source", "__p").alias("_source"))


class DocumentSink(PartitionSink):
    """Bulk writer; the client reports one outcome per document."""

    def __init__(
        self, name: str, open_client, index_pattern: str = "events-{yyyy_mm_dd}",
        time_col: str = "event_time", position: tuple[str, ...] = (), id_col: str | None = None,
        **kwargs,
    ):
        super().__init__(name, open_client, **kwargs)
        self.index_pattern, self.time_col, self.position = index_pattern, time_col, list(position)
        self.id_col = id_col

    def shape(self, batch: DataFrame) -> DataFrame:
        return documents(batch, self.index_pattern, self.time_col, self.position, self.id_col)


def statuses_ok(statuses: list[int]) -> list[bool]:
    """Bulk item statuses as stored / not stored."""
    return [status < 400 for status in statuses]
