"""Hot store: one hash of text fields per key, with an expiry time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.tokens import field_text, idempotency_token
from eventlake.sinks.base import PartitionSink


def _store_key(df: DataFrame, prefix: str, key_field: str) -> Column:
    own = F.col(key_field).cast("string") if key_field in df.columns else F.lit(None)
    return F.concat(F.lit(prefix), F.coalesce(own, idempotency_token(df)))


def _fields(df: DataFrame, columns: list[str]) -> Column:
    entries = F.array(*[
        F.struct(F.lit(c).alias("key"), field_text(df, c).alias("value")) for c in columns
    ])
    present = F.filter(entries, lambda e: e["value"].isNotNull())
    return F.map_from_entries(present)


def hash_rows(
    df: DataFrame, prefix: str, key_field: str, ttl_seconds: int, written_at: Column,
    position: list[str] | None = None, drop: tuple[str, ...] = (),
) -> DataFrame:
    """(key, fields, expires_at), the newest row by ``position`` winning per key.

    The stored hash is replaced. Null fields are absent from it; rows without a
    key field fall back to their idempotency token.
    """
    columns = [c for c in df.columns if c not in drop]
    order = [F.col(c) for c in position or []]
    rows = df.select(
        _store_key(df, prefix, key_field).alias("key"), _fields(df, columns).alias("fields"),
        (written_at + F.expr(f"INTERVAL {ttl_seconds} SECONDS")).alias("expires_at"),
        *[c.alias(f"__p{i}") for i, c in enumerate(order)],
    )
    if not order:
        return rows
    names = [f"__p{i}" for i in range(len(order))]
    newest = F.max_by(F.struct("fields", "expires_at"), F.struct(*names)).alias("__row")
    return rows.groupBy("key").agg(newest).select("key", "__row.*")


def merged_hash_rows(
    df: DataFrame, prefix: str, key_field: str, position: list[str]
) -> DataFrame:
    """(key, fields) merged field by field, as repeated hash writes leave it.

    Each field keeps its newest value that is not null.
    """
    names = df.columns
    texts = [field_text(df, c).alias(f"__f{i}") for i, c in enumerate(names)]
    rows = df.select(
        _store_key(df, prefix, key_field).alias("key"), *texts, F.struct(*position).alias("__p")
    )
    # Rows without an ordering value do not count for max_by.
    newest = [
        F.max_by(f"__f{i}", F.when(F.col(f"__f{i}").isNotNull(), F.col("__p"))).alias(f"__f{i}")
        for i in range(len(names))
    ]
    entries = F.array(*[
        F.struct(F.lit(c).alias("key"), F.col(f"__f{i}").alias("value"))
        for i, c in enumerate(names)
    ])
    present = F.filter(entries, lambda e: e["value"].isNotNull())
    return rows.groupBy("key").agg(*newest).select("key", F.map_from_entries(present).alias("fields"))


def live_rows(hashes: DataFrame, now: Column) -> DataFrame:
    """Entries that have not expired."""
    return hashes.where(F.col("expires_at") > now)


class KeyedSink(PartitionSink):
    """Hot-store writer; rows reach the client as {key, fields, expires_at}."""

    def __init__(
        self, name: str, open_client, key_field: str, prefix: str = "streaming:",
        ttl_seconds: int = 3600, position: tuple[str, ...] = (), **kwargs,
    ):
        super().__init__(name, open_client, **kwargs)
        self.key_field, self.prefix, self.ttl_seconds = key_field, prefix, ttl_seconds
        self.position = list(position)

    def shape(self, batch: DataFrame) -> DataFrame:
        rows = hash_rows(
            batch, self.prefix, self.key_field, self.ttl_seconds, F.current_timestamp(),
            self.position,
        )
        return rows.withColumn("fields", F.map_entries("fields"))


