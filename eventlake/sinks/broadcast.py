"""Broadcast to connected clients: messages, connection registry, recipients."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.tokens import idempotency_token
from eventlake.operators.changes import latest_changes
from eventlake.sinks.base import Sink, write_counted

CONNECTION_TTL_SECONDS = 24 * 3600
_EVERYONE_SPLITS = 16


def broadcast_messages(
    df: DataFrame, batch_id: Column, targets_col: str = "user_targets"
) -> DataFrame:
    """``value`` = JSON of {user_targets, payload, batch_id, token}; no target means everyone.

    ``token`` is the row's idempotency token: a topic may get a message again, and
    receivers drop what they have seen.
    """
    # A message without user_targets goes to everyone, and JSON leaves nulls out.
    targets = F.col(targets_col) if targets_col in df.columns else F.lit("*")
    message = F.struct(
        targets.alias("user_targets"), F.struct(*df.columns).alias("payload"),
        batch_id.alias("batch_id"), idempotency_token(df).alias("token"),
    )
    return df.select(F.to_json(message).alias("value"))


class BroadcastSink(Sink):
    """Writes the messages to a topic, from the executors, at least once."""

    def __init__(self, name: str, options: dict[str, str], topic: str = "ws-broadcast",
                 targets_col: str = "user_targets", fmt: str = "kafka", **kwargs):
        super().__init__(name, **kwargs)
        self.options, self.topic, self.fmt = options, topic, fmt
        self.targets_col = targets_col

    def write(self, batch: DataFrame, batch_id: int) -> tuple[int, int]:
        rows = broadcast_messages(batch, F.lit(batch_id).cast("long"), self.targets_col)
        rows = rows.withColumn("topic", F.lit(self.topic))
        return write_counted(
            rows, lambda df: df.write.format(self.fmt).options(**self.options).mode("append").save()
        ), 0


def subscribed_topics(topics: Column) -> Column:
    """``a, b,`` as [a, b]; nothing left means everything."""
    parts = F.filter(
        F.transform(F.split(F.coalesce(topics, F.lit("")), ","), lambda t: F.trim(t)),
        lambda t: t != "",
    )
    return F.when(F.size(parts) > 0, parts).otherwise(F.array(F.lit("*")))


def connection_registry(
    events: DataFrame, now: Column, connect: str = "connect", position: str = "ts",
    ttl_seconds: int = CONNECTION_TTL_SECONDS,
) -> DataFrame:
    """Live connections: newest event per connection is a connect and has not expired.

    ``events`` has connection_id, event (connect, disconnect or gone), user_id,
    topics and the ``position`` time. Of events of one instant the one that ends
    the connection counts as the later one.
    """
    ends = events.withColumn("__ends", (F.col("event") != connect).cast("int"))
    newest = latest_changes(ends, ["connection_id"], [position, "__ends", "event"])
    return newest.where(F.col("event") == connect).select(
        "connection_id", F.coalesce("user_id", F.lit("anonymous")).alias("user_id"),
        subscribed_topics(F.col("topics")).alias("subscribed_topics"),
        F.col(position).alias("connected_at"),
        (F.unix_seconds(position) + ttl_seconds).alias("ttl"),
    ).where(F.col("ttl") > F.unix_seconds(now))


def parse_targets(value: Column) -> tuple[Column, Column]:
    """(everyone, users) of the ``user_targets`` JSON of a message.

    A missing target or the text ``"*"`` is everyone, another text is one user,
    a list is many.
    """
    raw = F.get_json_object(value, "$.user_targets")
    everyone = raw.isNull() | (raw == "*")
    many = F.when(raw.startswith("["), F.from_json(raw, "array<string>"))
    users = F.when(everyone, F.array().cast("array<string>")).otherwise(
        F.coalesce(many, F.array(raw))
    )
    return everyone, users


def resolve_recipients(
    messages: DataFrame, registry: DataFrame, splits: int = _EVERYONE_SPLITS
) -> DataFrame:
    """(message columns, connection_id) for every connection a message goes to.

    One equality join: a connection is listed under its user and under one of
    ``splits`` shares of everyone; a message for everyone looks up all shares.
    So a broadcast is spread over ``splits`` keys, a user's messages meet only
    that user's connections, and no side is assumed to be small.
    """
    shares = F.array(*[F.lit(i) for i in range(splits)])
    lookups = F.when(
        F.col("everyone"),
        F.transform(shares, lambda s: F.struct(s.alias("share"), F.lit("").alias("user"))),
    ).otherwise(
        F.transform("users", lambda u: F.struct(F.lit(-1).alias("share"), u.alias("user")))
    )
    wanted = messages.withColumn("__k", F.explode(lookups)).drop("everyone", "users")
    share = F.pmod(F.hash("connection_id"), F.lit(splits))
    listed = registry.select("connection_id", F.explode(F.array(
        F.struct(F.lit(-1).alias("share"), F.col("user_id").alias("user")),
        F.struct(share.alias("share"), F.lit("").alias("user")),
    )).alias("__l"))
    on = (F.col("__k.share") == F.col("__l.share")) & (F.col("__k.user") == F.col("__l.user"))
    return wanted.join(listed, on).drop("__k", "__l")


def delivery_outcomes(deliveries: DataFrame, delivered: Column) -> DataFrame:
    """Pushed and failed counts over a delivery table."""
    ok = F.coalesce(delivered, F.lit(False))
    return deliveries.agg(F.count_if(ok).alias("pushed"), F.count_if(~ok).alias("failed"))
