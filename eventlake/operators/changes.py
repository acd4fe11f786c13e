"""Change-log state: fold, merge, truncate, statistics, column diff."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.schemas import OP_DELETE, OP_SNAPSHOT, OP_TRUNCATE


def latest_changes(changes: DataFrame, keys: list[str], position: list[str]) -> DataFrame:
    """The newest row per key by ``position`` (log position first, then offset).

    ``max_by`` combines on the map side, so a key with many changes sends one
    row per input task, and nothing is ranked or collected.
    """
    rest = [c for c in changes.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*position)).alias("__row")
    out = changes.groupBy(*keys).agg(newest)
    return out.select(*[f"__row.{c}" if c in rest else c for c in changes.columns])


def latest_state(
    changes: DataFrame, keys: list[str], position: list[str], op_col: str = "cdc_op"
) -> DataFrame:
    """Current table contents: newest row per key, deleted keys left out."""
    return latest_changes(changes, keys, position).where(F.col(op_col) != OP_DELETE)


def latest_state_with_truncate(
    changes: DataFrame, table_col: str, keys: list[str], position: list[str],
    op_col: str = "cdc_op",
) -> DataFrame:
    """``latest_state`` over several tables, each cleared by its truncates.

    The log is folded first. A key whose newest change precedes the table's last
    truncate has only earlier changes, so comparing the folded row is enough and
    the truncate positions (one row per table) never meet the raw log.
    """
    marks = (
        changes.where(F.col(op_col) == OP_TRUNCATE)
        .groupBy(table_col)
        .agg(F.max(F.struct(*position)).alias("__cleared"))
    )
    folded = latest_state(
        changes.where(F.col(op_col) != OP_TRUNCATE), [table_col, *keys], position, op_col
    )
    alive = F.col("__cleared").isNull() | (F.struct(*position) > F.col("__cleared"))
    return (
        folded.join(marks, table_col, "left")
        .where(alive).drop("__cleared").select(*changes.columns)
    )


def merge_guarded(
    target: DataFrame, updates: DataFrame, keys: list[str],
    position: tuple[str, ...] = ("source_lsn", "raw_offset"),
) -> DataFrame:
    """Target after an upsert that only lets newer positions overwrite.

    A new key is inserted; a stale or repeated change (position not above the
    target's) changes nothing. The position is compared part by part, a missing
    part counting as lowest, so sources without a log position go by the offset.
    A delete stays in the target as a row of its own: without it a late update
    from before the delete would bring the key back. Readers take ``live_rows``;
    ``drop_tombstones`` ends the retention of old deletes.
    """
    both = target.withColumn("__held", F.lit(1)).unionByName(
        updates.withColumn("__held", F.lit(0)), allowMissingColumns=True
    )
    return latest_changes(both, keys, [*position, "__held"]).drop("__held")


def live_rows(target: DataFrame, op_col: str = "cdc_op") -> DataFrame:
    """Rows of a merged target that are not deletes."""
    return target.where(~F.col(op_col).eqNullSafe(OP_DELETE))


def drop_tombstones(
    target: DataFrame, before: Column, time_col: str = "event_time", op_col: str = "cdc_op"
) -> DataFrame:
    """Target without the deletes older than ``before``.

    Safe once no change from before that time can arrive any more.
    """
    old = F.col(op_col).eqNullSafe(OP_DELETE) & F.coalesce(F.col(time_col) < before, F.lit(False))
    return target.where(~old)


def merge_into_table(
    updates: DataFrame, table: str, keys: list[str],
    position: tuple[str, ...] = ("source_lsn", "raw_offset"),
) -> None:
    """``merge_guarded`` as ``MERGE INTO`` a lake table that supports row changes.

    The guard belongs to the matched branch: in the join condition a stale row
    would count as not matched and be inserted. Deletes are stored like other
    changes, see ``live_rows``.
    """
    source = latest_changes(updates, keys, list(position)).alias("u")
    on = F.lit(True)
    for key in keys:
        on = on & (F.col(f"u.{key}") == F.col(f"{table}.{key}"))
    newer = F.struct(*[F.col(f"u.{c}") for c in position]) > F.struct(
        *[F.col(f"{table}.{c}") for c in position])
    source.mergeInto(table, on).whenMatched(newer).updateAll().whenNotMatched().insertAll().merge()


def snapshot_as_changes(
    snapshot: DataFrame, row_schema: T.StructType, event_time: Column, lsn: Column
) -> DataFrame:
    """Snapshot rows as changes with op ``r``, shaped like decoded changes."""
    row = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in row_schema.fields])
    return snapshot.select(
        event_time.alias("event_time"), F.lit(OP_SNAPSHOT).alias("cdc_op"),
        lsn.cast("long").alias("source_lsn"), F.lit(None).cast(row_schema).alias("before"),
        row.alias("after"),
    )


def snapshot_then_changes(snapshot_changes: DataFrame, changes: DataFrame) -> DataFrame:
    """One feed: snapshot rows, then the change feed; additive columns are allowed."""
    return snapshot_changes.unionByName(changes, allowMissingColumns=True)


def key_image(key: str) -> Column:
    """Key of a change: from the new image, or the old one for deletes."""
    return F.coalesce(F.col(f"after.{key}"), F.col(f"before.{key}"))


def op_stats(
    changes: DataFrame, table_col: str = "source_table", time_col: str = "event_time",
    op_col: str = "cdc_op",
) -> DataFrame:
    """Rows per table and minute, one column per operation."""
    minute = F.date_trunc("minute", time_col).alias("minute")
    # Operation codes and their column names.
    ops = {"c": "creates", "u": "updates", "d": "deletes", "r": "snapshots", "t": "truncates"}
    return changes.groupBy(F.col(table_col), minute).agg(
        *[F.count_if(F.col(op_col) == op).alias(name) for op, name in ops.items()]
    )


def changed_columns(row_schema: T.StructType) -> Column:
    """Names of the fields an update changed, nulls compared as values."""
    flags = [
        F.when(~F.col(f"before.{f.name}").eqNullSafe(F.col(f"after.{f.name}")), F.lit(f.name))
        for f in row_schema.fields
    ]
    return F.array_compact(F.array(*flags))


def column_diff(changes: DataFrame, row_schema: T.StructType) -> DataFrame:
    """Updates with the list of changed columns."""
    return changes.where(F.col("cdc_op") == "u").withColumn(
        "changed", changed_columns(row_schema)
    )
