"""A change log as a stream of rows that come and go."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eventlake.operators.changes import key_image
from eventlake.schemas import OP_DELETE, OP_TRUNCATE
from eventlake.sinks.base import overwrite_partitions
from eventlake.streaming.temporal import JSON_OPTIONS


def _newer(a: list, b: list) -> bool:
    """Whether position ``a`` is above ``b``, part by part, a missing part being lowest."""
    return [(x is not None, x or 0) for x in a] > [(x is not None, x or 0) for x in b]


class Images(StatefulProcessor):
    """Last image of every key of a bucket; returns the image that goes (-1) and the one that comes (+1).

    The changes of one micro-batch are folded first, so a key returns two rows
    at most. Deleted keys stay, without an image, so that a stale change does
    not bring them back. A truncate takes every older image of its table.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.images = handle.getMapState("images", "key string", "position string, image string")
        self.cleared = handle.getMapState("cleared", "name string", "position string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        newest: dict[str, tuple] = {}
        truncates: dict[str, list] = {}
        for part in rows:
            for name, own, op, position, image in zip(*(part[c].tolist() for c in ("name", "own", "op", "position", "image")), strict=True):
                at = json.loads(position)
                if op == OP_TRUNCATE:
                    if name not in truncates or _newer(at, truncates[name]):
                        truncates[name] = at
                elif own is not None:
                    whole = json.dumps([name, own])
                    if whole not in newest or _newer(at, newest[whole][0]):
                        newest[whole] = at, None if op == OP_DELETE else image
        out: list[tuple[int, str]] = []
        for name, at in truncates.items():
            held = json.loads(self.cleared.getValue((name,))[0]) if self.cleared.containsKey((name,)) else None
            if held is None or _newer(at, held):
                self.cleared.updateValue((name,), (json.dumps(at),))
        if truncates:
            for (whole,), (position, image) in list(self.images.iterator()):
                at = truncates.get(json.loads(whole)[0])
                if at is not None and image is not None and not _newer(json.loads(position), at):
                    out.append((-1, image))
                    self.images.updateValue((whole,), (position, None))
        marks: dict[str, list | None] = {}
        for whole, (at, image) in newest.items():
            name = json.loads(whole)[0]
            if name not in marks:
                marks[name] = json.loads(self.cleared.getValue((name,))[0]) if self.cleared.containsKey((name,)) else None
            position, old = self.images.getValue((whole,)) if self.images.containsKey((whole,)) else (None, None)
            if position is not None and not _newer(at, json.loads(position)):
                continue
            if marks[name] is not None and not _newer(at, marks[name]):
                image = None
            self.images.updateValue((whole,), (json.dumps(at), image))
            if image != old:
                out.extend((w, x) for w, x in ((-1, old), (1, image)) if x is not None)
        yield pd.DataFrame({"weight": pd.array([w for w, _ in out], "int32"), "image": pd.array([x for _, x in out], object)})

    def close(self) -> None:
        pass


def retractions(
    changes: DataFrame, keys: list[str], position: list[str], table_col: str = "source_table",
    op_col: str = "cdc_op", buckets: int = 256,
) -> DataFrame:
    """Decoded changes as rows with a ``weight``: +1 for a row that is now there, -1 for one that no longer is.

    The weights of all rows so far add up to the table's contents, so sums and
    counts downstream follow updates, deletes and truncates. Changes that are
    not newer than what their key has, by ``position`` part by part, return
    nothing, so order of arrival and repetition play no part. Keys are dealt to
    ``buckets``, a truncate goes to all of them. Changes without a key are left
    out. State holds one image for each key, as the table does.
    """
    image_type = changes.schema["after"].dataType
    truncate = F.col(op_col) == OP_TRUNCATE
    own = F.when(~truncate, F.to_json(F.array(*[key_image(k).cast("string") for k in keys])))
    known = F.when(truncate, F.lit(True)).otherwise(F.coalesce(*[key_image(k).cast("string") for k in keys]).isNotNull())
    packed = changes.where(F.col(op_col).isNotNull() & known).select(
        F.coalesce(F.col(table_col).cast("string"), F.lit("")).alias("name"), own.alias("own"), F.col(op_col).alias("op"),
        F.to_json(F.array(*[F.col(c).cast("long") for c in position])).alias("position"),
        F.to_json("after", JSON_OPTIONS).alias("image"))
    every = F.sequence(F.lit(0), F.lit(buckets - 1))
    dealt = packed.withColumn("bucket", F.explode(F.when(F.col("op") == OP_TRUNCATE, every).otherwise(
        F.array(F.pmod(F.xxhash64("name", "own"), F.lit(buckets)).cast("int")))))
    moved = dealt.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=Images(), outputStructType="weight int, image string", outputMode="Update", timeMode="None")
    return moved.select("weight", F.from_json("image", image_type, JSON_OPTIONS).alias("row")).select("weight", "row.*")


def weighted_sums(
    path: str, keys: list[str], sums: dict[str, Column],
):
    """Callback that stores each micro-batch's sums by ``keys``: ``rows`` (of the weights) and the named values times their weight.

    Sums of sums are the totals, so nothing stored is ever changed; a batch that
    runs again replaces its own part.
    """
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        weight = F.col("weight")
        part = batch.groupBy(*keys).agg(F.sum(weight).alias("rows"), *[F.sum(value * weight).alias(name) for name, value in sums.items()])
        overwrite_partitions(part.withColumn("batch_id", F.lit(batch_id).cast("long")), path, ["batch_id"])

    return on_batch


def totals(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Stored sums folded over all batches; groups that have no row left are gone."""
    names = [c for c in parts.columns if c not in (*keys, "batch_id")]
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in names]).where("rows > 0")
