"""State of a bucket of keys in few large values, as every call to the state store costs more than a row."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

PART_ROWS = 1_000  # of one value of waiting rows
READ_ROWS = 20_000  # of one table that ``take`` returns
BUCKETS = 512


def bucket_of(*keys: Column, buckets: int = BUCKETS) -> Column:
    """Keys are dealt to buckets, each a group of its own in the state; a key has one bucket."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def pack(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack(held) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(held)).read_all().to_pandas()


class Waiting:
    """Rows with a time ``us``, in parts that are each stored under the time they begin with.

    Only parts that begin before the limit are read. What is left of a part goes back.
    """

    def __init__(self, handle):
        self.parts = handle.getMapState("waiting", "us long, number long", "rows binary")

    def add(self, rows: pd.DataFrame) -> None:
        rows = rows.sort_values("us", kind="stable", ignore_index=True)
        for start in range(0, len(rows), PART_ROWS):
            part = rows.iloc[start:start + PART_ROWS]
            first, number = int(part["us"].iloc[0]), 0
            while self.parts.containsKey((first, number)):
                number += 1
            self.parts.updateValue((first, number), (pack(part),))

    def take(self, limit: int) -> Iterator[pd.DataFrame]:
        """Rows with a time below ``limit``, which are then no longer held."""
        taken, n = [], 0
        for key in sorted(k for k in self.parts.keys() if k[0] < limit):
            part = unpack(self.parts.getValue(key)[0])
            self.parts.removeKey(key)
            due = part["us"] < limit
            if not due.all():
                self.add(part[~due])
                part = part[due]
            taken.append(part)
            n += len(part)
            if n >= READ_ROWS:
                yield pd.concat(taken, ignore_index=True)
                taken, n = [], 0
        if taken:
            yield pd.concat(taken, ignore_index=True)

    def first(self) -> int | None:
        return min((us for us, _ in self.parts.keys()), default=None)


class Wake:
    """The one timer of a group: a later time never replaces an earlier one."""

    def __init__(self, handle):
        self.handle, self.at = handle, handle.getValueState("wake", "ms long")

    def by(self, us: int) -> None:
        ms, held = -(-us // 1000), self.at.get()[0] if self.at.exists() else None
        if held is None or ms < held:
            if held is not None:
                self.handle.deleteTimer(held)
            self.handle.registerTimer(ms)
            self.at.update((ms,))

    def woken(self) -> None:
        self.at.clear()
