"""Duplicates and late rows, batch side.

``first_per_window`` keeps a row of a key when its time is at least ``window``
after the last kept row of that key. That rule is a chain: whether a row is kept
depends on the previous kept row. To keep a hot key out of a single task the
time line is cut into chunks several windows long:

1. per (key, chunk), in parallel: for every row that could be the first one kept
   in the chunk, which row would be the last one kept there;
2. per (key, group of chunks), in parallel: compose the summaries of neighbouring
   chunks to one of the group; chains that met are one from there on, so few are
   left;
3. per key: follow the groups' summaries, then, again per group in parallel, the
   chunks' summaries, which gives the last kept time at the entry of each chunk;
4. per (key, chunk), in parallel: keep rows, given that entry time.

Steps 1 and 4 read sorted Arrow batches and hold only one chunk's chain ends,
never the chunk. What a key brings to one task is a few rows for each group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.functions.durations import micros
from eventlake.operators.metrics import counted_summary, value_counts

_NEVER = -(2 ** 62)


class _SortedGroups:
    """Times of many groups in one sorted line, so one search serves all groups.

    ``group`` numbers the groups of a batch from zero. Each group owns a stretch
    of the line as long as the batch's time span; a time beyond the group's rows
    lands at the end of its stretch.
    """

    def __init__(self, group: np.ndarray, times: np.ndarray):
        self.group, self.times = group, times
        self.base = int(times.min()) if len(times) else 0
        self.span = int(times.max()) - self.base + 2 if len(times) else 2
        self.line = group * self.span + (times - self.base)

    def first_at_or_after(self, group: np.ndarray, at: np.ndarray):
        """(row, found): first row of each given group whose time is not before ``at``."""
        offset = np.clip(at - self.base, 0, self.span - 1)
        row = np.searchsorted(self.line, group * self.span + offset)
        found = row < len(self.line)
        found[found] = self.group[row[found]] == group[found]
        return row, found


def _short(batches):
    """Batches cut so that groups times time span fits the sorted line's integers."""
    for batch in batches:
        waiting = [batch] if batch.num_rows else []
        while waiting:
            part = waiting.pop()
            times = part.column("__us").to_numpy()
            times = times[times != _NEVER]
            span = int(times.max()) - int(times.min()) + 2 if len(times) else 0
            if part.num_rows > 1 and part.num_rows * span >= 2 ** 62:
                half = part.num_rows // 2
                waiting += [part.slice(half), part.slice(0, half)]
            else:
                yield part


def _numbered(column) -> tuple[np.ndarray, list]:
    """Running group number of each row, and the group ids, of a sorted column."""
    runs = pc.run_end_encode(column)
    ends = runs.run_ends.to_numpy()
    number = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    return number, runs.values.to_pylist()


def _chunk_summaries(window: int):
    """(group, entry, last): entering at or before ``entry`` keeps ``last`` as last row."""
    empty = np.empty(0, np.int64)

    def table(ids, group, entry, last):
        return pa.RecordBatch.from_pydict({
            "__group": pa.array([ids[g] for g in group.tolist()], pa.string()),
            "entry_us": pa.array(entry, pa.int64()), "last_us": pa.array(last, pa.int64()),
        })

    def run(batches):
        # The last group of a batch may go on in the next one.
        open_id, seen_after, last, entry = None, False, empty, empty
        for batch in _short(batches):
            number, ids = _numbered(batch.column("__group"))
            times = batch.column("__us").to_numpy()
            closes = batch.column("__start").to_numpy() + window
            if open_id is not None and ids[0] != open_id:
                yield table([open_id], np.zeros(len(last), np.int64), entry, last)
                open_id = None
            if open_id is None:
                seen_after, last, entry = False, empty, empty
            rows = _SortedGroups(number, times)
            # Possible first rows of a chunk: all in its first window, and the
            # first one after it.
            first = times < closes
            groups = np.arange(len(ids))
            heads = np.searchsorted(number, groups)
            after, found = rows.first_at_or_after(groups, closes[heads])
            found[0] &= not seen_after
            first[after[found]] = True
            # Of rows at the same time one is enough.
            first[1:] &= (number[1:] != number[:-1]) | (times[1:] != times[:-1])
            chain = np.append(np.zeros(len(last), np.int64), number[first])
            last, entry = np.append(last, times[first]), np.append(entry, times[first])
            while len(chain):
                row, moving = rows.first_at_or_after(chain, last + window)
                if not moving.any():
                    break
                last = last.copy()
                last[moving] = times[row[moving]]
                # Chains that met are one from here on; the latest entry speaks for it.
                keep = np.append((last[1:] != last[:-1]) | (chain[1:] != chain[:-1]), True)
                chain, last, entry = chain[keep], last[keep], entry[keep]
            final = len(ids) - 1
            seen_after = bool(found[final]) or (seen_after and final == 0)
            ended = chain < final
            yield table(ids, chain[ended], entry[ended], last[ended])
            open_id, last, entry = ids[final], last[~ended], entry[~ended]
        if open_id is not None:
            yield table([open_id], np.zeros(len(last), np.int64), entry, last)

    return run


def _whole_groups(batches, names: tuple[str, ...]):
    """Tables with all rows of one or more groups, from batches sorted by the columns ``names``."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        last = [held.column(c)[-1].as_py() for c in names]
        same = np.ones(held.num_rows, bool)
        for c, value in zip(names, last):
            same &= pc.equal(held.column(c), value).to_numpy()
        upto = int(np.argmax(same))
        if upto:
            yield held.slice(0, upto)
            held = held.slice(upto)
    if held is not None and held.num_rows:
        yield held


def _bounds(table: pa.Table, names: tuple[str, ...]) -> np.ndarray:
    """Where each group of a sorted table begins, and the end."""
    new = np.zeros(table.num_rows, bool)
    for c in names:
        column = table.column(c).combine_chunks()
        new[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    new[0] = True
    return np.append(np.flatnonzero(new), table.num_rows)


def _compose(first, second, window: int, edge: int):
    """Summary of two neighbouring stretches: (entries, last) pairs of arrays.

    Nothing enters the first stretch later than ``edge``, so what enters the second one
    without keeping a row in the first matters only where the first ends before that.
    """
    (entry, last), (next_entry, next_last) = first, second
    at = np.searchsorted(next_entry, last + window)
    goes_on = at < len(next_entry)
    last = np.where(goes_on, next_last[np.minimum(at, len(next_last) - 1)], last)
    if not len(entry) or entry[-1] < edge:
        entry, last = np.append(entry, next_entry), np.append(last, next_last)
    keep = np.append(last[1:] != last[:-1], True)
    return entry[keep], last[keep]


_KEY, _CHUNK = ("key_id", "stretch"), ("key_id", "stretch", "number")


def _composed(window: int):
    """(key, stretch, entry, last): the summaries of a stretch's chunks composed to one."""

    def run(batches):
        for table in _whole_groups(batches, _KEY):
            entry, last, edge = (table.column(c).to_numpy() for c in ("entry_us", "last_us", "edge_us"))
            groups, chunks = _bounds(table, _KEY), _bounds(table, _CHUNK)
            where, entries, lasts = [], [], []
            for low, high in zip(groups[:-1], groups[1:]):
                cuts = chunks[np.searchsorted(chunks, low):np.searchsorted(chunks, high) + 1]
                one = entry[low:cuts[1]], last[low:cuts[1]]
                for x, y in zip(cuts[1:-1], cuts[2:]):
                    one = _compose(one, (entry[x:y], last[x:y]), window, int(edge[low]))
                where.append(np.full(len(one[0]), low))
                entries.append(one[0])
                lasts.append(one[1])
            rows = table.take(pa.array(np.concatenate(where))).select(["key_id", "stretch"])
            yield from pa.Table.from_arrays(
                [*rows.columns, pa.array(np.concatenate(entries)), pa.array(np.concatenate(lasts))],
                ["key_id", "stretch", "entry_us", "last_us"]).to_batches()

    return run


def _followed(window: int, outer: tuple[str, ...], inner: tuple[str, ...]):
    """(inner columns, last_us): last kept time before each unit of a group, following the units' summaries.

    A group may begin with a row that has no summary (``entry_us`` is the
    mark): the last kept time the group is entered with.
    """

    def run(batches):
        for table in _whole_groups(batches, outer):
            entry, last = table.column("entry_us").to_numpy(), table.column("last_us").to_numpy()
            groups, units = _bounds(table, outer), _bounds(table, inner)
            where, before = [], []
            for low, high in zip(groups[:-1], groups[1:]):
                now = _NEVER
                cuts = units[np.searchsorted(units, low):np.searchsorted(units, high) + 1]
                for x, y in zip(cuts[:-1], cuts[1:]):
                    if entry[x] == _NEVER:
                        now = int(last[x])
                        continue
                    where.append(x)
                    before.append(now)
                    at = x + int(np.searchsorted(entry[x:y], now + window))
                    if at < y:
                        now = int(last[at])
            rows = table.take(pa.array(where, pa.int64())).select(list(inner))
            yield from pa.Table.from_arrays(
                [*rows.columns, pa.array(before, pa.int64())], [*inner, "last_us"]).to_batches()

    return run


def _keep_rows(window: int):
    """Kept rows of each chunk; the chunk's entry mark is its first row."""

    def run(batches):
        open_id, last = None, _NEVER
        for batch in _short(batches):
            number, ids = _numbered(batch.column("__group"))
            times = batch.column("__us").to_numpy()
            mark = times == _NEVER
            # Last kept time of every group so far: from its mark, or from the
            # batch before.
            known = np.full(len(ids), _NEVER, np.int64)
            known[number[mark]] = batch.column("__entry").to_numpy()[mark]
            if ids[0] == open_id:
                known[0] = last
            where = np.flatnonzero(~mark)
            rows = _SortedGroups(number[where], times[where])
            groups = np.arange(len(ids))
            row, found = rows.first_at_or_after(groups, known + window)
            kept = []
            while found.any():
                row = row[found]
                kept.append(row)
                known[rows.group[row]] = rows.times[row]
                row, found = rows.first_at_or_after(rows.group[row], rows.times[row] + window)
            open_id, last = ids[-1], known[-1]
            keep = np.sort(where[np.concatenate(kept)]) if kept else np.empty(0, np.int64)
            yield batch.drop_columns(["__group", "__us", "__entry"]).take(
                pa.array(keep, pa.int64())
            )

    return run


def first_per_window(
    df: DataFrame, key: str, time_col: str, window: str = "1 hour",
    tie_cols: list[str] | None = None, windows_per_chunk: int = 24, chunks_per_stretch: int = 64,
) -> DataFrame:
    """First row of each key, then each first row at least ``window`` after the last kept.

    Among rows of one instant the lowest ``tie_cols`` wins; rows without key or
    time are dropped. Columns come back as they were.
    """
    width = micros(window)
    chunk = width * windows_per_chunk
    order = [
        F.to_json(F.struct(c)) if "map<" in df.schema[c].dataType.simpleString() else F.col(c)
        for c in tie_cols or [c for c in df.columns if c not in (key, time_col)]
    ]
    us = F.unix_micros(time_col)
    number = F.floor(us / F.lit(chunk))
    key_id = F.col(key).cast("string")
    rows = df.where(F.col(key).isNotNull() & F.col(time_col).isNotNull()).select(
        F.concat_ws("@", number.cast("string"), key_id).alias("__group"),
        us.alias("__us"), *df.columns,
    )
    start_us = F.floor(F.col("__us") / F.lit(chunk)) * chunk
    sorted_times = (
        rows.select("__group", start_us.alias("__start"), "__us")
        .repartition("__group").sortWithinPartitions("__group", "__us")
    )
    summaries = sorted_times.mapInArrow(
        _chunk_summaries(width), "__group string, entry_us long, last_us long"
    )
    number_of = F.substring_index("__group", "@", 1).cast("long")
    stretch = F.floor(F.col("number") / F.lit(chunks_per_stretch))
    summaries = summaries.select(
        F.expr("substring(__group, instr(__group, '@') + 1)").alias("key_id"),
        number_of.alias("number"), "entry_us", "last_us",
    ).select("key_id", stretch.alias("stretch"), "number", "entry_us", "last_us")
    edge = F.col("stretch") * (chunk * chunks_per_stretch) + width
    composed = (
        summaries.withColumn("edge_us", edge)
        .repartition("key_id", "stretch").sortWithinPartitions("key_id", "stretch", "number", "entry_us")
        .mapInArrow(_composed(width), "key_id string, stretch long, entry_us long, last_us long")
    )
    entered = (
        composed.repartition("key_id").sortWithinPartitions("key_id", "stretch", "entry_us")
        .mapInArrow(_followed(width, ("key_id",), _KEY), "key_id string, stretch long, last_us long")
    )
    opening = entered.select(
        "key_id", "stretch", (F.col("stretch") * chunks_per_stretch - 1).alias("number"),
        F.lit(_NEVER).alias("entry_us"), "last_us",
    )
    entries = (
        summaries.unionByName(opening)
        .repartition("key_id", "stretch").sortWithinPartitions("key_id", "stretch", "number", "entry_us")
        .mapInArrow(_followed(width, _KEY, _CHUNK), "key_id string, stretch long, number long, last_us long")
        .select(F.concat_ws("@", F.col("number").cast("string"), "key_id").alias("__group"), "last_us")
    )
    marks = entries.select(
        "__group", F.lit(_NEVER).alias("__us"), F.col("last_us").alias("__entry")
    )
    kept = (
        rows.withColumn("__entry", F.lit(0).cast("long"))
        .unionByName(marks, allowMissingColumns=True)
        .repartition("__group").sortWithinPartitions("__group", "__us", *order)
    )
    out = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
    return kept.mapInArrow(_keep_rows(width), out)


def dedup_within_watermark(
    df: DataFrame, keys: list[str], time_col: str, window: str = "1 hour"
) -> DataFrame:
    """Built-in streaming dedup: at least all repeats within ``window`` are dropped."""
    return df.withWatermark(time_col, window).dropDuplicatesWithinWatermark(keys)


def with_lateness(
    df: DataFrame, time_col: str, partition_col: str, arrival_cols: list[str],
    allowed: str = "1 hour", chunk_rows: int = 100_000,
) -> DataFrame:
    """Rows with ``max_seen`` (latest event time that arrived earlier) and ``is_late``.

    Arrival order is per source partition, the first arrival column being a
    number such as the offset. The running maximum is split into chunks of
    ``chunk_rows`` positions: chunk maxima, combined on the map side, are carried
    forward per partition, and the rows of each chunk are ordered on their own,
    so a partition holding a third of all rows is spread over many tasks.
    """
    first = arrival_cols[0]
    rows = df.withColumn("__chunk", F.floor(F.col(first) / F.lit(chunk_rows)))
    maxima = rows.groupBy(partition_col, "__chunk").agg(F.max(time_col).alias("__top"))
    earlier = Window.partitionBy(partition_col).orderBy("__chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = maxima.select(
        partition_col, "__chunk", F.max("__top").over(earlier).alias("max_seen"),
    ).where("max_seen is not null")
    in_chunk = Window.partitionBy(partition_col, "__chunk").orderBy(
        F.col("__mark").desc(), *arrival_cols
    ).rowsBetween(Window.unboundedPreceding, -1)
    # The carried maximum enters each chunk as its first row: no join needed.
    line = rows.withColumn("__mark", F.lit(0)).withColumn("__top", F.col(time_col)).unionByName(
        carried.select(
            partition_col, "__chunk", F.lit(1).alias("__mark"), F.col("max_seen").alias("__top")
        ),
        allowMissingColumns=True,
    )
    seen = line.withColumn("max_seen", F.max("__top").over(in_chunk)).where("__mark = 0")
    late = F.col(time_col) < F.col("max_seen") - F.expr(f"INTERVAL {allowed}")
    return seen.withColumn("is_late", F.coalesce(late, F.lit(False))).drop(
        "__chunk", "__mark", "__top"
    )


def out_of_orderness(
    df: DataFrame, time_col: str, partition_col: str, arrival_cols: list[str],
    percentiles: tuple[float, ...] = (0.5, 0.95, 0.99),
) -> DataFrame:
    """How far rows lag behind the latest event time seen, per source partition.

    The high percentiles, exact at any number of rows, are the watermark delay the source needs.
    """
    lateness = with_lateness(df, time_col, partition_col, arrival_cols)
    behind = F.greatest(
        F.unix_micros("max_seen") - F.unix_micros(time_col), F.lit(0)
    )
    behind_ms = F.coalesce((behind / 1000).cast("long"), F.lit(0))
    counts = value_counts(lateness.withColumn("__ms", behind_ms), [partition_col], "__ms")
    rows = counted_summary(
        counts, [partition_col], "__ms", percentiles, F.sum("n").alias("row_count"),
        F.sum(F.when(F.col("__ms") > 0, F.col("n")).otherwise(0)).alias("out_of_order"), F.max("__ms").alias("max_ms"),
        width=60_000)
    return rows.select(partition_col, "row_count", "out_of_order", *[f"p{round(p * 100)}_ms" for p in percentiles], "max_ms")
