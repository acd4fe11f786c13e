"""Near-duplicate documents by b-bit MinHash.

A document's set holds the hashes of its word shingles. Equal sets, by a
128-bit digest of the whole set, form classes, and each class goes on as one
representative, named by half of its digest. Minima of ``BANDS`` x
``ROWS`` hash functions, and of some more, are taken; bands of whole minima give candidate
buckets, and only the low ``BITS`` bits of all minima are kept, packed into
words, to estimate the similarity of a candidate pair by counting bits. What
the estimate doesn't rule out is confirmed on the full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.components import components
from eventlake.llm.tables import perhaps_among, stored
from eventlake.llm.text import LOWER, Block, Hasher, blocks, distinct, mix, shingles, views, words

# A pair of similarity 0.8 misses all bands with probability (1 - 0.8^6)^45 = 1.2e-6.
BANDS, ROWS, BITS = 45, 6, 2
FUNCTIONS = 1440  # whose low bits are kept; the first BANDS * ROWS make the bands
# 4.5 standard deviations of the estimate at similarity 0.8: sqrt(0.85 * 0.15 / 1440) / 0.75 * 4.5, missed with 3.4e-6.
# That holds for sets of any size, as the kept bits of each function are mixed on their own (``kept_bits``).
MARGIN = 0.057
CELL_ROWS = 1500  # of one bucket that meet in one task


def shingle_sets(block: Block, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted, and the rows' bounds; fewer words than ``size`` make one shingle."""
    lowered = block._replace(data=LOWER[block.data])
    found = words(lowered)
    by_word = Hasher(lowered.data)(found.starts, found.ends)
    keys, at = shingles(by_word, found.bounds, size)
    owner = found.row[at] if len(at) else np.empty(0, np.int64)
    n_words = np.diff(found.bounds)
    for k in range(1, size):  # rows of exactly k words: the whole sequence
        short = np.flatnonzero(n_words == k)
        if len(short):
            whole, _ = shingles(by_word[(found.bounds[short][:, None] + np.arange(k)).ravel()], np.arange(len(short) + 1) * k, k)
            keys, owner = np.concatenate([keys, whole ^ np.uint64(k)]), np.concatenate([owner, short])
    return distinct(keys, owner, block.n)


def _functions() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    return rng.integers(0, 1 << 32, FUNCTIONS, dtype=np.uint32), rng.integers(0, 1 << 31, FUNCTIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def minima(keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Minimum of each hash function over each non-empty set: (sets x functions) of 32 bits."""
    folded = (keys >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(bounds) - 1, FUNCTIONS), np.uint32)
    for k, (flip, factor) in enumerate(zip(*_functions(), strict=True)):
        out[:, k] = np.minimum.reduceat((folded ^ flip) * factor, bounds[:-1])
    return out


def band_keys(low: np.ndarray) -> np.ndarray:
    """One 64-bit bucket for each band: its minima and its number."""
    grouped = low[:, :BANDS * ROWS].reshape(len(low), BANDS, ROWS).astype(np.uint64)
    keys = np.arange(BANDS, dtype=np.uint64)[None] * np.uint64(0x9E3779B97F4A7C15)
    for k in range(ROWS):
        keys = mix(keys + grouped[:, :, k])
    return keys.view(np.int64)


def kept_bits(low: np.ndarray) -> np.ndarray:
    """Minima after a mix of each function's own, so that different minima agree in their low bits by chance alone.

    The low bits of the minima themselves would do so for all functions alike:
    an odd factor leaves them a fixed image of the low bits of the shingle.
    """
    x = low ^ np.random.default_rng(21).integers(0, 1 << 32, low.shape[1], dtype=np.uint32)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        x ^= x >> np.uint32(shift)
        x *= np.uint32(factor)
    return x ^ (x >> np.uint32(16))


def packed_bits(low: np.ndarray) -> np.ndarray:
    """The low ``BITS`` of ``kept_bits`` of all minima as 64-bit words, one plane of words for each bit."""
    low = kept_bits(low)
    planes = []
    for bit in range(BITS):
        bits = ((low >> np.uint32(bit)) & 1).astype(np.uint8)
        packed = np.packbits(bits, axis=1)
        padded = np.zeros((len(low), -(-packed.shape[1] // 8) * 8), np.uint8)
        padded[:, :packed.shape[1]] = packed
        planes.append(padded.view(np.int64))
    return np.concatenate(planes, axis=1)


def estimate(a: Column, b: Column) -> Column:
    """Similarity of two packed signatures, corrected for low bits that agree by chance."""
    n, words_each = FUNCTIONS, -(-FUNCTIONS // 64)
    differing = sum((F.bit_count(_any_bit(a, b, k, words_each)) for k in range(words_each)), F.lit(0))
    chance = 1 / (1 << BITS)
    return ((1 - differing / n) - chance) / (1 - chance)


def _any_bit(a: Column, b: Column, k: int, words_each: int) -> Column:
    out = F.lit(0).cast("long")
    for bit in range(BITS):
        out = out.bitwiseOR(a[bit * words_each + k].bitwiseXOR(b[bit * words_each + k]))
    return out


def _digests(keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """128 bits of each whole sorted set, as two numbers."""
    raw = keys.tobytes()
    whole = b"".join(hashlib.blake2b(raw[8 * a:8 * b], digest_size=16).digest() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
    return np.frombuffer(whole, "<i8").reshape(-1, 2)


def _profiles(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                keys, bounds = shingle_sets(block, size)
                n = np.diff(bounds)
                full = np.flatnonzero(n > 0)
                digests = _digests(keys, bounds)
                bands, bits = [None] * block.n, [None] * block.n
                if len(full):
                    tight = np.append(bounds[full], len(keys))
                    low = minima(keys, tight)
                    for i, x, y in zip(full, band_keys(low).tolist(), packed_bits(low).tolist(), strict=True):
                        bands[i], bits[i] = x, y
                part = batch.column(0).slice(block.first, block.n)
                yield pa.RecordBatch.from_arrays(
                    [part, batch.column(2).slice(block.first, block.n), pa.array(n.astype(np.int64)), *(pa.array(np.ascontiguousarray(x)) for x in digests.T), pa.array(bands, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))],
                    ["id", "text_hash", "n", "f1", "f2", "bands", "bits"])
    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                keys, bounds = shingle_sets(block, size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(_digests(keys, bounds)[:, 0])),
                     pa.array([keys[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())], ["id", "items"])
    return run


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(views(batch.column(2)), views(batch.column(3)), strict=True):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _across(percent: int):
    """Pairs of different components in sorted cells of buckets, each pair in the first band that its two share."""
    cut = 1 - (percent / 100 - MARGIN)
    chance = 1 / (1 << BITS)
    most = FUNCTIONS * (1 - chance) * cut  # differing places

    def pairs(cell: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids, component, n = (cell.column(c).to_numpy() for c in ("id", "component", "n"))
        if len(ids) < 2 or (component == component[0]).all():
            return ids[:0], ids[:0]
        bits = np.array(cell.column("bits").to_pylist(), np.int64).view(np.uint64).reshape(len(ids), BITS, -1)
        bands = np.array(cell.column("bands").to_pylist(), np.int64)
        bucket, out = cell.column("bucket")[0].as_py(), []
        for i in range(len(ids) - 1):
            rest = np.arange(i + 1, len(ids))
            near = (component[rest] != component[i]) & (100 * np.minimum(n[rest], n[i]) >= percent * np.maximum(n[rest], n[i]))
            rest = rest[near]
            if len(rest):
                apart = np.bitwise_or.reduce(bits[rest] ^ bits[i], axis=1)
                rest = rest[np.bitwise_count(apart).sum(1) <= most]
            if len(rest):
                first = bands[i][(bands[rest] == bands[i]).argmax(1)]
                out.extend((ids[i], ids[j]) for j in rest[first == bucket])
        a, b = (np.array(x, np.int64) for x in zip(*out, strict=True)) if out else (ids[:0], ids[:0])
        return np.minimum(a, b), np.maximum(a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            where = np.stack([held.column(c).to_numpy() for c in ("bucket", "cell")], axis=1)
            starts = np.concatenate([[0], np.flatnonzero((where[1:] != where[:-1]).any(1)) + 1])
            for low, high in zip(starts[:-1], starts[1:], strict=True):
                if high - low > 1:
                    a, b = pairs(held.slice(low, high - low))
                    if len(a):
                        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
            held = held.slice(starts[-1])
        if held is not None:
            a, b = pairs(held)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def near_duplicates(rows: DataFrame, size: int = 5, percent: int = 80, stars: int = 2, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Component of each document under links of ``percent`` similarity or more.

    ``rows`` has ``id`` (long) and ``text``. Returns ``id``, ``n_shingles`` and
    ``component_id``, the smallest id that links reach, for each row. Null,
    empty and wordless texts have an empty set and stay alone. Rows that share
    an id but not a text each have their own set and links. A row without an id
    takes the component of an equal set, if any.

    Copies are never expanded into pairs. A bucket's hub is its member with the
    most company over all its buckets, which in a group of copies is the text
    they were made from. Each representative is compared with the
    hub it resembles most, and what is linked becomes one component. ``stars`` such rounds
    are made, the later ones with any other hub. Only buckets that
    still hold several components have the pairs across components compared, in cells of ``cell_rows``, so
    every link that the bands see is confirmed or refuted unless its ends are in
    one component anyway.
    """
    return _grouped(rows, size, percent, stars, cell_rows).select("id", F.col("n").alias("n_shingles"), "component_id")


def _grouped(rows: DataFrame, size: int, percent: int, stars: int, cell_rows: int) -> DataFrame:
    """``id``, ``text_hash``, ``n``, ``component`` (null if the set is empty) and ``component_id`` of each row. Within, an id is that of a class: half of its digest."""
    text = F.col("text").cast("string")
    texts = rows.select(F.col("id").cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    profiles = stored(texts.mapInArrow(
        _profiles(size), "id long, text_hash long, n long, f1 long, f2 long, bands array<long>, bits array<long>"), "profiles")
    filled = profiles.where("n > 0 and id is not null")
    classes = stored(filled.groupBy("f1", "f2", "n").agg(F.min("id").alias("rep")), "classes")
    ids_repeat = not filled.groupBy("id").agg(F.count("*").alias("rows")).where("rows > 1").isEmpty()
    one_of = classes.select(F.col("rep").alias("id"), "f1", "f2", "n")
    reps = filled.join(one_of, ["id", "f1", "f2", "n"], "left_semi").select(F.col("f1").alias("id"), "n", "bands", "bits").dropDuplicates(["id"])
    reps = stored(reps, "representatives")
    members = reps.select("id", F.explode("bands").alias("bucket"))
    busy = members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = stored(members.join(busy, "bucket"), "bucket-members")
    company = members.groupBy("id").agg(F.sum("size").alias("company"))
    members = stored(members.select("id", "bucket").join(company, "id"), "bucket-company")
    signatures = reps.select("id", "n", "bits")

    def plausible(pairs: DataFrame) -> DataFrame:
        """Pairs a < b, once each, with their estimate, unless sizes or bits rule them out."""
        left, right = (signatures.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("bits").alias(f"bits_{s}")) for s in "ab")
        met = pairs.distinct().join(left, "a").join(right, "b")
        met = met.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
        return met.select("a", "b", estimate(F.col("bits_a"), F.col("bits_b")).alias("alike")).where(F.col("alike") >= percent / 100 - MARGIN)

    def confirmed(pairs: DataFrame, purpose: str) -> DataFrame:
        pairs = stored(pairs, purpose)
        needed = pairs.select(F.col("a").alias("f1")).union(pairs.select("b")).distinct()
        wanted = classes.join(needed, "f1", "left_semi").select(F.col("rep").alias("id")).distinct()
        asked = perhaps_among(texts, wanted, "id").join(wanted, "id", "left_semi")
        if ids_repeat:  # else texts need not be shuffled for it; an id may still have several texts of one set
            asked = asked.dropDuplicates(["id", "text_hash"])
        sets = stored(asked.select("id", "text").mapInArrow(_sets(size), "id long, items binary"), "sets")
        both = pairs.join(sets.select(F.col("id").alias("a"), F.col("items").alias("x")), "a").join(
            sets.select(F.col("id").alias("b"), F.col("items").alias("y")), "b").select("a", "b", "x", "y")
        return stored(both.mapInArrow(_linked(percent), "a long, b long"), "links")

    links = None
    labels = reps.select("id", F.col("id").alias("component"))
    for turn in range(stars):
        labelled = members.join(labels, "id") if turn else members.withColumn("component", F.col("id"))
        rank = F.col("company") if turn == 0 else F.xxhash64("id", F.lit(turn))
        hubs = labelled.groupBy("bucket").agg(F.max(F.struct(rank, "component", "id")).alias("hub"))
        spokes = labelled.join(hubs, "bucket").where(F.col("component") != F.col("hub.component")).select(
            F.least("id", "hub.id").alias("a"), F.greatest("id", "hub.id").alias("b"), "id")
        met = plausible(spokes.select("a", "b"))
        best = spokes.distinct().join(met, ["a", "b"]).groupBy("id").agg(F.max(F.struct("alike", "a", "b")).alias("m"))
        found = confirmed(best.select("m.a", "m.b").distinct(), f"star-{turn}")
        links = found if links is None else links.union(found)
        labels = stored(components(reps.select("id"), links), "labels")
    labelled = members.join(labels, "id")
    split = labelled.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size")).where("low < high")
    # A large bucket is dealt into parts, and every two parts meet in a cell of their own.
    parts = F.ceil(F.col("size") / cell_rows).cast("long")
    part = F.pmod(F.xxhash64("id", F.lit(5)), F.col("parts"))
    open_members = labelled.select("id", "bucket", "component").join(split.select("bucket", parts.alias("parts")), "bucket")
    open_members = open_members.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    cells = open_members.select("id", "bucket", "component", (F.least("part", "other") * F.col("parts") + F.greatest("part", "other")).alias("cell"))
    full = cells.join(reps.select("id", "n", "bits", "bands"), "id").repartition("bucket", "cell").sortWithinPartitions("bucket", "cell", "id")
    across = full.select("bucket", "cell", "id", "component", "n", "bits", "bands").mapInArrow(_across(percent), "a long, b long").distinct()
    links = links.union(confirmed(across, "across"))
    labels = stored(components(reps.select("id"), links), "labels")
    joined = stored(classes.join(labels.withColumnRenamed("id", "f1"), "f1"), "class-components")
    least = joined.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_class = joined.join(least, "component").select("f1", "f2", "n", "component", "component_id")
    return profiles.join(by_class, ["f1", "f2", "n"], "left").select("id", "text_hash", "n", "component", F.coalesce("component_id", "id").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Keeps the document with the smallest id of each component, with the columns of ``docs``.

    Of rows that share id and text, one stays. Of rows that share an id with
    different texts in one component, the one whose text has the smallest hash
    stays; in different components all stay. Empty texts stay, one for each id.
    Rows without an id are kept as they are.
    """
    id_, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string")
    known = docs.where(id_.isNotNull())
    found = _grouped(known.select(id_.alias("id"), text.alias("text")), size, percent, 2, CELL_ROWS)
    best = found.where("id = component_id").groupBy("id", "component").agg(F.min("text_hash").alias("__hash"))
    best = best.select(F.col("id").alias("__id"), "__hash").distinct()
    marked = known.withColumn("__id", id_.cast("long")).withColumn("__hash", F.xxhash64(text))
    kept = marked.join(best, ["__id", "__hash"], "left_semi").dropDuplicates(["__id", "__hash"])
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return kept.select(*columns).union(docs.where(id_.isNull()).select(*columns))
