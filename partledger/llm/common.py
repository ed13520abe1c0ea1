"""Text as flat byte arrays inside Arrow batches, hashes, and small Spark helpers shared by the operators."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from partledger.session import checkpointed, ship_package

SLICE_BYTES = 1 << 20  # texts are worked on in runs of about this many bytes, which stay in the CPU's cache
BATCH_ROWS = 2000
MAP_BITS = 1 << 26
MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D  # odd, hence invertible modulo 2**64
_BYTE = np.random.default_rng(20240607).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def start(spark: SparkSession) -> None:
    """Make the package importable in the Python workers, and keep Arrow batches of whole texts small.

    Shuffle files of a query that has ended go at once: every table that is read again is a written one.
    """
    ship_package(spark)
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of an Arrow column, one after the other, and the offset of each; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    if len(column) == 0 or places is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Cut rows into runs of about ``limit`` bytes; a longer text is a run of its own."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(rows, max(first + 1, last))
        yield first, last
        first = last


def mixed(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the finalizer of splitmix64)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) <= size:
        wanted = 1 << max(size, 1 << 16).bit_length()
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            factors = np.full(wanted, base, np.uint64)
            factors[0] = 1
            _powers[k] = np.multiply.accumulate(factors)
    return _powers[0], _powers[1]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all runs of bytes other than white space; no run crosses two texts."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True  # of a text
    now, before = inside[1:], inside[:-1]
    starts = np.flatnonzero(now & (~before | first))
    ends = np.flatnonzero(before & (~now | first))
    return starts, ends


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span, from one running polynomial over all bytes."""
    power, inverse = _power_tables(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[: len(data)], out=total[1:])
    value = (total[ends] - total[starts]) * inverse[starts]
    return mixed(value + (ends - starts).astype(np.uint64) * MIX)


def word_counts(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Offsets of each text's words among all words."""
    return np.searchsorted(starts, offsets)


def running_total(df: DataFrame, order: Sequence[str], amount: str, name: str, parts: int | None = None) -> DataFrame:
    """Add ``name``: the sum of ``amount`` over all earlier rows along ``order`` (nulls first), and write the table.

    Rows go to ranges of ``order``; only one total per range meets in one task. ``df`` should be a stored table.
    """
    ranged = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    stored = checkpointed(ranged.withColumn("_part", F.spark_partition_id()))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = stored.groupBy("_part").agg(F.sum(amount).alias("_sum")).select(
        "_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        stored.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
        .join(shift, "_part")
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_part", "_before", "_inside")
    )


def parts_for(rows: int, each: int) -> int:
    """Number of partitions that hold about ``each`` rows."""
    return max(1, math.ceil(rows / each))


def orderable(df: DataFrame) -> list[str]:
    """Columns that rows can be sorted by: those without a map inside."""
    return [f.name for f in df.schema if not any(k in f.dataType.simpleString() for k in ("map<", "variant"))]


def maybe_in(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows of ``df`` whose ``column`` (a 64-bit hash) may be in ``keys``, to be joined with it: so fewer texts are shuffled.

    A bitmap of ``MAP_BITS`` bits, 8 MB at most whatever the tables hold, is sent to the workers; the fuller it gets, the more
    rows pass that the join then drops.
    """
    place = F.pmod(F.xxhash64(column), F.lit(MAP_BITS))
    parts = keys.groupBy(F.bitmap_bucket_number(place + 1).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place + 1)).alias("bits"))
    bits = np.zeros(MAP_BITS // 8, np.uint8)
    for bucket, part in parts.collect():  # at most MAP_BITS bits
        part = np.frombuffer(part, np.uint8)
        low = (bucket - 1) * len(part)
        bits[low : low + len(part)] |= part[: max(0, len(bits) - low)]
    shared, names = df.sparkSession.sparkContext.broadcast(bits.tobytes()), df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            at = np.asarray(batch["_place"])
            hit = (there[at >> 3] >> (at & 7).astype(np.uint8)) & 1
            yield batch.filter(pa.array(hit.astype(bool))).select(names)

    return df.withColumn("_place", place).mapInArrow(run, df.schema)


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node) for every node of ``edges`` (``a, b``, 64-bit numbers).

    Large-star and small-star rounds (Kiveris et al. 2014): each hangs nodes under the smallest neighbour until nothing moves.
    A node with very many neighbours is only ever joined with one row.
    """
    now, seen = checkpointed(edges.where("a <> b").select("a", "b").distinct()), None
    while True:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = checkpointed(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m"))
        now = checkpointed(small.where("a <> b").distinct())
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())
