"""Exact nearest neighbours, found first along several shifted Hilbert curves of projected vectors.

Each curve turns the vectors by its own random rotation, keeps the first few axes, shifts and cuts them into cells, and orders
the cells along a Hilbert curve. Spark range-partitions the vectors by that order. Every query looks at a window of
neighbours in each order, measured exactly, and the nearest of all windows are merged. The first order is also cut into balls
(centre, radius): a query then visits every ball that may hold a nearer vector than the last it has found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from partledger.llm.common import checkpointed, running_total, start, table
from partledger.operators.blocks import block_join, matrix

CURVES = 12
AXES, BITS = 10, 6  # of a key
WINDOW = 4096  # neighbours on each side of a query in each order
BLOCK_ROWS = 8192  # neighbours in an order that one task holds
BALL_ROWS = 4096  # neighbours in the first order that share a centre and radius
TILE = 1 << 21  # distances that a task holds at once
SAMPLE = 20_000  # vectors that the axes are fitted on


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of integer cells (rows x axes) along the Hilbert curve (Skilling 2004, on all rows at once)."""
    x = [cells[:, k].astype(np.uint64) for k in range(cells.shape[1])]
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        p, bit = np.uint64(q - 1), np.uint64(q)
        for i in range(len(x)):
            high = (x[i] & bit) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    t, q = np.zeros_like(x[0]), top
    while q > 1:
        t = np.where((x[-1] & np.uint64(q)) != 0, t ^ np.uint64(q - 1), t)
        q >>= 1
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << np.uint64(1)) | (((axis ^ t) >> np.uint64(b)) & np.uint64(1))
    return key.astype(np.int64)


class Curves:
    """Rotations, shifts and cell widths of all curves, from a sample of vectors."""

    def __init__(self, sample: np.ndarray, curves: int, axes: int, bits: int, seed: int = 11):
        draw = np.random.default_rng(seed)
        self.bits, self.mean = bits, sample.mean(axis=0)
        moved = sample - self.mean
        width = sample.shape[1]
        _, _, main = np.linalg.svd(moved.T @ moved / max(1, len(sample)))
        axes = min(axes, width)
        self.turns, self.low, self.step = [], [], []
        for _ in range(curves):
            mixing = np.linalg.qr(draw.normal(size=(width, width)))[0]
            turn = (main.T @ mixing)[:, :axes] if width > axes else main.T @ mixing
            seen = moved @ turn
            low, high = np.percentile(seen, 1, axis=0), np.percentile(seen, 99, axis=0)
            step = np.maximum((high - low) / (2**bits - 2), 1e-30)
            self.turns.append(turn)
            self.low.append(low - step * draw.random(axes))
            self.step.append(step)

    def keys(self, vectors: np.ndarray, curve: int) -> np.ndarray:
        cells = np.floor(((vectors - self.mean) @ self.turns[curve] - self.low[curve]) / self.step[curve])
        return hilbert_keys(np.clip(cells, 0, 2**self.bits - 1).astype(np.int64), self.bits)


def usable(vectors: DataFrame, vec: str) -> DataFrame:
    """Rows whose vector is neither null nor zero and whose components are neither null nor infinite nor NaN."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col(vec).isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vec, lambda x: x != 0))


def _matrix(column: pa.Array | pa.ChunkedArray, rows: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


def _block(keep: int, window: int):
    """Nearest classes of each query among the rows of one block that lie inside its window."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("asks", "ascending"), ("pos", "ascending")])
        asks = rows["asks"].to_numpy(zero_copy_only=False)
        there = int((~asks).sum())
        pos, cid, vec = rows["pos"].to_numpy(), rows["cid"].to_numpy(), _matrix(rows["vec"], len(rows))
        where, names, points = pos[:there], cid[:there], vec[:there]
        query, near, score = [], [], []
        for k in range(there, len(rows)):
            a, b = np.searchsorted(where, [pos[k] - window, pos[k] + window + 1])
            if a == b:
                continue
            gap = points[a:b] - vec[k]
            far = np.sqrt((gap * gap).sum(axis=1))
            best = np.lexsort((names[a:b], far))[:keep] if b - a <= keep else _first(far, names[a:b], keep)
            query.append(np.full(len(best), cid[k]))
            near.append(names[a:b][best])
            score.append(far[best])
        kinds = [pa.int64(), pa.int64(), pa.float64()]
        joined = [np.concatenate(x) if x else [] for x in (query, near, score)]
        return pa.table([pa.array(x, t) for x, t in zip(joined, kinds)], names=["asker", "cid", "score"])

    return run


def _first(far: np.ndarray, names: np.ndarray, keep: int) -> np.ndarray:
    """The first ``keep`` by distance and name."""
    edge = np.partition(far, keep - 1)[keep - 1]
    close = np.flatnonzero(far <= edge)
    return close[np.lexsort((names[close], far[close]))][:keep]


def _ball(rows: pa.Table) -> pa.Table:
    """Centre of some vectors, and how far the farthest is from it."""
    points = _matrix(rows["vec"], len(rows))
    centre = points.mean(axis=0)
    radius = np.sqrt(((points - centre) ** 2).sum(axis=1)).max()
    return pa.table({"cell": rows["cell"][:1], "centre": pa.array([centre], pa.list_(pa.float64())), "radius": [radius]})


def _nearer(keep: int):
    """Kernel: the nearest classes of each query in a ball, of those not farther than the query's ``limit``.

    Products tell which vectors may be among them, up to rounding; those are measured as the windows measure.
    """

    def kernel(left: pa.Table, right: pa.Table) -> pd.DataFrame:
        asker, limit, names = left["asker"].to_numpy(), left["limit"].to_numpy(), right["cid"].to_numpy()
        ask, points = matrix(left["vec"]), matrix(right["vec"])
        own, other = (ask * ask).sum(axis=1), (points * points).sum(axis=1)
        query, near, score = [], [], []
        step = max(1, TILE // len(points))
        for first in range(0, len(ask), step):
            some = slice(first, first + step)
            square = own[some, None] + other - 2.0 * (ask[some] @ points.T)
            slack = 1e-14 * (ask.shape[1] + 8) * (own[some] + other.max())
            edge = np.square(limit[some])
            if len(points) > keep:
                edge = np.minimum(edge, np.partition(square, keep - 1, axis=1)[:, keep - 1])
            for k, close in enumerate(~(square > (edge + 2 * slack)[:, None])):
                close = np.flatnonzero(close)
                gap = points[close] - ask[first + k]
                far = np.sqrt((gap * gap).sum(axis=1))
                best = np.lexsort((names[close], far))[:keep]
                query.append(np.full(len(best), asker[first + k]))
                near.append(names[close][best])
                score.append(far[best])
        return pd.DataFrame({"asker": np.concatenate(query), "cid": np.concatenate(near), "score": np.concatenate(score)})

    return kernel


def _beyond(near: DataFrame, order: DataFrame, vec: DataFrame, known: DataFrame, keep: int) -> DataFrame:
    """``asker, cid, score``: what the windows may have missed, from every ball that reaches into a query's ``keep``-th distance.

    A ball's vectors are at least as far from a query as its centre, less its radius; a query with fewer than ``keep`` visits all.
    """
    place = F.row_number().over(Window.partitionBy("asker").orderBy("score", "cid"))
    last = near.withColumn("n", place).where(F.col("n") == keep).select(F.col("asker").alias("cid"), F.col("score").alias("limit"))
    placed = order.where("curve = 0").select("cid", F.floor(F.col("pos") / BALL_ROWS).cast("int").alias("cell")).join(vec, "cid")
    placed = checkpointed(placed)
    balls = placed.groupBy("cell").applyInArrow(_ball, "cell int, centre array<double>, radius double")
    asks = known.select("cid").distinct().join(vec, "cid").join(last, "cid", "left")
    asks = asks.select(F.col("cid").alias("asker"), "vec", F.coalesce("limit", F.lit(float("inf"))).alias("limit"))
    squares = F.aggregate(F.zip_with("vec", "centre", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    within = F.sqrt(squares) * (1 - 1e-9) <= (F.col("limit") + F.col("radius")) * (1 + 1e-9)
    probes = checkpointed(asks.crossJoin(F.broadcast(checkpointed(balls))).where(within).select("asker", "vec", "limit", "cell"))
    return block_join(probes, placed, "asker", "cid", _nearer(keep), "asker bigint, cid bigint, score double", BALL_ROWS)


def neighbours(
    vectors: DataFrame, asks: Column, k: int = 10, curves: int = CURVES, axes: int = AXES, bits: int = BITS,
    window: int = WINDOW, id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest ``vectors`` of every row for which ``asks`` holds.

    ``score`` is the Euclidean distance in double precision; ties go to the smaller id, a row is never its own neighbour.
    Vectors that are null, zero or hold null or non-finite components, and null ids, take no part. Vectors of different
    lengths are never neighbours. Equal vectors stand in the orders once, with their ``k + 1`` smallest ids, which is all
    that can be returned; so copies neither fill windows nor one task. Repeated rows count once. Every vector is in every
    order; only the axes are fitted on a sample. The result is exact for every size, window and number of curves: these decide
    how near the first finds are, so how many balls a query visits after them. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    start(spark)
    base = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"), asks.alias("asks"))
    base = usable(base, "vec").where("id IS NOT NULL").withColumn("hash", F.xxhash64("vec"))
    place = F.row_number().over(Window.partitionBy("hash", "vec").orderBy("id"))
    few = base.select("hash", "vec", "id").distinct().withColumn("n", place).where(F.col("n") <= k + 1)
    classes = checkpointed(few.groupBy("hash", "vec").agg(F.min("id").alias("cid"), F.sort_array(F.collect_list("id")).alias("ids")))
    asking = base.where("asks").select(F.col("id").alias("query_id"), "hash", "vec").distinct()
    known = checkpointed(asking.join(classes.select("hash", "vec", "cid"), ["hash", "vec"]).select("query_id", "cid", F.size("vec").alias("length")))
    found = spark.createDataFrame([], "query_id bigint, vec_id bigint, score double")
    for (length,) in classes.select(F.size("vec")).distinct().collect():
        part = classes.where(F.size("vec") == length)
        found = found.unionByName(_search(part, known.where(F.col("length") == length), k, curves, axes, bits, window))
    nearest = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", nearest).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search(classes: DataFrame, known: DataFrame, k: int, curves: int, axes: int, bits: int, window: int) -> DataFrame:
    """``query_id, vec_id, score`` with the nearest ``k`` of each query, and one more at most."""
    spark = classes.sparkSession
    sample = classes.orderBy("hash", "cid").select("vec").limit(SAMPLE).toPandas()["vec"]
    shared = spark.sparkContext.broadcast(Curves(np.stack([np.asarray(v, np.float64) for v in sample]), curves, axes, bits))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _matrix(batch["vec"], len(batch))
            for c in range(curves):
                curve, keys = pa.array(np.full(len(batch), c, np.int32)), pa.array(shared.value.keys(points, c))
                yield pa.RecordBatch.from_arrays([curve, keys, batch["cid"]], ["curve", "key", "cid"])

    places = classes.select("cid", "vec").mapInArrow(keyed, "curve int, key bigint, cid bigint").withColumn("one", F.lit(1).cast("long"))
    every = F.lit(classes.count())  # rows of a curve
    ordered = running_total(checkpointed(places), ["curve", "key", "cid"], "one", "pos")
    placed = checkpointed(ordered.select("curve", (F.col("pos") - F.col("curve") * every).alias("pos"), "cid"))
    vec = classes.select("cid", "vec")
    there = placed.select("curve", F.floor(F.col("pos") / BLOCK_ROWS).alias("block"), "pos", "cid", F.lit(False).alias("asks"))
    reach = F.sequence(F.floor((F.col("pos") - window) / BLOCK_ROWS), F.floor((F.col("pos") + window) / BLOCK_ROWS))
    asks = placed.join(known.select("cid").distinct(), "cid").select("curve", F.explode(reach).alias("block"), "pos", "cid", F.lit(True).alias("asks"))
    near = there.unionByName(asks).join(vec, "cid").groupBy("curve", "block").applyInArrow(_block(k + 1, window), "asker bigint, cid bigint, score double")
    near = checkpointed(near.groupBy("asker", "cid").agg(F.min("score").alias("score")))
    near = near.unionByName(_beyond(near, placed, vec, known, k + 1))
    near = near.groupBy("asker", "cid").agg(F.min("score").alias("score")).join(classes.select("cid", "ids"), "cid")
    rank = F.row_number().over(Window.partitionBy("asker").orderBy("score", "vec_id"))
    members = near.select("asker", "score", F.explode("ids").alias("vec_id")).withColumn("n", rank).where(F.col("n") <= k + 1)
    names = known.select("query_id", F.col("cid").alias("asker"))
    return names.join(members, "asker").where("vec_id <> query_id").select("query_id", "vec_id", "score")


def op10_hilbert_neighbours(spark, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 100 == 0)
