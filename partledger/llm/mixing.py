"""Mixing sources to target weights by pivotal dependent rounding over a reduction tree."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from partledger.llm.common import checkpointed, mixed, orderable, parts_for, running_total, start

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
CHUNK_ROWS = 1000  # repeated rows that may share a leaf
LEAF_ROWS = 4096  # documents that one leaf of the tree pairs up
FAN_IN = 16  # nodes of a level that meet in one node of the next
LEVEL = "doc_id: bigint, source: string, size: bigint, node: bigint, key: bigint, p: double, open: boolean"
CARRIED = ["doc_id", "source", "size", "node", "key", "p"]


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """One row per source: ``source, source_size, target``.

    ``weights`` repeat over the sources by code point, null last. The total is ``share`` of all sizes; a target above
    ``most`` times its source is cut to that and the excess dealt out again by weight until none is above.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.lit(1).cast("long").alias("one"))
    ranked = running_total(
        checkpointed(sources.withColumn("last", F.col("source").isNull())), ["last", "source"], "one", "place"
    )
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    weighted = checkpointed(
        ranked.select(
            "source",
            "source_size",
            F.get(kinds, (F.col("place") % len(weights)).cast("int")).alias("weight"),
            (F.col("source_size") * F.lit(float(most))).alias("cap"),
        )
    )
    capped, level = -1, None
    while True:
        over = F.lit(False) if level is None else F.col("weight") * level > F.col("cap")
        now = weighted.agg(
            F.sum("source_size").alias("all"),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)).alias("free"),
            F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0.0)).alias("used"),
            F.count(F.when(over, 1)).alias("capped"),
        ).first()
        if now["capped"] == capped or not now["free"]:
            break
        capped, level = now["capped"], (share * now["all"] - now["used"]) / now["free"]
    target = F.least(F.col("cap"), F.col("weight") * F.lit(level if level is not None else 0.0))
    return weighted.select("source", "source_size", target.alias("target"))


def _draw(key: np.ndarray, level: int) -> list[float]:
    """Repeatable numbers in [0, 1), one per row and level."""
    salt = np.uint64((level + 1) * 0xD1B54A32D192ED03 & (2**64 - 1))
    return ((mixed(key.astype(np.uint64) ^ salt) >> np.uint64(11)) / float(1 << 53)).tolist()


def round_pairs(size: list[int], p: list[float], draw: list[float]) -> int:
    """Pair fractional rows, moving words between the two until one row is whole; changes ``p``.

    Long documents should come first: one that stays fractional is then settled by many short ones, and what is left at
    the end is short. Up or down is drawn so that each row's expected copies stay as they are; the words of the pair never change.
    Returns the one row that is left fractional, or -1.
    """
    held = -1
    for i in range(len(p)):
        if not 0.0 < p[i] < 1.0:
            continue
        if held < 0:
            held = i
            continue
        a, b = held, i
        sa, sb = size[a], size[b]
        gain, loss = min((1 - p[a]) * sa, p[b] * sb), min(p[a] * sa, (1 - p[b]) * sb)
        # ``gain``: what a can take from b until one of them is whole; ``loss``: the other way
        if draw[i] * (gain + loss) < loss:
            a_full = (1 - p[a]) * sa <= p[b] * sb
            p[a], p[b] = (1.0, p[b] - gain / sb) if a_full else (p[a] + gain / sa, 0.0)
        else:
            a_out = p[a] * sa <= (1 - p[b]) * sb
            p[a], p[b] = (0.0, p[b] + loss / sb) if a_out else (p[a] - loss / sa, 1.0)
        for k in (a, b):  # what is left of rounding errors
            if p[k] < 1e-12:
                p[k] = 0.0
            elif p[k] > 1 - 1e-12:
                p[k] = 1.0
        held = a if 0.0 < p[a] < 1.0 else b if 0.0 < p[b] < 1.0 else -1
    return held


def _node(level: int):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("source", "ascending"), ("size", "descending"), ("key", "ascending"), ("doc_id", "ascending")])
        size, p = rows["size"].to_pylist(), rows["p"].to_pylist()
        draw = _draw(rows["key"].to_numpy(zero_copy_only=False), level)
        names = rows["source"].to_pylist()
        left, first = np.zeros(len(p), bool), 0
        for last in range(1, len(p) + 1):
            if last < len(p) and names[last] == names[first]:
                continue
            mine = p[first:last]
            held = round_pairs(size[first:last], mine, draw[first:last])
            p[first:last] = mine
            if held >= 0:
                left[first + held] = True
            first = last
        rows = rows.select([c for c in CARRIED if c != "p"])
        return rows.append_column("p", pa.array(p, pa.float64())).append_column("open", pa.array(left))

    return run


def pivotal(rows: DataFrame, leaf_rows: int = LEAF_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """Round ``p`` (strictly between 0 and 1) of all rows to 0 or 1, keeping each source's sum of ``size * p``.

    ``rows`` has ``doc_id, source, size (> 0), key, chunk, p`` and is a stored table. Leaves deal rows out by hash whatever their
    source, so a hot source is spread, and equal rows chunk by chunk; each leaf keeps one fractional row per source, and
    these meet level by level.
    """
    nodes = parts_for(rows.count(), leaf_rows)
    spot = F.when(F.col("chunk") == 0, F.xxhash64("key", F.lit(1))).otherwise(F.xxhash64("key", F.lit(1), "chunk"))
    dealt = rows.withColumn("node", F.pmod(spot, F.lit(nodes)))
    now = checkpointed(dealt.select(*CARRIED).groupBy("node").applyInArrow(_node(0), LEVEL))
    done, level = [now.where(~F.col("open"))], 1
    while nodes > 1:
        nodes = math.ceil(nodes / fan_in)
        up = now.where("open").withColumn("node", F.floor(F.col("node") / fan_in).cast("long"))
        now = checkpointed(up.select(*CARRIED).groupBy("source", "node").applyInArrow(_node(level), LEVEL))
        done.append(now.where(~F.col("open")))
        level += 1
    last = F.pmod(F.xxhash64("key", F.lit("last")), F.lit(1 << 52)) / float(1 << 52) < F.col("p")
    done.append(now.where("open").withColumn("p", last.cast("double")))
    out = done[0]
    for other in done[1:]:
        out = out.unionByName(other)
    return out.select("doc_id", "source", "size", "key", "p")


def copies(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, keep: tuple[str, ...] = ()
) -> DataFrame:
    """How many copies of each document the mix takes: ``doc_id, source, size, source_size, target, n_copies``.

    Every document of a source has the same expected number of copies, target / source size. Its whole part is taken for
    certain and its fraction is rounded by ``pivotal``, so a source's words differ from its target by at most one document.
    Documents without words are never taken more than their whole part; null text counts as size 0, null is a source
    of its own, and repeated rows are documents of their own. An empty table gives an empty result.
    """
    start(docs.sparkSession)
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"),
        F.xxhash64("doc_id", "source", "text").alias("key"),
    )
    # repeated rows are numbered by chunks, so that however many there are no leaf gets them all
    counted = sized.groupBy("doc_id", "source", "size", "key").agg(F.count(F.lit(1)).alias("n"))
    chunks = counted.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / CHUNK_ROWS))))
    inside = F.sequence(F.lit(1).cast("long"), F.least(F.lit(CHUNK_ROWS).cast("long"), F.col("n") - F.col("chunk") * CHUNK_ROWS))
    sizes = checkpointed(chunks.withColumn("n", F.explode(inside)).drop("n"))
    targets = checkpointed(source_targets(sizes, weights, share, most))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    shared = checkpointed(
        sizes.join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
        .drop("_s")
        .withColumn("whole", F.floor(ratio + 1e-12).cast("long"))
        .withColumn("p", F.greatest(ratio - F.col("whole"), F.lit(0.0)))
    )
    fractional = (F.col("p") > 1e-12) & (F.col("size") > 0)
    rounded = pivotal(shared.where(fractional).select("doc_id", "source", "size", "key", "chunk", "p"))
    meant = shared.groupBy("source").agg(F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.first("whole").alias("whole"))
    columns = ["doc_id", "source", "size", "key", "source_size", "target", "n_copies"]
    taken = (
        rounded.join(meant.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
        .drop("_s")
        .withColumn("n_copies", F.col("whole") + F.col("p").cast("long"))
    )
    plain = shared.where(~fractional).withColumn("n_copies", F.col("whole"))
    return taken.select(*columns).unionByName(plain.select(*columns))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every column of ``docs``, each row as often as it is taken (0, 1, 2 … times).

    Rows equal in id, source and text share what they are given, the first by their other columns (those of a type that can be
    ordered) first. An empty table gives an empty result.
    """
    chosen = copies(docs, **options).groupBy("doc_id", "key").agg(F.sum("n_copies").alias("total"), F.count(F.lit(1)).alias("rows"))
    chosen = chosen.where("total > 0").withColumnRenamed("doc_id", "of")
    keyed = docs.select(F.struct(*docs.columns).alias("doc"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("doc_id", "source", "text").alias("key"))
    joined = keyed.join(chosen, "key").where(F.col("id").eqNullSafe(F.col("of")))
    alone = joined.where("rows = 1").withColumn("times", F.col("total"))
    order = [F.col("doc")[c] for c in orderable(docs) if c != "text"]
    place = F.row_number().over(Window.partitionBy("id", "key").orderBy(F.lit(0), *order))
    several = joined.where("rows > 1").withColumn("times", F.floor(F.col("total") / F.col("rows")) + (place <= F.col("total") % F.col("rows")).cast("long"))
    times = alone.unionByName(several).where("times > 0").select("doc", F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("copy"))
    return times.select(*[F.col("doc")[c].alias(c) for c in docs.columns])


def op3_mixing_sources(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = copies(docs.select("doc_id", "source", "text"))
    taken = (F.col("n_copies") * F.col("size")).alias("taken")
    return found.select("doc_id", "size", "source_size", "target", taken, "source", "n_copies")
