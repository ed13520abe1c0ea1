"""N-gram Jaccard join in a metric space: pivots, Voronoi regions, and windows by the triangle inequality.

The Jaccard distance of shingle sets is a metric. Each round elects pivots among the documents that are still outside, no two
of which share one of their rarer shingles. A document within ``HOME`` of its nearest pivot is at home in that pivot's region; every document
within ``HOME`` plus the join's distance of a pivot is replicated to its region, so a home document meets there all it can link
to. Documents that are at home nowhere go to the next round with new pivots. Documents that differ only in shingles no other document has are
merged into one point first. Within a region, members stand in blocks by
distance from the pivot, and only blocks whose distances lie within the join's distance of each other are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from partledger.llm.common import (
    LOWER, MIX, checkpointed, components, flat, maybe_in, mixed, orderable, slices, span_hashes, start, table, word_counts, word_spans,
)

WORDS = 5  # in a shingle
PERCENT = 75  # similarity of a link
HOME = (50, 25, 0)  # per cent of distance within which a document is at home with a pivot, round by round and over again
BLOCK_ROWS = 1000  # members of a region that one task compares with as many others
BLOCK_SHINGLES = 1_000_000  # … and about so many shingles
STRIPS = 8  # of a large region, by distance from its pivot
_SALTS = [np.uint64(pow(0x5851F42D4C957F2D, k + 3, 2**64)) for k in range(16)]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one text after the other, and their offsets.

    A-Z is lower-cased; a text of fewer than ``words`` words has one shingle, all its words; one without words has none.
    """
    data = LOWER[data]
    starts, ends = word_spans(data, offsets)
    hashes, at = span_hashes(data, starts, ends), word_counts(starts, offsets)
    count = np.diff(at)
    doc = np.repeat(np.arange(len(count)), count)
    ordinal = np.arange(len(doc)) - at[:-1][doc]
    whole = ordinal + words <= count[doc]
    value = np.zeros(len(doc), np.uint64)
    size = len(value) - words + 1
    if size > 0:
        for k in range(words):
            value[:size] += hashes[k : k + size] * _SALTS[k]
    short = (count > 0) & (count < words)
    if short.any():
        salted = hashes * np.array(_SALTS, np.uint64)[np.minimum(ordinal, 15)]
        total = np.concatenate([[np.uint64(0)], np.cumsum(salted)])
        first = at[:-1][short]
        value[first] = total[at[1:][short]] - total[first] + count[short].astype(np.uint64) * MIX
        whole[first] = True
    value, doc = mixed(value[whole]), doc[whole]
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    value, doc = value[new], doc[new]
    return value, np.searchsorted(doc, np.arange(len(count) + 1))


def _texts(batch: pa.RecordBatch, words: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = flat(batch["text"])
    for i, j in slices(offsets):
        yield (i, j, *shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], words))


def _names(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set, whatever its order."""
    total = np.concatenate([[np.uint64(0)], np.cumsum(mixed(values ^ MIX))])
    twice = np.concatenate([[np.uint64(0)], np.cumsum(mixed(values + MIX))])
    return mixed((total[at[1:]] - total[at[:-1]]) ^ mixed(twice[at[1:]] - twice[at[:-1]]) + np.diff(at).astype(np.uint64)).view(np.int64)


def _set_rows(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, values, at in _texts(batch, words):
                rows = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([rows["row"], pa.array(np.diff(at)), pa.array(_names(values, at))], ["row", "n", "name"])

    return run


def _prefix(n: np.ndarray, missing: Fraction) -> np.ndarray:
    """Smallest hashes of a set that are looked at: what may be missing from a partner, one more, and an eighth."""
    return np.minimum(n, n * missing.numerator // missing.denominator + 1 + n // 8)


def _prefix_rows(words: int, missing: Fraction):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, values, at in _texts(batch, words):
                n = np.diff(at)
                take = np.where(n > 1, _prefix(n, missing), 0)  # a set of one shingle links only with its copies
                fill = np.arange(take.sum()) - np.repeat(np.cumsum(take) - take, take)
                found = values[np.repeat(at[:-1], take) + fill].view(np.int64)
                name = np.repeat(_names(values, at), take)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(name), pa.array(np.repeat(n, take).astype(np.int32))], ["h", "name", "n"])

    return run


def _array_rows(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, values, at in _texts(batch, words):
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.slice(i, j - i)["name"], pa.array(np.diff(at)), lists], ["name", "n", "hs"])

    return run


def _shared_enough(sets: DataFrame, percent: int) -> DataFrame:
    """Sets (``name, n, hs``) of which at least ``percent`` of all ``n`` shingles are in another set too; no other can link.

    ``hs`` keeps the shared shingles only, those in fewest sets first; a set's own count in ``n`` alone.
    """
    rows = sets.select("name", "n", F.explode("hs").alias("h"))
    often = checkpointed(rows.groupBy("h").agg(F.count(F.lit(1)).alias("k")).where("k > 1"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("k", "h"))), lambda x: x["h"])
    mine = rows.join(often, "h").groupBy("name").agg(F.first("n").alias("n"), ordered.alias("hs"))
    return mine.where(F.size("hs") * 100 >= F.col("n") * percent)


def _merged(sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Sets that differ only in shingles of their own become one point: the smallest, and those too large to link with it.

    A set that links with the smallest of its kind has no link that the smallest lacks. Returns the sets and the links.
    """
    key = [F.xxhash64("hs").alias("k1"), F.xxhash64("hs", F.lit(1)).alias("k2"), F.size("hs").alias("k3")]
    keyed = sets.select("*", *key)
    least = keyed.groupBy("k1", "k2", "k3").agg(F.min(F.struct("n", "name")).alias("least"))
    both = keyed.join(least, ["k1", "k2", "k3"])
    hangs = (F.col("name") != F.col("least.name")) & (100 * F.col("k3") >= percent * (F.col("n") + F.col("least.n") - F.col("k3")))
    both = checkpointed(both.withColumn("hangs", hangs))
    links = both.where("hangs").select(F.col("name").alias("a"), F.col("least.name").alias("b"))
    return both.where("NOT hangs").select("name", "n", "hs"), links


def _candidates(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Set of every text (``row, n, name``), and the distinct sets that may link with a different one (``name, n, hs``)."""
    spark = docs.sparkSession
    missing = Fraction(100 - percent, 100)
    sets = checkpointed(docs.select("row", "text").mapInArrow(_set_rows(words), "row bigint, n bigint, name bigint"))
    rows = docs.select("text").mapInArrow(_prefix_rows(words, missing), "h bigint, name bigint, n int")
    # Smallest-hash prefixes: of two linked sets the one whose prefix ends first holds at most its missing share of shingles
    # that the other lacks, so both see at least an eighth of its size, and one more, in both prefixes. Copies only
    # make the filter let more through.
    often = checkpointed(rows.select("h").groupBy("h").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("h"))
    partner = F.ceil(F.col("n") * percent / 100)
    hits = rows.join(often, "h").groupBy("name", "n").agg(F.count(F.lit(1)).alias("hits"))
    copies = sets.groupBy("name").agg(F.count(F.lit(1)).alias("copies"), F.min("row").alias("row"))
    likely = hits.join(copies, "name").where(F.col("hits") >= F.col("copies") * (1 + F.floor(partner / 8))).select("row", "name")
    likely = checkpointed(likely)
    arrays = maybe_in(docs.select("row", "text"), likely, "row").join(likely, "row").dropDuplicates(["name"]).select("name", "text").mapInArrow(_array_rows(words), "name bigint, n bigint, hs array<bigint>")
    return sets, checkpointed(arrays)


def _elect(rows: DataFrame) -> DataFrame:
    """Pivots: sets that come first on every one of their shingles, so that no two pivots share one."""
    first = rows.groupBy("h").agg(F.min(F.struct("rank", "name", "known")).alias("first"))
    won = first.groupBy("first.name", "first.known").agg(F.count(F.lit(1)).alias("won"))
    return won.where("won = known").select("name")


class _Union:
    """Disjoint sets of a few rows."""

    def __init__(self, size: int):
        self.up = list(range(size))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)


def _compare(percent: int):
    """Links between the two sides of one pair of blocks; rows that already hang on the pivot count as one."""

    def run(rows: pa.Table) -> pa.Table:
        side, name = np.asarray(rows["side"]), np.asarray(rows["name"])
        n, near = np.asarray(rows["n"]), np.asarray(rows["near"])
        lists = rows["hs"].combine_chunks()
        at = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths()))])
        _, code = np.unique(np.asarray(lists.flatten()), return_inverse=True)
        width = int(code.max()) + 1 if len(code) else 1
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        tied = _Union(len(rows) + 1)  # the last is the pivot
        for i in np.flatnonzero(near):
            tied.join(int(i), len(rows))
        step = max(1, (16 << 20) // width)  # rows of a dense piece of at most 64 MB
        for i in range(0, len(a), step):
            left = _dense(a[i : i + step], at, code, width)
            for j in range(0, len(b), step):
                both = left @ _dense(b[j : j + step], at, code, width).T
                every = n[a[i : i + step]][:, None] + n[b[j : j + step]][None, :] - both
                for x, y in np.argwhere(100 * both >= percent * every):
                    tied.join(int(a[i + x]), int(b[j + y]))
        pivot = rows["pivot"][0].as_py()
        root = [tied.find(i) for i in range(len(rows))]
        top = tied.find(len(rows))
        out = [(int(name[i]), pivot if root[i] == top else int(name[root[i]])) for i in range(len(rows)) if not near[i]]
        out = [x for x in out if x[0] != x[1]]
        return pa.table({"a": pa.array([x[0] for x in out], pa.int64()), "b": pa.array([x[1] for x in out], pa.int64())})

    return run


def _dense(rows: np.ndarray, at: np.ndarray, code: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.float32)
    for k, r in enumerate(rows):
        out[k, code[at[r] : at[r + 1]]] = 1
    return out


def _links(sets: DataFrame, percent: int, home: tuple[int, ...], block_rows: int) -> DataFrame:
    """``a, b``: links that connect the given sets exactly as all links of at least ``percent`` do."""
    spark = sets.sparkSession
    links = [spark.createDataFrame([], "a bigint, b bigint")]
    outside, rounds = sets, 0
    while True:
        outside, hanging = _merged(checkpointed(_shared_enough(outside, percent)), percent)
        links.append(hanging)
        count, size = outside.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not count:
            break
        if count <= block_rows and size <= BLOCK_SHINGLES:  # small enough to be compared as one region
            links.append(_as_one(outside, percent))
            break
        near_enough = home[rounds % len(home)]
        rounds += 1
        # Prefixes, rarest shingles first: of two sets at least this similar, both have a common shingle in them.
        least = percent - near_enough
        prefix = F.size("hs") - F.ceil(F.col("n") * least / 100).cast("int") + 1
        own = 1 - F.size("hs") / F.col("n")  # sets with few shingles of their own are the more central
        rank = F.shiftleft(F.floor(1000 * own).cast("long"), 52) + F.shiftrightunsigned(F.xxhash64("name", F.lit(rounds)), 12)
        shown = outside.withColumn("known", prefix).where("known > 0")
        rows = shown.select("name", rank.alias("rank"), "known", F.explode(F.slice("hs", F.lit(1), F.col("known"))).alias("h"))
        pivots = checkpointed(_elect(rows))
        theirs = rows.join(pivots, "name").select("h", F.col("name").alias("pivot"))
        pairs = rows.join(theirs, "h").select("name", "pivot").distinct()
        whole = outside.select(F.col("name").alias("pivot"), F.col("n").alias("pivot_n"), F.col("hs").alias("pivot_hs"))
        sizes = 100 * F.least("n", "pivot_n") >= least * F.greatest("n", "pivot_n")
        both = pairs.join(outside, "name").join(whole, "pivot").where(sizes)
        both = both.select("name", "pivot", F.size(F.array_intersect("hs", "pivot_hs")).alias("shared"), "n", "pivot_n")
        shared = F.when(F.col("name") == F.col("pivot"), F.col("n")).otherwise(F.col("shared")).alias("both")
        met = both.select("name", "pivot", shared, "n", "pivot_n").withColumn("every", F.col("n") + F.col("pivot_n") - F.col("both"))
        met = met.where(100 * F.col("both") >= least * F.col("every"))
        near = 100 * F.col("both") >= percent * F.col("every")
        at_home = (100 * F.col("both") >= (100 - near_enough) * F.col("every")).alias("at_home")
        met = checkpointed(met.select("name", "pivot", (1 - F.col("both") / F.col("every")).alias("distance"), near.alias("near"), at_home))
        links.append(met.where("near AND name <> pivot").select(F.col("name").alias("a"), F.col("pivot").alias("b")))
        if near_enough:
            links.append(_inside_regions(outside, met, percent, block_rows))
        outside = shown.drop("known").join(met.where("at_home").select("name").distinct(), "name", "left_anti")
    out = links[0]
    for more in links[1:]:
        out = out.union(more)
    return out


def _as_one(sets: DataFrame, percent: int) -> DataFrame:
    """Links of a few sets, all compared in one task."""
    alone = sets.select(F.lit(0).cast("long").alias("pivot"), "name", F.lit(False).alias("near"), "n", "hs")
    work = alone.withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
    return checkpointed(work.groupBy("pivot").applyInArrow(_compare(percent), "a bigint, b bigint"))


def _inside_regions(sets: DataFrame, met: DataFrame, percent: int, block_rows: int) -> DataFrame:
    """Links inside regions that the pivots' own links don't give: those of members too far from the pivot to hang on it."""
    eps = (100 - percent) / 100 + 1e-9
    ring = met.where("NOT near").select("pivot").distinct()
    # members nearer than the nearest of the ring allows can link with none of it
    least = met.where("NOT near").groupBy("pivot").agg(F.min("distance").alias("least"))
    live = met.join(least, "pivot").where(~F.col("near") | (F.col("distance") >= F.col("least") - eps)).drop("least")
    # blocks: a small region is one; a large one has strips by distance, each dealt by hash into as many as it needs
    sized = live.join(sets.select("name", "n"), "name").join(ring, "pivot")
    weight = F.greatest(F.count(F.lit(1)) / block_rows, F.sum("n") / BLOCK_SHINGLES)
    whole = sized.groupBy("pivot").agg(weight.alias("_whole"))
    sized = sized.join(whole, "pivot").withColumn("strip", F.when(F.col("_whole") <= 1, 0).otherwise(F.floor(F.col("distance") * STRIPS)).cast("long"))
    dealt = sized.groupBy("pivot", "strip").agg(F.ceil(weight).cast("long").alias("_blocks"))
    spot = F.pmod(F.xxhash64("name"), F.col("_blocks"))
    placed = sized.join(dealt, ["pivot", "strip"]).withColumn("block", F.struct("strip", spot.alias("k")))
    placed = checkpointed(placed.select("pivot", "name", "near", "distance", "block"))
    kinds = placed.groupBy("pivot", "block").agg(F.min("distance").alias("low"), F.max("distance").alias("high"), F.max(~F.col("near")).alias("rings"))
    a = kinds.where("rings").select("pivot", F.col("block").alias("ba"), F.col("low").alias("la"), F.col("high").alias("ha"))
    b = kinds.select(F.col("pivot").alias("pb"), F.col("block").alias("bb"), F.col("low").alias("lb"), F.col("high").alias("hb"), F.col("rings").alias("rb"))
    apart = F.greatest(F.col("la") - F.col("hb"), F.col("lb") - F.col("ha"))
    once = ~F.col("rb") | (F.col("ba") <= F.col("bb"))  # two blocks with ring members meet once
    pairs = checkpointed(a.join(b, (F.col("pivot") == F.col("pb")) & (apart <= eps) & once).select("pivot", "ba", "bb"))
    left = placed.join(pairs.withColumnRenamed("ba", "block"), ["pivot", "block"]).select("pivot", F.col("block").alias("ba"), "bb", "name", "near", F.lit(0).alias("side"))
    right = placed.join(pairs.withColumnRenamed("bb", "block"), ["pivot", "block"]).select("pivot", "ba", F.col("block").alias("bb"), "name", "near", F.lit(1).alias("side"))
    work = left.unionByName(right).join(sets.select("name", "n", "hs"), "name")
    return checkpointed(work.groupBy("pivot", "ba", "bb").applyInArrow(_compare(percent), "a bigint, b bigint"))


def jaccard_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, home: tuple[int, ...] = HOME, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``doc_id, row, n_shingles, name, component`` for every row of ``docs`` (``doc_id, text``).

    Two texts link when 100 * intersection >= percent * union of their sets of ``words``-word shingles; shorter texts have one
    shingle, all their words. ``component`` is equal for texts that links connect. Equal sets are one set (``name``) from the
    start, however many copies there are. Null and wordless texts have an empty set and link with nothing; their component is
    null. Repeated rows are copies. ``row`` is a hash of id and text. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    start(spark)
    keyed = docs.select("doc_id", "text").withColumn("row", F.xxhash64("doc_id", "text"))
    sets, found = _candidates(keyed, words, percent)
    tied = checkpointed(components(_links(found, percent, home, block_rows)))
    ids = keyed.select("doc_id", "row")
    one = sets.groupBy("row").agg(F.first("n").alias("n_shingles"), F.first("name").alias("name"))
    joined = ids.join(one, "row").join(tied.select(F.col("node").alias("name"), "component"), "name", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "name"))
    return joined.select("doc_id", "row", "n_shingles", "name", component.alias("component"))


def smallest_ids(grouped: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id``: the smallest id of the component; a text that links with nothing keeps its own."""
    stored = checkpointed(grouped)
    # a stored table, so that Spark may split a very large component in the join
    least = checkpointed(stored.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("least")))
    joined = stored.join(least, "component", "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that link, directly or through others, with one of smaller id; all columns are kept.

    Of rows equal in id and text one stays, the first by the other columns (those of a type that can be ordered). An empty table
    gives an empty result.
    """
    grouped = checkpointed(jaccard_groups(docs, **options))
    first = grouped.where("component IS NOT NULL").groupBy("component").agg(F.min(F.struct("doc_id", "row")).alias("kept"))
    rows = first.select(F.col("kept.row").alias("key"))
    alone = grouped.where("component IS NULL").select(F.col("row").alias("key")).distinct()
    keyed = docs.select(F.struct(*docs.columns).alias("doc"), F.xxhash64("doc_id", "text").alias("key"))
    joined = keyed.join(rows.union(alone), "key")
    twice = joined.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    single = joined.join(twice, "key", "left_anti").select("doc")
    order = F.struct(F.lit(0), *[F.col("doc")[c] for c in orderable(docs) if c != "text"])
    several = joined.join(twice, "key").groupBy("key").agg(F.min_by("doc", order).alias("doc")).select("doc")
    return single.unionByName(several).select(*[F.col("doc")[c].alias(c) for c in docs.columns])


def op5_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return smallest_ids(jaccard_groups(table(spark, sf_dir, "documents").select("doc_id", "text")))
