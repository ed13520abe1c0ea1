"""Repeated passages across documents, exactly, by a sparse enhanced suffix array and its common-prefix interval tree.

Sampled positions ("anchors") stand for all suffixes: in every run of ``LONG`` bytes the ``GRAM``-byte strings of smallest hash
are anchors, so two equal passages of ``LONG`` bytes have an anchor at the same place. An anchor's context is what lies
up to ``LONG - GRAM`` bytes before it and ``LONG`` bytes from it on. Equal contexts are one leaf of the suffix array. The
leaves are sorted by what follows the anchor; a stack scan of neighbours' common prefixes gives the intervals of the tree, and
inside each interval the leaves are sorted by what precedes the anchor: two that agree further to the left than the interval
needs to reach ``LONG`` bytes belong to a maximal repeat, with all its occurrences.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from partledger.llm.common import _BYTE, MIX, checkpointed, flat, mixed, parts_for, slices, span_hashes, start, table

LONG = 200  # bytes of a passage that counts
GRAM = 32  # bytes that name an anchor
RANGE_ROWS = 10_000  # leaves of the suffix array in a range
WHOLE = 10  # ranges that one name may fill before its part of the array is cut
OPEN_ROWS = 20_000  # rows of intervals across a cut that a task gives out at once
CHUNK = 1 << 16


def _doubled(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` (a power of two) bytes from each position on; the last positions have none."""
    value, n, factor = _BYTE[data], 1, 0x5851F42D4C957F2D
    while n < size:
        if len(value) <= n:
            return value[:0]
        value = value[:-n] * np.uint64(factor) + value[n:]
        factor = factor * factor % 2**64
        n *= 2
    return mixed(value)


def _extreme(value: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each run of ``width`` values."""
    n = 1
    while 2 * n <= width:
        value = pick(value[:-n], value[n:])
        n *= 2
    return pick(value[: len(value) - (width - n)], value[width - n :]) if width > n else value


def anchors(data: np.ndarray, long: int = LONG, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Anchor positions of a byte array and the hash of each anchor's ``gram`` bytes."""
    width = long - gram + 1
    places, names = [], []
    for a in range(0, max(0, len(data) - long + 1), CHUNK):
        low, high = max(0, a - width), min(len(data), a + CHUNK + long + width)
        value = _doubled(data[low:high], gram)
        least = _extreme(value, width, np.minimum)  # of each passage
        padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
        most = _extreme(padded, width, np.maximum)  # over the passages that hold a position
        at = np.flatnonzero(value == most)
        at = at[(at + low >= a) & (at + low < a + CHUNK)] if a + CHUNK < len(data) - long + 1 else at[at + low >= a]
        places.append(at + low)
        names.append(value[at])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(places), np.concatenate(names)


def _reach(long: int, gram: int) -> tuple[int, int]:
    return long - gram, long  # bytes of a context before and from the anchor on


def _anchor_rows(long: int, gram: int):
    """``row, pos, name, context, left, right``: every anchor, a hash of its context and how far that goes."""
    before, after = _reach(long, gram)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch["text"])
            rows = np.asarray(batch["row"])
            for i, j in slices(offsets):
                part, cut = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                at, names = anchors(part, long, gram)
                doc = np.searchsorted(cut, at, "right") - 1
                inside = (at + gram <= cut[doc + 1]) & (cut[doc + 1] - cut[doc] >= long)
                at, names, doc = at[inside], names[inside], doc[inside]
                first, last = np.maximum(cut[doc], at - before), np.minimum(cut[doc + 1], at + after)
                context = span_hashes(part, first, last) + (at - first).astype(np.uint64) * MIX
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows[i + doc]),
                        pa.array((at - cut[doc]).astype(np.int32)),
                        pa.array(names.view(np.int64)),
                        pa.array(mixed(context).view(np.int64)),
                        pa.array((at - first).astype(np.int16)),
                        pa.array((last - at).astype(np.int16)),
                    ],
                    ["row", "pos", "name", "context", "left", "right"],
                )

    return run


def _leaf_rows(long: int, gram: int):
    """``name, context, right, left``: the bytes from each wanted anchor on, and those before it backwards."""
    before, after = _reach(long, gram)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].cast(pa.binary())
            wanted = batch["wanted"]
            each = wanted.value_lengths().to_pylist()
            pos, name, context = wanted.flatten().flatten()
            places, done = pos.to_pylist(), 0
            right, left = [], []
            for text, count in zip(texts, each):
                raw = text.as_py()
                for p in places[done : done + count]:
                    right.append(raw[p : p + after])
                    left.append(raw[max(0, p - before) : p][::-1])
                done += count
            for i in range(0, len(right), 20_000):
                one = slice(i, i + 20_000)
                yield pa.RecordBatch.from_arrays([name[one], context[one], pa.array(right[one], pa.binary()), pa.array(left[one], pa.binary())], ["name", "context", "right", "left"])

    return run


def _common(a: bytes, b: bytes) -> int:
    """Bytes that two strings have in common at the start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    return int((x != y).argmax())


class Ranges:
    """Cuts the suffix array into ranges at some leaves, and knows the depths of the intervals that lie across a cut."""

    def __init__(self, cuts: list[tuple[bytes, bytes]], gram: int):
        self.cuts, self.gram = cuts, gram
        self.depths: list[list[int]] = [[] for _ in cuts]

    def place(self, right: bytes, left: bytes) -> tuple[int, int, int]:
        """Range of a leaf and its common prefix with the cuts below and above (0 if less than a name)."""
        k = bisect.bisect_right(self.cuts, (right, left))
        return k, self._meets(k - 1, right) if k else 0, self._meets(k, right) if k < len(self.cuts) else 0

    def _meets(self, k: int, right: bytes) -> int:
        cut, back = self.cuts[k]
        if right[: self.gram] != cut[: self.gram] or (len(cut) == self.gram and not back):
            return 0  # a cut before all leaves of a name crosses no interval
        return _common(right, cut)

    @staticmethod
    def between(sample: list[tuple[bytes, bytes]], parts: int, gram: int) -> list[tuple[bytes, bytes]]:
        """Cuts at quantiles of a sorted sample, moved to where a name begins; only names that fill more than a range are cut inside."""
        cuts: set[tuple[bytes, bytes]] = set()
        for k in range(1, parts):
            leaf = sample[k * len(sample) // parts]
            begin = (leaf[0][:gram], b"")
            cuts.add(leaf if begin in cuts else begin)
        return sorted(cuts)

    def learn(self, seen: list[tuple[int, int]], least: int) -> None:
        """``seen``: cut and common prefix of leaves next to it. A leaf farther off meets a cut through those between."""
        own: list[set[int]] = [set() for _ in self.cuts]
        for cut, depth in seen:
            if depth >= least:
                own[cut].add(depth)
        links = [_common(a[0], b[0]) for a, b in zip(self.cuts, self.cuts[1:])]
        for order in (range(1, len(own)), range(len(own) - 2, -1, -1)):
            step = order.step
            for k in order:
                link = links[min(k, k - step)]
                own[k] |= {min(d, link) for d in own[k - step] if min(d, link) >= least}
        self.depths = [sorted(x) for x in own]


def _placed(ranges: Ranges):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [ranges.place(r, x) for r, x in zip(batch["right"].to_pylist(), batch["left"].to_pylist())]
            part, low, high = (pa.array(x, pa.int32()) for x in zip(*found)) if found else [pa.array([], pa.int32())] * 3
            yield pa.RecordBatch.from_arrays([part, low, high, *batch.columns], ["part", "low", "high", *batch.schema.names])

    return run


def _bytes_matrix(column: pa.ChunkedArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = flat(column)
    size = np.diff(offsets)
    out = np.zeros((len(size), width), np.uint8)
    fill = np.arange(len(data)) - np.repeat(offsets[:-1], size)
    out[np.repeat(np.arange(len(size)), size), fill] = data
    return out, size


def _agreement(rows: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common start of rows ``a`` and ``b``, pair by pair."""
    out = np.empty(len(a), np.int64)
    for i in range(0, len(a), 50_000):
        x, y = a[i : i + 50_000], b[i : i + 50_000]
        other = rows[x] != rows[y]
        first = np.where(other.any(axis=1), other.argmax(axis=1), rows.shape[1])
        out[i : i + 50_000] = np.minimum(first, np.minimum(size[x], size[y]))
    return out


def lcp_intervals(lcp: list[int], least: int) -> list[tuple[int, int, int]]:
    """First leaf, last leaf and depth of every interval of at least ``least``; ``lcp[i]`` is that of leaves i - 1 and i.

    The stack scan of Abouelhoda, Kurtz and Ohlebusch (2004).
    """
    found, stack = [], []  # of (first leaf, depth)
    for i in range(1, len(lcp) + 1):
        depth = lcp[i] if i < len(lcp) else 0
        first = i - 1
        while stack and stack[-1][1] > depth:
            first, top = stack.pop()
            found.append((first, i - 1, top))
        if depth >= least and (not stack or stack[-1][1] < depth):
            stack.append((first, depth))
    return found


def _scan(ranges: Ranges, long: int, gram: int):
    """Stack scan of one range. Rows without ``node``: how far a leaf's repeats reach. With: a leaf of an interval across a cut."""
    before, after = _reach(long, gram)
    schema = pa.schema(
        [("name", pa.int64()), ("context", pa.int64()), ("left", pa.int32()), ("right", pa.int32()), ("node", pa.binary()), ("back", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        right, right_size = _bytes_matrix(rows["right"], after)
        order = np.lexsort((right_size, right.view(f"S{after}").ravel()))  # sizes tell apart what differs in last zero bytes only
        rows, right, right_size = rows.take(pa.array(order)), right[order], right_size[order]
        left, left_size = _bytes_matrix(rows["left"], before)
        count = len(rows)
        lcp = np.zeros(count, np.int64)
        lcp[1:] = _agreement(right, right_size, np.arange(count - 1), np.arange(1, count))
        rank = np.empty(count, np.int64)
        rank[np.lexsort((left_size, left.view(f"S{before}").ravel()))] = np.arange(count)
        far_left, far_right = np.zeros(count, np.int64), np.zeros(count, np.int64)
        group: list[tuple[int, int, int]] = []
        size = 0
        intervals = lcp_intervals(lcp.tolist(), gram)
        for k, interval in enumerate(intervals):
            group.append(interval)
            size += interval[1] - interval[0] + 1
            if size > 200_000 or k + 1 == len(intervals):
                first, last, depth = np.array(group, np.int64).T
                width = last - first + 1
                node = np.repeat(np.arange(len(group)), width)
                leaf = np.repeat(first, width) + np.arange(len(node)) - np.repeat(np.cumsum(width) - width, width)
                by = np.lexsort((rank[leaf], node))
                node, leaf = node[by], leaf[by]
                same = np.flatnonzero(node[1:] == node[:-1])
                agree = _agreement(left, left_size, leaf[same], leaf[same + 1])
                reach = depth[node[same]]
                hit = agree + reach >= long
                for side in (leaf[same][hit], leaf[same + 1][hit]):
                    np.maximum.at(far_left, side, agree[hit])
                    np.maximum.at(far_right, side, reach[hit])
                group, size = [], 0
        ok = np.flatnonzero(far_right)
        name, context = np.asarray(rows["name"]), np.asarray(rows["context"])
        none = pa.nulls(len(ok), pa.binary())
        reach = [pa.array(x[ok].astype(np.int32)) for x in (far_left, far_right)]
        yield pa.RecordBatch.from_arrays([pa.array(name[ok]), pa.array(context[ok]), *reach, none, none], schema=schema)
        part = rows["part"][0].as_py()
        open_rows: list[tuple] = []
        for cut, column in ((part - 1, "low"), (part, "high")):
            if 0 <= cut < len(ranges.cuts):
                common = np.asarray(rows[column])
                for i in np.flatnonzero(common >= gram).tolist():
                    end, back = rows["right"][i].as_py(), rows["left"][i].as_py()
                    for depth in ranges.depths[cut]:
                        if depth <= common[i]:
                            node = hashlib.blake2b(end[:depth], digest_size=16).digest()
                            open_rows.append((name[i], context[i], 0, depth, node, back))
                    if len(open_rows) > OPEN_ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*open_rows), schema)], schema=schema)
                        open_rows = []
        if open_rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*open_rows), schema)], schema=schema)

    return run


def _extended(long: int):
    """Leaves of intervals across cuts, sorted by interval and what precedes: agreement with both neighbours.

    The first and last row of the partition come out again as edges, to be compared with the next partitions'.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, before, first = TaskContext.get().partitionId(), None, None
        out: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("name", "context", "right", "node", "back"))):
                if before is None:
                    first = row
                elif before[3] == row[3] and (agree := _common(before[4], row[4])) + row[2] >= long:
                    out += [(x[0], x[1], agree, row[2], None, None, None) for x in (before, row)]
                before = row
                if len(out) > 5000:
                    yield _extended_rows(out)
                    out = []
        if before is not None:
            out += [(x[0], x[1], None, x[2], x[3], x[4], 2 * part + k) for k, x in enumerate((first, before))]
            yield _extended_rows(out)

    return run


OPEN = "name: bigint, context: bigint, left: int, right: int, node: binary, back: binary"


def _extended_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int32()]
    names = ["name", "context", "left", "right", "node", "back", "edge"]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names)


def _tree_reach(leaves: DataFrame, long: int, gram: int, range_rows: int) -> DataFrame:
    """``name, context, left, right``: how far the repeats of each leaf with other leaves reach around its anchor.

    The intervals that count lie inside one name, so names are dealt to ranges as a whole; only a name with more leaves than
    ``WHOLE`` ranges hold has its part of the suffix array cut.
    """
    hot = checkpointed(leaves.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > WHOLE * range_rows).select("name"))
    deal = F.pmod(F.xxhash64("name"), F.lit(parts_for(leaves.count(), range_rows))).cast("int")
    whole = leaves.join(hot, "name", "left_anti").select(deal.alias("part"), "name", "context", "right", "left")
    scanned = whole.groupBy("part").applyInArrow(_scan(Ranges([], gram), long, gram), OPEN)
    closed = checkpointed(scanned.select("name", "context", "left", "right"))
    if hot.isEmpty():
        return closed
    return closed.unionByName(_cut_reach(checkpointed(leaves.join(hot, "name")), long, gram, range_rows))


def _cut_reach(leaves: DataFrame, long: int, gram: int, range_rows: int) -> DataFrame:
    """The same where the suffix array is cut at sampled leaves: intervals across a cut are sorted once more."""
    spark = leaves.sparkSession
    parts = parts_for(leaves.count(), range_rows)
    cuts: list[tuple[bytes, bytes]] = []
    if parts > 1:
        share = leaves.select("right", "left").orderBy(F.xxhash64("name", "context", F.lit(3))).limit(8 * parts).collect()
        sample = sorted((bytes(r["right"]), bytes(r["left"])) for r in share)
        cuts = Ranges.between(sample, parts, gram)
    ranges = Ranges(cuts, gram)
    schema = "part int, low int, high int, name bigint, context bigint, right binary, left binary"
    if cuts:
        near = leaves.mapInArrow(_placed(ranges), schema)
        seen = near.select((F.col("part") - 1).alias("cut"), F.col("low").alias("depth")).union(near.select("part", "high"))
        seen = seen.where(f"depth >= {gram}").distinct().collect()  # at most LONG numbers for each cut
        ranges.learn([(r["cut"], r["depth"]) for r in seen], gram)
    near = leaves.mapInArrow(_placed(ranges), schema)
    scanned = checkpointed(near.groupBy("part").applyInArrow(_scan(ranges, long, gram), OPEN))
    closed = scanned.where("node IS NULL").select("name", "context", "left", "right")
    if not cuts:
        return closed
    across = scanned.where("node IS NOT NULL").distinct()
    ordered = across.repartitionByRange("node", "back", "name", "context").sortWithinPartitions("node", "back", "name", "context")
    agreed = checkpointed(ordered.mapInArrow(_extended(long), OPEN + ", edge: int"))
    edges = agreed.where("edge IS NOT NULL").orderBy("edge").collect()  # two rows for each partition
    met = []
    for a, b in zip(edges[1::2], edges[2::2]):
        if a["node"] == b["node"] and (agree := _common(bytes(a["back"]), bytes(b["back"]))) + a["right"] >= long:
            met += [(x["name"], x["context"], agree, a["right"]) for x in (a, b)]
    columns = ["name", "context", "left", "right"]
    edge_rows = spark.createDataFrame(met, "name bigint, context bigint, left int, right int")
    return closed.unionByName(agreed.where("edge IS NULL").select(*columns)).unionByName(edge_rows)


def repeated_spans(texts: DataFrame, long: int = LONG, gram: int = GRAM, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``row, spans``: for every row of ``texts`` (``row, text``) that has any, the bytes covered by repeats.

    A byte is covered if it lies in a string of ``long`` bytes that starts anywhere else too. ``spans`` (start, end) may overlap.
    """
    found = checkpointed(
        texts.select("row", "text").mapInArrow(_anchor_rows(long, gram), "row bigint, pos int, name bigint, context bigint, left smallint, right smallint")
    )
    # a stored table, so that Spark may split the rows of a very frequent name in the join
    often = checkpointed(found.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name"))
    shared = checkpointed(found.join(often, "name"))
    least = F.min(F.struct("row", "pos", "left", "right"))
    classes = checkpointed(shared.groupBy("name", "context").agg(F.count(F.lit(1)).alias("n"), least.alias("one")))
    several = classes.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name")
    wanted = classes.join(several, "name").select(F.col("one.row").alias("row"), F.struct(F.col("one.pos").alias("pos"), "name", "context").alias("w"))
    wanted = wanted.groupBy("row").agg(F.collect_list("w").alias("wanted"))
    one_text = texts.select("row", "text").join(wanted, "row")
    leaves = checkpointed(one_text.mapInArrow(_leaf_rows(long, gram), "name bigint, context bigint, right binary, left binary"))
    own = classes.where(F.col("n") > 1).where(F.col("one.left") + F.col("one.right") >= long)
    own = own.select("name", "context", F.col("one.left").cast("int").alias("left"), F.col("one.right").cast("int").alias("right"))
    reach = own.unionByName(_tree_reach(leaves, long, gram, range_rows))
    reach = reach.groupBy("name", "context").agg(F.max("left").alias("before"), F.max("right").alias("after"))
    spans = shared.join(reach, ["name", "context"]).select(
        "row", F.struct((F.col("pos") - F.col("before")).alias("start"), (F.col("pos") + F.col("after")).alias("end")).alias("span")
    )
    return spans.distinct().groupBy("row").agg(F.collect_list("span").alias("spans"))


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, removed, count = [], [], []
        for text, spans in zip(batch["text"].cast(pa.binary()), batch["spans"].to_pylist()):
            raw, out, at, runs = text.as_py() or b"", [], 0, 0
            end = -1
            for a, b in sorted((s["start"], s["end"]) for s in spans or ()):
                if a > end:
                    out.append(raw[at:a])
                    runs += 1
                end = max(end, b)
                at = end
            out.append(raw[at:])
            data.append(b"".join(out))
            removed.append(len(raw) - len(data[-1]))
            count.append(runs)
        texts = [None if none else raw.decode("utf-8", "ignore") for raw, none in zip(data, batch["text"].is_null().to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch["row"], pa.array(data, pa.binary()), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(texts, pa.string())],
            ["row", "kept", "n_removed", "n_spans", "text"],
        )


def _removed(docs: DataFrame, long: int, gram: int, range_rows: int) -> DataFrame:
    """``row`` (the caller's columns), ``kept, n_removed, n_spans`` and the kept bytes as ``text`` without cut characters."""
    start(docs.sparkSession)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64("doc_id", "text").alias("key"), "text")
    spans = repeated_spans(rows.where(F.octet_length("text") >= long).select(F.col("key").alias("row"), "text"), long, gram, range_rows)
    joined = rows.join(spans.withColumnRenamed("row", "key"), "key", "left").select("row", "text", "spans")
    added = StructType.fromDDL("kept binary, n_removed bigint, n_spans bigint, text string")
    return joined.mapInArrow(_without, StructType([rows.schema["row"], *added]))


def remove_repeats(docs: DataFrame, long: int = LONG, gram: int = GRAM, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``docs`` (``doc_id, text, …``) with ``kept`` (remaining bytes of the text), ``n_removed`` and ``n_spans`` (removed runs).

    Every byte covered by a string of ``long`` bytes that also starts anywhere else, same text included, is removed; strings
    are judged on the input and never cross texts. Null and empty texts keep nothing and lose nothing. Repeated rows are
    texts of their own, so each long one goes. Columns called ``kept``, ``n_removed`` or ``n_spans`` are replaced. An
    empty table gives an empty result.
    """
    added = ("kept", "n_removed", "n_spans")
    others = [F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in (*added, "text")]
    return _removed(docs, long, gram, range_rows).select(*others, *added)


def without_repeats(docs: DataFrame, long: int = LONG, gram: int = GRAM, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``docs`` with its repeated passages cut out of ``text``; ``n_chars``, if there, is counted again. No row is dropped.

    Where a cut falls inside a character, what is left of that character goes too. A null text stays null.
    """
    columns = {c: F.col("row")[c] for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return _removed(docs, long, gram, range_rows).select(*[c.alias(n) for n, c in columns.items()])


def op9_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = remove_repeats(docs)
    return done.select("doc_id", (F.octet_length("kept") + F.col("n_removed")).alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
