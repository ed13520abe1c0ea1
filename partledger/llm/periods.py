"""Runs of words that repeat with a period, exactly, by internal pattern matching.

A run of smallest period q and of four periods at least holds a whole dyadic block of B words, B <= q < 2 B, that occurs again q
words on. So every dyadic block asks for its occurrences in the window that follows it: the smallest place in the block's
interval of the suffix array that is not below a given one, a range successor in a wavelet tree over the suffix array.
Occurrences at most B / 2 apart form one arithmetic progression (their distance is the block's own period); the distance from the
last of the block's own progression to the last of each following one is a candidate period. (If the block has a period
p <= B / 2 of its own, that stretch ends inside the run, p + q words after the block's start at the latest, and ends again q words
on: so last members correspond, whichever members lie in the window.) A candidate is extended both ways by the ranks of
prefix doubling and kept if it is long enough.

A block with a word that does not come again within the window has no occurrence there and is not asked for.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from partledger.llm.common import flat, slices, span_hashes, start, table, word_spans

TIMES = 4  # periods in a run; the method needs four
LEAST = 6  # words in a run
RUNS = "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed binary"
ADDED = ("runs", "collapsed")


class WaveletTree:
    """Wavelet tree (in its matrix layout) over a permutation of 0 … n - 1; all queries are arrays."""

    def __init__(self, values: np.ndarray):
        self.size = len(values)
        self.bits = max(1, int(self.size - 1).bit_length())
        self.zeros: list[np.ndarray] = []  # at each bit, how many zeros stand before each place
        for bit in reversed(range(self.bits)):
            high = (values >> bit) & 1 == 1
            before = np.zeros(self.size + 1, np.int32)
            np.cumsum(~high, out=before[1:])
            self.zeros.append(before)
            values = np.concatenate([values[~high], values[high]])

    def _below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values at the places ``low`` … ``high - 1`` are less than ``bound``."""
        count = np.zeros(len(low), np.int64)
        for bit, before in zip(reversed(range(self.bits)), self.zeros):
            up = (bound >> bit) & 1 == 1
            a, b = before[low], before[high]
            count += np.where(up, b - a, 0)
            low, high = np.where(up, before[-1] + low - a, a), np.where(up, before[-1] + high - b, b)
        return count

    def successor(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The smallest value of at least ``bound`` at the places ``low`` … ``high - 1``; ``size`` if there is none."""
        k = self._below(low, high, np.minimum(bound, self.size - 1))
        none = (k >= high - low) | (bound >= self.size)
        k = np.minimum(k, high - low - 1)
        found = np.zeros(len(low), np.int64)
        for bit, before in zip(reversed(range(self.bits)), self.zeros):
            a, b = before[low], before[high]
            up = k >= b - a
            k = np.where(up, k - (b - a), k)
            low, high = np.where(up, before[-1] + low - a, a), np.where(up, before[-1] + high - b, b)
            found |= up.astype(np.int64) << bit
        return np.where(none, self.size, found)


class Index:
    """Suffix array, ranks of all dyadic lengths and wavelet tree over the words of some texts."""

    def __init__(self, words: np.ndarray, cuts: np.ndarray):
        size, longest = len(words), int(np.diff(cuts).max())
        self.begin, self.end = np.repeat(cuts[:-1], np.diff(cuts)), np.repeat(cuts[1:], np.diff(cuts))
        self.ranks = [np.unique(words, return_inverse=True)[1].astype(np.int32) + 1]  # 0: past the text's end
        step, order = 1, None
        while True:
            now = self.ranks[-1]
            if step >= longest or int(now.max()) == size:
                break
            follower = np.zeros(size, np.int64)
            there = np.flatnonzero(np.arange(size) + step < self.end)
            follower[there] = now[there + step]
            key = now * np.int64(size + 1) + follower
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            rank = np.empty(size, np.int32)
            rank[order] = np.cumsum(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            self.ranks.append(rank)
            step *= 2
        self.suffixes = np.argsort(self.ranks[-1], kind="stable") if order is None else order
        self.tree = WaveletTree(self.suffixes)

    def interval(self, blocks: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the suffixes that start with each block of ``2 ** level`` words stand in the suffix array."""
        rank = self.ranks[min(level, len(self.ranks) - 1)]
        ordered = rank[self.suffixes]
        return np.searchsorted(ordered, rank[blocks], "left"), np.searchsorted(ordered, rank[blocks], "right")

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from ``a`` and from ``b`` > ``a`` on are equal; both lie in one text."""
        end, first = self.end[a], a
        for level in reversed(range(len(self.ranks))):
            rank, size = self.ranks[level], len(self.end) - 1
            same = (b + (1 << level) <= end) & (rank[np.minimum(a, size)] == rank[np.minimum(b, size)])
            a, b = np.where(same, a + (1 << level), a), np.where(same, b + (1 << level), b)
        return a - first

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before ``a`` and before ``b`` > ``a`` are equal."""
        begin, last = self.begin[a], a
        for level in reversed(range(len(self.ranks))):
            rank, by = self.ranks[level], 1 << level
            same = (a - by >= begin) & (rank[np.maximum(a - by, 0)] == rank[np.maximum(b - by, 0)])
            a, b = np.where(same, a - by, a), np.where(same, b - by, b)
        return last - a

    def _last(self, at: np.ndarray, following: np.ndarray, block: int) -> np.ndarray:
        """The last member of the progression of occurrences that ``at`` is in; ``following`` is the next occurrence."""
        last, near = at.copy(), np.flatnonzero(following - at <= block // 2)
        a, period = at[near], following[near] - at[near]
        stretch = period + self.forward(a, a + period)
        last[near] = a + (stretch - block) // period * period
        return last

    def candidates(self, blocks: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """A place and a period for every progression of occurrences in the window after each block."""
        block = 1 << level
        low, high = self.interval(blocks, level)
        end = self.end[blocks]

        def next_from(rows: np.ndarray, bound: np.ndarray) -> np.ndarray:
            found = self.tree.successor(low[rows], high[rows], bound)
            return np.where(found < end[rows], found, end[rows] + 2 * block)  # none in this text: out of any window

        rows = np.arange(len(blocks))
        own = self._last(blocks, next_from(rows, blocks + 1), block)
        found = next_from(rows, own + 1)
        places, periods = [], []
        while len(rows):
            near = found < np.minimum(own + 2 * block, end[rows])
            rows, own, found = rows[near], own[near], found[near]
            last = self._last(found, next_from(rows, found + 1), block)
            period = last - own
            good = (period >= block) & (period < 2 * block)
            places.append(own[good])
            periods.append(period[good])
            found = next_from(rows, last + 1)
        return np.concatenate(places), np.concatenate(periods)


def _asking_blocks(words: np.ndarray, cuts: np.ndarray) -> list[np.ndarray]:
    """Per level, the dyadic blocks (counted from their text's start) all of whose words come again within the window."""
    size = len(words)
    text = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    end = np.repeat(cuts[1:], np.diff(cuts))
    place = np.arange(size) - np.repeat(cuts[:-1], np.diff(cuts))
    order = np.lexsort((words, text))
    gap = np.full(size, size + 1)
    same = (words[order[1:]] == words[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
    gap[order[:-1][same]] = (order[1:] - order[:-1])[same]
    out, blocks, block = [], np.arange(size), 1
    while len(blocks):
        out.append(blocks[(gap < 2 * block) & (blocks + 2 * block <= end[blocks])])
        pairs = np.flatnonzero((place[blocks] % (2 * block) == 0) & (blocks + 2 * block <= end[blocks]))
        gap = np.maximum(gap[pairs], gap[np.minimum(pairs + 1, len(gap) - 1)])
        blocks = blocks[pairs]
        block *= 2
    return out


def runs_of(words: np.ndarray, cuts: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and smallest period of every run in texts of word numbers, one text after the other, by start and period.

    Only the texts in which a block asks for its occurrences are indexed.
    """
    asking = _asking_blocks(words, cuts)
    busy = np.zeros(len(cuts) - 1, bool)
    for blocks in asking:
        busy[np.searchsorted(cuts, blocks, "right") - 1] = True
    if not busy.any():
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    inside = np.repeat(busy, np.diff(cuts))
    origin = np.flatnonzero(inside)
    moved = np.cumsum(inside) - 1
    index = Index(words[inside], np.concatenate([[0], np.cumsum(np.diff(cuts)[busy])]))
    found = []
    for level, blocks in enumerate(asking):
        if len(blocks):
            at, period = index.candidates(moved[blocks], level)
            begin = at - index.backward(at, at + period)
            end = at + period + index.forward(at, at + period)
            long = end - begin >= np.maximum(least, TIMES * period)
            found.append(np.stack([begin[long], end[long], period[long]]))
    begin, end, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, end, begin))
    begin, end, period = begin[order], end[order], period[order]
    first = np.ones(len(begin), bool)  # of the periods of one stretch the smallest is the run's
    first[1:] = (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])
    begin, end, period = begin[first], end[first], period[first]
    order = np.lexsort((period, begin))
    return origin[begin[order]], origin[end[order] - 1] + 1, period[order]


def _run_rows(least: int):
    kinds = {"start": pa.int64(), "length": pa.int64(), "period": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch["text"].cast(pa.binary())
            data, offsets = flat(column)
            for i, j in slices(offsets):
                part, bounds = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                starts, ends = word_spans(part, bounds)
                cuts = np.searchsorted(starts, bounds)
                begin, end, period = runs_of(span_hashes(part, starts, ends), cuts, least)
                text = np.searchsorted(cuts, begin, "right") - 1
                drop = np.zeros(len(starts) + 1, np.int64)
                np.add.at(drop, begin + period, 1)
                np.subtract.at(drop, end, 1)
                stays = np.cumsum(drop[:-1]) == 0
                counts = np.bincount(text, minlength=j - i)
                kept = []
                for k, raw in enumerate(column[i:j]):
                    own = (raw.as_py() or b"").split()  # at ASCII white space
                    kept.append(b" ".join(compress(own, stays[cuts[k] : cuts[k + 1]].tolist()) if counts[k] else own))
                values = [begin - cuts[text], end - begin, period]
                fields = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in values], list(kinds))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), fields)
                yield pa.RecordBatch.from_arrays([batch["row"][i:j], lists, pa.array(kept, pa.binary())], ["row", *ADDED])

    return run


def find_runs(docs: DataFrame, least: int = LEAST, text: Column | None = None) -> DataFrame:
    """``docs`` with ``runs`` (start, length, period; by start, then period) and ``collapsed`` of each ``text``.

    Words are runs of bytes other than ASCII white space, numbered from 0. A run is a stretch of words of smallest period q,
    of ``least`` words and four periods at least, that no neighbouring word extends keeping q. ``collapsed`` joins by one space
    the words that no run holds after its first q words. ``text`` may give another text to look at than the column.

    Null and empty texts have no runs and collapse to the empty text; texts of any length are taken whole (a text of n words
    takes about 8 n log n bytes in its task). Runs of equal start are told apart by their period. Repeated rows give equal
    results, each its own. An empty table gives an empty result. Other columns stay; ``runs`` and ``collapsed`` are replaced.
    """
    start(docs.sparkSession)
    rows = docs.select(F.struct(*docs.columns).alias("row"), (F.col("text") if text is None else text).alias("text"))
    schema = StructType(rows.select("row").schema.fields + StructType.fromDDL(RUNS).fields)
    done = rows.mapInArrow(_run_rows(least), schema)
    others = [F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in ADDED]
    return done.select(*others, "runs", F.col("collapsed").cast("string").alias("collapsed"))


def planted() -> Column:
    """The text of the query: every tenth document, by the checksum of its id, repeats its words with a period from some word on."""
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def repeated(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        times = F.ceil((n - a) / p).cast("int")
        tail = F.flatten(F.array_repeat(F.slice(w, (a + 1).cast("int"), p.cast("int")), times))
        return F.array_join(F.concat(F.slice(w, F.lit(1), a.cast("int")), F.slice(tail, F.lit(1), (n - a).cast("int"))), " ")

    # the words are bound to a variable, so that they are split once
    return F.when((h % 10 == 0) & (F.length("text") > 0), F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)))[0]).otherwise(F.col("text"))


def op13_periodic_runs(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = find_runs(docs, text=planted()).select("doc_id", "runs", "collapsed")
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    top = done.withColumn("top", top)
    return top.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.start")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"),
        F.floor(F.lit(1000) * F.col("top.length") / -F.col("top.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
