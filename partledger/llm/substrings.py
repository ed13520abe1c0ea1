"""Repeated windows of words, exactly, by level-wise doubling.

Level 1 takes windows of half the wanted length. Of every run of consecutive windows that lie in one wanted window the one of
smallest hash is a candidate, so two equal wanted windows have a candidate at the same place; candidates found in one document
only die. Level 2 doubles: every wanted window around a surviving candidate is named by the names of its two halves and
survives if two documents hold it. From then on two surviving windows, one right behind the other, are a window of twice
their length, again named by its halves, until none survives; no window is left out.

Texts that are equal as a whole are settled first: only the one of smallest id is cut into windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from partledger.llm.common import MIX, _power_tables, checkpointed, flat, maybe_in, mixed, slices, span_hashes, start, table, word_spans

WORDS = 50  # consecutive words of a window that counts; even
NO_ID = 2**63 - 1  # stands for a null id: after all others
ADDED = ("kept", "n_words", "n_removed", "longest")


class Windows:
    """Hashes of windows of words, of any length, from one running polynomial over the words of some texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        starts, ends = word_spans(data, offsets)
        self.cuts = np.searchsorted(starts, offsets)  # where each text's words begin
        power, self.inverse = _power_tables(len(starts))
        self.total = np.zeros(len(starts) + 1, np.uint64)
        np.cumsum(span_hashes(data, starts, ends) * power[: len(starts)], out=self.total[1:])

    def hashes(self, first: np.ndarray, length: int) -> np.ndarray:
        value = (self.total[first + length] - self.total[first]) * self.inverse[first]
        return mixed(value + np.uint64(length) * MIX)

    def candidates(self, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, first word (among all) and hash of the half windows of smallest hash in any window of ``words``."""
        half = words // 2
        width = words - half + 1  # half windows in a window
        count = len(self.total) - 1
        if count < words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        value = self.hashes(np.arange(count - half + 1), half)
        least = _extreme(value, width, np.minimum)  # of the window from each word on
        room = np.repeat(self.cuts[1:], np.diff(self.cuts))[: len(least)] - np.arange(len(least))
        least[room < words] = 0  # such a window leaves its text
        edge = np.zeros(width - 1, np.uint64)
        most = _extreme(np.concatenate([edge, least, edge]), width, np.maximum)  # over the windows that hold a half window
        at = np.flatnonzero((value == most) & (most > 0))
        text = np.searchsorted(self.cuts, at, "right") - 1
        inside = at + half <= self.cuts[text + 1]
        return text[inside], at[inside], value[at[inside]]


def _extreme(value: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each run of ``width`` values."""
    n = 1
    while 2 * n <= width:
        value = pick(value[:-n], value[n:])
        n *= 2
    return pick(value[: len(value) - (width - n)], value[width - n :]) if width > n else value


def _candidate_rows(words: int):
    """``key, pos, name``: the first level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch["text"].cast(pa.binary()))
            for i, j in slices(offsets):
                windows = Windows(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                text, at, name = windows.candidates(words)
                pos = pa.array((at - windows.cuts[text]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch["key"].take(pa.array(i + text)), pos, pa.array(name.view(np.int64))], ["key", "pos", "name"])

    return run


def _halves(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A window's name from those of its halves: 64 and 32 bits."""
    return mixed(a + b * MIX).view(np.int64), mixed(b ^ a * MIX).astype(np.uint32).view(np.int32)


def _window_rows(words: int):
    """``id, sum, pos, name, check``: every window around a surviving candidate, named by its halves."""
    half = words // 2
    schema = pa.schema([("id", pa.int64()), ("sum", pa.int32()), ("pos", pa.int32()), ("name", pa.int64()), ("check", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch["text"].cast(pa.binary()))
            places = batch["places"].to_pylist()
            for i, j in slices(offsets):
                windows = Windows(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                cuts = windows.cuts
                held = [np.unique(np.array(places[k], np.int64)) + cuts[k - i] for k in range(i, j)]
                begins = np.concatenate(held)
                text = np.repeat(np.arange(j - i), [len(x) for x in held])
                mark = np.zeros(cuts[-1] + 2, np.int64)  # a window may begin up to half a window before its candidate
                np.add.at(mark, np.maximum(cuts[text], begins - (words - half)), 1)
                np.add.at(mark, begins + 1, -1)
                at = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
                of = np.searchsorted(cuts, at, "right") - 1
                inside = at + words <= cuts[of + 1]
                at, of = at[inside], of[inside]
                name, check = _halves(windows.hashes(at, half), windows.hashes(at + half, half))
                rows = pa.array(i + of)
                pos = pa.array((at - cuts[of]).astype(np.int32))
                columns = [batch["id"].take(rows), batch["sum"].take(rows), pos, pa.array(name), pa.array(check)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _doubled(windows: DataFrame, length: int) -> DataFrame:
    """``id, sum, pos, name, check``: the windows of ``2 length`` words both halves of which are among these windows of ``length`` words."""
    halves = Window.partitionBy("id", "sum").orderBy("pos").rangeBetween(length, length)
    second = [F.max(c).over(halves).alias(f"{c}2") for c in ("name", "check")]
    both = windows.select("id", "sum", "pos", "name", "check", *second).where("name2 IS NOT NULL")
    names = ("name", "name2", "check", "check2")
    return both.select("id", "sum", "pos", F.xxhash64(*names).alias("name"), F.hash(*names).alias("check"))


def _shared(rows: DataFrame, of: str, *name: str) -> DataFrame:
    """Names that more than one ``of`` holds, with the smallest.

    A stored table, so that Spark may split the rows of a very frequent name in the join with it.
    """
    holders = rows.groupBy(*name).agg(F.min(of).alias("least"), F.max(of).alias("most"))
    return checkpointed(holders.where("least < most").select(*name, "least"))


def repeated_windows(texts: DataFrame, words: int = WORDS) -> DataFrame:
    """``key, sum, first, places, longest`` for the texts of ``texts`` (``id, key, sum, text``) that are repeated in whole or part.

    ``key`` and ``sum`` are hashes of the text, ``first`` is the smallest id that has it. ``places``: first words of windows of
    ``words`` words that start in a different text of smaller id too (null: none). ``longest``: the greatest of the lengths ``words``,
    ``2 words``, ``4 words``, … at which one of its windows is in a text of another id too.
    """
    if words < 2 or words % 2:
        raise ValueError("words must be even")
    texts = texts.where(F.octet_length("text") >= 2 * words - 1)
    owners = checkpointed(texts.groupBy("key", "sum").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("rows")))
    found = checkpointed(texts.mapInArrow(_candidate_rows(words), "key bigint, pos int, name bigint"))
    alive = found.join(_shared(found, "key", "name"), "name").groupBy("key").agg(F.collect_set("pos").alias("places"))
    alive = checkpointed(alive.join(owners, "key"))
    around = maybe_in(texts, alive, "key").join(alive, ["id", "key", "sum"])
    level = "id bigint, sum int, pos int, name bigint, check int"
    windows = checkpointed(around.select("id", "sum", "text", "places").mapInArrow(_window_rows(words), level))
    repeated = windows.join(_shared(windows, "id", "name", "check"), ["name", "check"])
    kept = checkpointed(repeated.select("id", "sum", "pos", "name", "check", (F.col("id") > F.col("least")).alias("later")))
    reached = kept.groupBy("id", "sum").agg(F.collect_list(F.when(F.col("later"), F.col("pos"))).alias("places"), F.lit(words).alias("longest"))
    reached, length = [reached], words
    while True:
        longer = checkpointed(_doubled(kept, length))
        kept = checkpointed(longer.join(_shared(longer, "id", "name", "check"), ["name", "check"]).drop("least"))
        if kept.isEmpty():
            break
        length *= 2
        reached.append(kept.select("id", "sum").distinct().select("id", "sum", F.lit(None).cast("array<int>").alias("places"), F.lit(length).alias("longest")))
    parts = reached[0]
    for one in reached[1:]:
        parts = parts.unionByName(one)
    parts = parts.groupBy("id", "sum").agg(F.max("places").alias("places"), F.max("longest").cast("long").alias("longest"))
    done = owners.join(parts, ["id", "sum"], "left").where("rows > 1 OR longest IS NOT NULL")
    return checkpointed(done.select("key", "sum", F.col("id").alias("first"), "places", "longest"))


def _kept_rows(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, count, removed = [], [], []
            for raw, places, copy in zip(batch["text"].cast(pa.binary()), batch["places"], batch["copy"].to_pylist()):
                own = (raw.as_py() or b"").split()  # at ASCII white space
                count.append(len(own))
                if copy and len(own) >= words:
                    own = []
                elif places.as_py():
                    mark = np.zeros(len(own) + 1, np.int64)
                    at = np.unique(np.array(places.as_py(), np.int64))
                    mark[at] += 1
                    np.subtract.at(mark, at + words, 1)
                    own = list(compress(own, (np.cumsum(mark[:-1]) == 0).tolist()))
                removed.append(count[-1] - len(own))
                kept.append(b" ".join(own))
            longest = batch["longest"].fill_null(0)
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array(kept, pa.binary()), pa.array(count, pa.int64()), pa.array(removed, pa.int64()), longest],
                ["row", *ADDED],
            )

    return run


def remove_repeated_windows(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``docs`` (``doc_id, text, …``) with ``kept, n_words, n_removed, longest``.

    A word (a run of bytes other than ASCII white space) goes if a window of ``words`` consecutive words of its text covers it
    whose word sequence also starts in a document of smaller ``doc_id`` (a whole number). Windows are judged on the input.
    ``kept`` joins the other words by one space; ``longest`` is the greatest doubled length found in a different text (0: none).

    Null and empty texts have no words, keep the empty text and lose nothing; texts of any length are taken whole. A null id
    stands after all ids (like the largest 64-bit number, with which it is equal). Rows of equal id never take words from
    each other, so repeated rows stay alike. An empty table gives an empty result. Other columns stay; columns
    with one of the four names are replaced.
    """
    start(docs.sparkSession)
    ids = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id")
    rows = docs.select(F.struct(*docs.columns).alias("row"), ids, F.xxhash64("text").alias("key"), F.hash("text").alias("sum"), "text")
    found = repeated_windows(rows.select("id", "key", "sum", "text"), words)
    joined = rows.join(found, ["key", "sum"], "left")
    schema = rows.select("row").schema.add("kept", "binary").add("n_words", "long").add("n_removed", "long").add("longest", "long")
    done = joined.select("row", "text", "places", "longest", (F.col("id") > F.col("first")).alias("copy")).mapInArrow(_kept_rows(words), schema)
    others = [F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in ADDED]
    return done.select(*others, F.col("kept").cast("string").alias("kept"), *ADDED[1:])


def op12_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = remove_repeated_windows(docs)
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), "longest")
