"""Many random forests grown together, level by level, from one binned table.

Features are binned once. A tree's bootstrap weight of a row and its choice of features at a node are hashes of row, tree and node, so
a tree is the same wherever and in whatever order it is grown. A shallower tree is the cut of a deeper one at a depth, a tree with
a larger ``min_split`` its cut at small nodes, a smaller forest a prefix of a larger one: one deep forest a fold answers for all points
of a parameter grid.

Nodes with more than ``LOCAL_ROWS`` rows are split by histograms that Spark adds up over the whole table, level by level and all trees
together; what hangs below goes to tasks as a whole, one node of one tree each with the rows that reach it. A table of no more than
``LOCAL_ROWS`` rows (some tens of megabytes of bins) starts there: it is sent to the tasks, each of which grows some trees.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from partledger.session import checkpointed, ship_package

BINS = 128
LOCAL_ROWS = 2_000_000
TREES_AT_ONCE = 25  # of one task
DRAWS_AT_ONCE = 6_000_000  # rows times trees that a task grows together; fewer trees if the table is longer
MAX_DEPTH = 60  # "no limit": a node's number, a path of left and right turns, has to fit 64 bits
NODES = "job int, tree int, node bigint, depth int, n bigint, clean bigint, fraud bigint, p double, feature int, code int, gain double"
_KINDS = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.float64()]
_DRAWS = np.add.outer(np.arange(16.0), np.arange(16) * float(1 << 26)).ravel()  # a byte: draws of a clean row, times 16, or of a fraud one
_POISSON = np.cumsum(np.exp(-1.0) / np.array([1, 1, 2, 6, 24, 120, 720, 5040, 40320], float))  # of mean 1


@dataclass(frozen=True)
class Job:
    """A training set: the rows outside ``fold`` of ``repeat``, or all rows; ``clean`` and ``fraud`` balance the classes."""

    number: int
    repeat: int | None
    fold: int | None
    clean: float
    fraud: float


@dataclass(frozen=True)
class Rules:
    trees: int
    depth: int | None
    min_split: int
    seed: int

    @property
    def deepest(self) -> int:
        return MAX_DEPTH if self.depth is None else min(self.depth, MAX_DEPTH)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tree_seeds(trees: np.ndarray, seed: int) -> np.ndarray:
    return _mixed(trees.astype(np.uint64) + np.uint64(seed % 2**32 << 32) + np.uint64(0x9E3779B97F4A7C15))


def bootstrap(rows: np.ndarray, trees: np.ndarray, seed: int) -> np.ndarray:
    """How often each tree (first axis) draws each row: Poisson of mean 1, by hash."""
    drawn = _mixed(rows.view(np.uint64)[None, :] ^ _tree_seeds(trees, seed)[:, None])
    return np.searchsorted(_POISSON, drawn.astype(np.float64) / 2.0**64, "right").astype(np.int64)


def feature_order(tree_seed: np.ndarray, node: np.ndarray, features: int) -> np.ndarray:
    """All features in the random order in which each node tries them."""
    at_node = _mixed(tree_seed ^ _mixed(node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    return np.argsort(_mixed(at_node[:, None] + np.arange(1, features + 1, dtype=np.uint64)[None, :]), axis=1)


def _by_cell(slot, code, clean, fraud, slots: int):
    """Cells (256 times slot, plus code) in rising order with their counts; a cell may come several times. Whole numbers, so exact."""
    key = slot * np.int64(256) + code
    if slots <= len(key) >> 6 and clean.sum() + fraud.sum() < 1 << 26:  # few cells: a histogram, both counts in one number
        both = np.bincount(key, clean + fraud * float(1 << 26)).astype(np.int64)
        key = np.flatnonzero(both)
        both = both[key]
        return key, both & (1 << 26) - 1, both >> 26
    if len(key) and max(clean.max(), fraud.max()) < 16:  # few rows a cell: sorted as one number
        both = key << 8
        both |= clean << 4
        both |= fraud
        both.sort()
        return both >> 8, both >> 4 & 15, both & 15
    order = np.argsort(key)
    return key[order], clean[order], fraud[order]


def best_cuts(slot, code, clean, fraud, all_clean, all_fraud, weight_clean, weight_fraud):
    """Best cut of each slot by one feature: slots that have one, its code (rows up to it go left) and its score.

    ``slot, code, clean, fraud`` are rows (or sums of rows) and their drawn counts; the others are per slot. The score is the sum over
    both sides of squared class weights by weight, so the highest one has the lowest Gini impurity; ties go to the lowest code.
    """
    return _cuts(*_by_cell(slot, code, clean, fraud, len(all_clean)), all_clean, all_fraud, weight_clean, weight_fraud)


def _cuts(key, clean, fraud, all_clean, all_fraud, weight_clean, weight_fraud):
    """``best_cuts`` from cells in rising order."""
    below_clean, below_fraud = np.cumsum(clean), np.cumsum(fraud)
    end = np.flatnonzero((key[1:] != key[:-1]) & (key[1:] >> 8 == key[:-1] >> 8))
    if not len(end):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    of = key[end] >> 8
    left_clean = (below_clean[end] - (np.cumsum(all_clean) - all_clean)[of]) * weight_clean[of]
    left_fraud = (below_fraud[end] - (np.cumsum(all_fraud) - all_fraud)[of]) * weight_fraud[of]
    right_clean, right_fraud = all_clean[of] * weight_clean[of] - left_clean, all_fraud[of] * weight_fraud[of] - left_fraud
    score = (left_clean**2 + left_fraud**2) / (left_clean + left_fraud) + (right_clean**2 + right_fraud**2) / (right_clean + right_fraud)
    first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    top = np.maximum.reduceat(score, first)
    hit = np.flatnonzero(score == np.repeat(top, np.diff(np.append(first, len(of)))))
    hit = hit[np.append(True, of[hit][1:] != of[hit][:-1])]
    return of[hit], key[end[hit]] & 255, top


def _few_or_sums(key, draws, sums):
    """``_by_cell`` for rows whose class and draws are one byte each; ``sums`` has what ``_DRAWS`` says of it if cells are few."""
    if sums is not None:
        both = np.bincount(key, sums)
        key = np.flatnonzero(both)
        both = both[key].astype(np.int64)
        return key, both & (1 << 26) - 1, both >> 26
    both = key << 8
    both |= draws
    both.sort()
    return both >> 8, both >> 4 & 15, both & 15


def choose_splits(features: int, tries: int, wanted, order, slot, codes, begin, draws, all_clean, all_fraud, weight_clean, weight_fraud):
    """Feature (-1: none), code and score of the split of each slot marked in ``wanted``.

    A slot looks at the first ``tries`` features of its order; only if none of them can be cut it goes on to the next ones.
    A row's codes begin at ``begin`` in ``codes``; rows of a slot that is done are left out.
    """
    count = len(wanted)
    feature, code, score = np.full(count, -1, np.int64), np.zeros(count, np.int64), np.full(count, -np.inf)
    left = wanted.copy()
    for start in range(0, features, tries):
        if not left.any():
            break
        ids = np.flatnonzero(left)
        if len(ids) == count:
            own, at_row, drawn = slot, begin, draws
        else:
            rows = np.flatnonzero(left.take(slot))
            own, at_row, drawn = (np.cumsum(left) - 1).take(slot.take(rows)), begin.take(rows), draws.take(rows)
        cell, per_slot = own << 8, [x[ids] for x in (all_clean, all_fraud, weight_clean, weight_fraud)]
        sums = _DRAWS.take(drawn) if len(ids) <= len(own) >> 6 else None
        for j in range(start, min(features, start + tries)):
            place = order[ids, j].take(own)
            place += at_row
            at, cut, found = _cuts(*_few_or_sums(cell + codes.take(place), drawn, sums), *per_slot)
            better = found > score[ids[at]]
            at = ids[at[better]]
            feature[at], code[at], score[at] = order[at, j], cut[better], found[better]
        left &= feature < 0
    return feature, code, score


def grow(
    codes: np.ndarray, fraud: np.ndarray, slot: np.ndarray, row: np.ndarray, drawn: np.ndarray, roots: dict[str, np.ndarray], rules: Rules,
    held_slot: np.ndarray, held_row: np.ndarray, cuts: tuple[Sequence[int | None], Sequence[int]] | None,
) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Grow all trees (or parts of trees) below ``roots`` together.

    ``slot, row, drawn``: which root a drawn row belongs to and how often it is drawn. ``roots`` has ``tree, seed, node, depth, clean,
    fraud`` (class weights). Returns the nodes and, for each held-out row (``held_slot, held_row``), the fraud share of the leaf
    that it reaches in the tree cut at each depth and ``min_split`` of ``cuts``.
    """
    features, flat = codes.shape[1], codes.ravel()
    tries = max(1, int(np.sqrt(features)))
    depths, splits = ([rules.deepest], [rules.min_split]) if cuts is None else cuts
    depths = [MAX_DEPTH if d is None else d for d in depths]
    shares = np.zeros((len(held_row), len(depths), len(splits)))
    fixed = np.zeros((len(held_row), len(splits)), bool)
    live = np.arange(len(held_row))
    now, nodes = {k: v.copy() for k, v in roots.items()}, []
    slot, begin = slot.astype(np.int64), row.astype(np.int64) * features
    draws = np.where(fraud[row] == 1, drawn, drawn << 4).astype(np.uint8)
    while len(now["node"]):
        count = len(now["node"])
        n = np.bincount(slot, minlength=count)
        both = np.bincount(slot, _DRAWS.take(draws), count).astype(np.int64)
        good, bad = both & (1 << 26) - 1, both >> 26
        a, b = good * now["clean"], bad * now["fraud"]
        with np.errstate(invalid="ignore"):
            p = np.where(a + b > 0, b / (a + b), 0.0)
            own = np.where(a + b > 0, (a * a + b * b) / (a + b), 0.0)
        wanted = (good > 0) & (bad > 0) & (n >= max(2, rules.min_split)) & (now["depth"] < rules.deepest)
        order = feature_order(now["seed"], now["node"], features)
        feature, code, score = choose_splits(features, tries, wanted, order, slot, flat, begin, draws, good, bad, now["clean"], now["fraud"])
        split = feature >= 0
        gain = np.where(split, score - own, 0.0)
        nodes.append(dict(tree=now["tree"], node=now["node"], depth=now["depth"], n=n, clean=good, fraud=bad, p=p, feature=feature, code=code, gain=gain))
        if len(live):
            at = held_slot.take(live)
            level, share, size, ended = (x.take(at) for x in (now["depth"], p, n, ~split))
            for j, least in enumerate(splits):
                open_ = ~fixed[live, j]
                stop = np.flatnonzero(open_ & (ended | (size < least)))
                for i, depth in enumerate(depths):
                    reached = [stop.compress(level.take(stop) < depth)]
                    if (now["depth"] == depth).any():
                        reached.append(np.flatnonzero(open_ & (level == depth)))
                    for some in reached:
                        shares[live.take(some), i, j] = share.take(some)
                fixed[live.take(stop), j] = True
            live = live[~ended & (level < max(depths)) & ~fixed[live].all(axis=1)]
        first = 2 * (np.cumsum(split) - 1)  # slot of the left child
        if not split.all():
            stays = np.flatnonzero(split.take(slot))
            slot, begin, draws = slot.take(stays), begin.take(stays), draws.take(stays)
        place = feature.take(slot)
        place += begin
        right = flat.take(place) > code.astype(np.uint8).take(slot)
        slot = first.take(slot)
        slot += right
        at = held_slot[live]
        held_slot = held_slot.copy()
        held_slot[live] = first[at] + (flat[held_row[live] * features + feature[at]] > code[at])
        keep = np.repeat(np.flatnonzero(split), 2)
        turn = np.tile([0, 1], len(keep) // 2)
        now = {k: v[keep] for k, v in now.items()} | {"node": now["node"][keep] * 2 + turn, "depth": now["depth"][keep] + 1}
    return {k: np.concatenate([x[k] for x in nodes]) for k in nodes[0]}, shares


def bin_limits(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Up to ``bins - 1`` limits per feature, at evenly spaced quantiles; a value up to a limit lies left of it."""
    found = df.approxQuantile(list(features), [k / bins for k in range(1, bins)], 0.1 / bins)
    return [sorted(set(x)) for x in found]


def binned(df: DataFrame, features: Sequence[str], limits: list[list[float]], keep: Sequence[str]) -> DataFrame:
    """``keep`` and ``codes``: one byte per feature, the number of limits below its value; null and NaN are 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((len(batch), len(features)), np.uint8)
            for k, name in enumerate(features):
                value = batch[f"_x{k}"].to_numpy(zero_copy_only=False).astype(float)
                out[:, k] = np.where(np.isnan(value), 0, np.searchsorted(limits[k], value, "left"))
            codes = pa.array([r.tobytes() for r in out], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), codes], [*keep, "codes"])

    numbers = [F.col(c).cast("double").alias(f"_x{k}") for k, c in enumerate(features)]
    return df.select(*keep, *numbers).mapInArrow(run, df.select(*keep).schema.add("codes", "binary"))


def code_matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Equally long byte strings as the rows of a matrix."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    parts = []
    for chunk in chunks:
        if len(chunk):
            at = np.frombuffer(chunk.buffers()[1], np.int64 if pa.types.is_large_binary(chunk.type) else np.int32)[chunk.offset : chunk.offset + len(chunk) + 1]
            parts.append(np.frombuffer(chunk.buffers()[2], np.uint8)[at[0] : at[-1]])
    whole = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
    return whole.reshape(len(column), -1) if len(column) else whole.reshape(0, 0)


def place_matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Equally long lists of folds as the rows of a matrix."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    parts = [chunk.flatten().to_numpy(zero_copy_only=False).astype(np.int16) for chunk in chunks]
    whole = np.concatenate(parts) if parts else np.zeros(0, np.int16)
    return whole.reshape(len(column), -1) if len(column) else whole.reshape(0, 0)


@dataclass
class Table:
    """The binned rows in memory: at most ``LOCAL_ROWS``, some bytes each."""

    row: np.ndarray
    fraud: np.ndarray
    codes: np.ndarray
    places: np.ndarray  # fold of each row in each repeat

    @staticmethod
    def of(rows: pa.Table) -> Table:
        row = rows["row"].to_numpy()
        order = np.argsort(row)
        return Table(row[order], rows["fraud"].to_numpy()[order].astype(np.int8), code_matrix(rows["codes"])[order], place_matrix(rows["places"])[order])

    def split(self, job: Job) -> tuple[np.ndarray, np.ndarray]:
        """Rows to learn from and rows held out."""
        if job.repeat is None:
            return np.arange(len(self.row)), np.zeros(0, np.int64)
        held = self.places[:, job.repeat] == job.fold
        return np.flatnonzero(~held), np.flatnonzero(held)

    def bites(self, trees: np.ndarray) -> list[np.ndarray]:
        """The trees in runs that are grown together: of no more than ``DRAWS_AT_ONCE`` rows times trees, but one at least."""
        size = max(1, DRAWS_AT_ONCE // max(1, len(self.row)))
        return [trees[a : a + size] for a in range(0, len(trees), size)]

    def grow(self, job: Job, trees: np.ndarray, rules: Rules, cuts=None) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
        learn, held = self.split(job)
        drawn = bootstrap(self.row[learn], trees, rules.seed)
        slot, at = np.nonzero(drawn)
        held = held if cuts is not None else held[:0]
        one = np.ones(len(trees))
        roots = dict(
            tree=trees.astype(np.int64), seed=_tree_seeds(trees, rules.seed), node=one.astype(np.int64), depth=0 * one.astype(np.int64),
            clean=job.clean * one, fraud=job.fraud * one,
        )
        held_slot, held_row = np.repeat(np.arange(len(trees)), len(held)), np.tile(held, len(trees))
        nodes, shares = grow(self.codes, self.fraud, slot, learn[at], drawn[slot, at], roots, rules, held_slot, held_row, cuts)
        return nodes, held, shares.reshape(len(trees), len(held), shares.shape[1] * shares.shape[2])


def jobs_of(rows: DataFrame, repeats: int, folds: int) -> list[Job]:
    """A job for each fold of each repeat; ``n / (2 * class size)`` balances the classes of its training rows. A few counts."""
    if not repeats:
        counts = {r["fraud"]: r["n"] for r in rows.groupBy("fraud").agg(F.count(F.lit(1)).alias("n")).collect()}
        return [Job(0, None, None, *_balance(counts))]
    placed = rows.select("fraud", F.posexplode("places").alias("repeat", "fold")).groupBy("repeat", "fold", "fraud").agg(F.count(F.lit(1)).alias("n"))
    sizes = {(r["repeat"], r["fold"], r["fraud"]): r["n"] for r in placed.collect()}
    out = []
    for repeat in range(repeats):
        for fold in range(folds):
            counts = {y: sum(n for (r, f, c), n in sizes.items() if r == repeat and f != fold and c == y) for y in (0, 1)}
            out.append(Job(len(out), repeat, fold, *_balance(counts)))
    return out


def _balance(counts: dict[int, int]) -> tuple[float, float]:
    total = sum(counts.values())
    return tuple(total / (2.0 * counts[y]) if counts.get(y) else 0.0 for y in (0, 1))


def _tasks(spark: SparkSession, count: int) -> DataFrame:
    return spark.range(0, count, 1, max(1, count)).withColumnRenamed("id", "task")


def _batches(jobs: Sequence[Job], bands: Sequence[int]) -> list[tuple[Job, int, np.ndarray]]:
    """Job, band and trees of each task. ``bands``: ends of the prefixes of trees that are to be told apart."""
    out = []
    for job in jobs:
        first = 0
        for band, last in enumerate(bands):
            for a in range(first, last, TREES_AT_ONCE):
                out.append((job, band, np.arange(a, min(last, a + TREES_AT_ONCE))))
            first = last
    return out


def node_rows(job: int, nodes: dict[str, np.ndarray]) -> pa.RecordBatch:
    names = [f.split()[0] for f in NODES.split(", ")]
    values = {"job": np.full(len(nodes["node"]), job)} | nodes
    return pa.RecordBatch.from_arrays([pa.array(values[c].astype(k.to_pandas_dtype())) for c, k in zip(names, _KINDS)], names)


def fit_nodes(rows: DataFrame, jobs: Sequence[Job], rules: Rules) -> DataFrame:
    """The nodes (``NODES``) of the trees of all jobs. ``rows``: stored ``row, fraud, codes, places``."""
    spark = rows.sparkSession
    ship_package(spark)
    if rows.count() > LOCAL_ROWS:
        from partledger.operators import grow_wide

        return grow_wide.fit_nodes(rows, jobs, rules)
    work = _batches(jobs, [rules.trees])
    shared = spark.sparkContext.broadcast(Table.of(rows.toArrow()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task in batch["task"].to_pylist():
                job, _, trees = work[task]
                for some in shared.value.bites(trees):
                    yield node_rows(job.number, shared.value.grow(job, some, rules)[0])

    return checkpointed(_tasks(spark, len(work)).mapInArrow(run, NODES))


def held_out_shares(rows: DataFrame, jobs: Sequence[Job], rules: Rules, bands: Sequence[int], depths: Sequence[int | None], splits: Sequence[int]) -> DataFrame:
    """``job, band, row, fraud, shares``: sums, over the trees of a band, of the fraud share of the leaf that a held-out row reaches.

    ``shares`` runs through all depths and, inside, all ``min_split``. One forest of ``bands[-1]`` trees is grown for each job, as deep
    as the deepest and as far as the smallest split; everything else is a cut of it.
    """
    spark = rows.sparkSession
    ship_package(spark)
    if rows.count() > LOCAL_ROWS:
        from partledger.operators import grow_wide

        return grow_wide.held_out_shares(rows, jobs, rules, bands, depths, splits)
    work = _batches(jobs, bands)
    shared = spark.sparkContext.broadcast(Table.of(rows.toArrow()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task in batch["task"].to_pylist():
                job, band, trees = work[task]
                table = shared.value
                sums = 0.0
                for some in table.bites(trees):
                    _, held, shares = table.grow(job, some, rules, (depths, splits))
                    sums = sums + shares.sum(axis=0)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(held) + 1) * sums.shape[1], pa.int32()), pa.array(sums.ravel()))
                same = [pa.array(np.full(len(held), x), pa.int32()) for x in (job.number, band)]
                yield pa.RecordBatch.from_arrays(
                    [*same, pa.array(table.row[held]), pa.array(table.fraud[held].astype(np.int32)), lists], ["job", "band", "row", "fraud", "shares"]
                )

    found = checkpointed(_tasks(spark, len(work)).mapInArrow(run, "job int, band int, row bigint, fraud int, shares array<double>"))
    return sum_shares(found, len(depths) * len(splits))


def sum_shares(found: DataFrame, width: int) -> DataFrame:
    sums = [F.sum(F.col("shares")[k]).alias(f"s{k}") for k in range(width)]
    return found.groupBy("job", "band", "row", "fraud").agg(*sums).select("job", "band", "row", "fraud", F.array(*[f"s{k}" for k in range(width)]).alias("shares"))
