"""The same forests over tables that no task may hold: upper levels by histograms over all rows, the rest node by node.

The driver keeps the upper nodes: about (trees of all jobs) x (rows / ``LOCAL_ROWS``) of them. Histograms come to it for ``OPEN_NODES``
nodes at a time, already added up by Spark: at most ``OPEN_NODES`` x features x ``BINS`` rows. Their counts are whole numbers,
so every split is the one that a single task would have found.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from partledger.operators import grow as g
from partledger.session import checkpointed

OPEN_NODES = 512


@dataclass
class Upper:
    """Upper nodes of one tree: ``splits`` node -> (feature, code), ``shares`` node -> fraud share, and where it goes on."""

    splits: dict[int, tuple[int, int]] = field(default_factory=dict)
    shares: dict[int, float] = field(default_factory=dict)
    rest: set[int] = field(default_factory=set)  # nodes that a task grows
    closed: set[int] = field(default_factory=set)  # leaves

    def place(self, codes: np.ndarray) -> np.ndarray:
        """The node where each row leaves the upper levels, or that is open."""
        node = np.ones(len(codes), np.int64)
        ids = np.array(sorted(self.splits), np.int64)
        if not len(ids):
            return node
        feature, code = np.array([self.splits[int(k)] for k in ids], np.int64).T
        live = np.arange(len(codes))
        while len(live):
            at = np.minimum(np.searchsorted(ids, node[live]), len(ids) - 1)
            inside = ids[at] == node[live]
            live, at = live[inside], at[inside]
            node[live] = 2 * node[live] + (codes[live, feature[at]] > code[at])
        return node


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return batch["row"].to_numpy(), batch["fraud"].to_numpy().astype(np.int64), g.code_matrix(batch["codes"]), g.place_matrix(batch["places"])


def _held(job: g.Job, places: np.ndarray) -> np.ndarray:
    return places[:, job.repeat] == job.fold if job.repeat is not None else np.zeros(len(places), bool)


def _histograms(rows: DataFrame, jobs: dict[int, g.Job], upper: dict, nodes: list[tuple[int, int, int]], features: int, seed: int) -> DataFrame:
    """``at, feature, code, n, clean, fraud`` of the rows that reach each of ``nodes`` (job, tree, node)."""
    wanted: dict[int, dict[int, list[tuple[int, int]]]] = {}  # tree -> job -> (node, its number in ``nodes``)
    for at, (number, tree, node) in enumerate(nodes):
        wanted.setdefault(tree, {}).setdefault(number, []).append((node, at))
    shared = rows.sparkSession.sparkContext.broadcast(({k: upper[k] for k in {x[:2] for x in nodes}}, wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, trees = shared.value
        cells = features * 512  # of a node: feature, code, class
        total = np.zeros((len(nodes) * cells, 2), np.int64)
        for batch in batches:
            row, fraud, codes, places = _arrays(batch)
            place = (np.arange(features) * 512)[None, :] + codes.astype(np.int64) * 2 + fraud[:, None]
            for tree, by_job in trees.items():
                drawn = g.bootstrap(row, np.array([tree]), seed)[0]
                for number, open_nodes in by_job.items():
                    keep = np.flatnonzero((drawn > 0) & ~_held(jobs[number], places))
                    node = parts[number, tree].place(codes[keep])
                    ids, at = (np.array(x, np.int64) for x in zip(*sorted(open_nodes)))
                    own = np.minimum(np.searchsorted(ids, node), len(ids) - 1)
                    hit = ids[own] == node
                    keep, own = keep[hit], own[hit]
                    cell = (own[:, None] * cells + place[keep]).ravel()
                    target = (at[:, None] * cells + np.arange(cells)).ravel()
                    both = np.bincount(cell, np.repeat(1.0 + drawn[keep] * float(1 << 26), features), len(target)).astype(np.int64)
                    total[target, 0] += both & (1 << 26) - 1  # rows of a batch
                    total[target, 1] += both >> 26
        total = total.reshape(len(nodes), features, 256, 2, 2)
        number = total[..., 0].sum(axis=3)
        at, feature, code = np.nonzero(number)
        drawn = total[at, feature, code, :, 1]
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(x.astype(np.int32)) for x in (at, feature, code)), *(pa.array(x) for x in (number[at, feature, code], drawn[:, 0], drawn[:, 1]))],
            ["at", "feature", "code", "n", "clean", "fraud"],
        )

    found = rows.mapInArrow(run, "at int, feature int, code int, n bigint, clean bigint, fraud bigint")
    return found.groupBy("at", "feature", "code").agg(*[F.sum(c).alias(c) for c in ("n", "clean", "fraud")])


def upper_levels(rows: DataFrame, jobs: Sequence[g.Job], rules: g.Rules) -> tuple[dict[tuple[int, int], Upper], list[tuple]]:
    """Split every node of more than ``LOCAL_ROWS`` rows; the upper nodes come back as rows of ``NODES`` too."""
    features = _width(rows)
    tries = max(1, int(np.sqrt(features)))
    by_number = {j.number: j for j in jobs}
    upper = {(j.number, t): Upper() for j in jobs for t in range(rules.trees)}
    rows_out: list[tuple] = []
    level, depth = [(j, t, 1) for j, t in sorted(upper, key=lambda x: x[::-1])], 0  # a tree draws the same rows in every job
    while level:
        below = []
        for start in range(0, len(level), OPEN_NODES):
            nodes = level[start : start + OPEN_NODES]
            table = _histograms(rows, by_number, upper, nodes, features, rules.seed).toArrow().to_pydict()
            at, feature, code, n, clean, fraud = (np.array(table[c], np.int64) for c in ("at", "feature", "code", "n", "clean", "fraud"))
            one = feature == 0
            count, good, bad = (np.bincount(at[one], x[one], len(nodes)).astype(np.int64) for x in (n, clean, fraud))
            w0, w1 = (np.array([getattr(by_number[j], c) for j, _, _ in nodes]) for c in ("clean", "fraud"))
            ids = np.array([x[2] for x in nodes], np.int64)
            order = g.feature_order(g._tree_seeds(np.array([x[1] for x in nodes]), rules.seed), ids, features)
            left = (good > 0) & (bad > 0) & (count >= max(2, rules.min_split)) & (depth < rules.deepest)
            best, cut, score = np.full(len(nodes), -1), np.zeros(len(nodes), np.int64), np.full(len(nodes), -np.inf)
            for first in range(0, features, tries):
                for j in range(first, min(features, first + tries)):
                    mine = np.flatnonzero(left[at] & (feature == order[at, j]))
                    s, c, found = g.best_cuts(at[mine], code[mine], clean[mine], fraud[mine], np.where(left, good, 0), np.where(left, bad, 0), w0, w1)
                    better = found > score[s]
                    best[s[better]], cut[s[better]], score[s[better]] = order[s[better], j], c[better], found[better]
                left &= best < 0
            for k, (j, t, node) in enumerate(nodes):
                a, b = good[k] * w0[k], bad[k] * w1[k]
                p, own = (b / (a + b), (a * a + b * b) / (a + b)) if a + b > 0 else (0.0, 0.0)
                part = upper[j, t]
                if count[k] <= g.LOCAL_ROWS:
                    part.rest.add(node)
                    continue
                part.shares[node] = p
                gain = score[k] - own if best[k] >= 0 else 0.0
                rows_out.append((j, t, node, depth, *(int(x[k]) for x in (count, good, bad)), float(p), int(best[k]), int(cut[k]), float(gain)))
                if best[k] < 0:
                    part.closed.add(node)
                    continue
                part.splits[node] = (int(best[k]), int(cut[k]))
                to_left = n[(at == k) & (feature == best[k]) & (code <= cut[k])].sum()
                for child, size in ((2 * node, to_left), (2 * node + 1, count[k] - to_left)):
                    if size > g.LOCAL_ROWS:
                        below.append((j, t, child))
                    else:
                        part.rest.add(child)
        level, depth = below, depth + 1
    return upper, rows_out


def _packed(*columns: np.ndarray) -> np.ndarray:
    """Columns of bytes or of 64-bit numbers side by side, one row of bytes each."""
    return np.concatenate([np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1) for c in columns], axis=1)


def _routed(rows: DataFrame, jobs: Sequence[g.Job], upper: dict, rules: g.Rules, held_too: bool) -> DataFrame:
    """Every drawn row of every tree (and every held-out row) at the node where it leaves the upper levels.

    The rows of a batch that meet at a node travel as one byte string: ``learn`` has a row's codes, then twice its draws plus its class;
    ``held`` its codes, number and class.
    """
    shared, by_number = rows.sparkSession.sparkContext.broadcast(upper), {j.number: j for j in jobs}
    schema = "job int, tree int, node bigint, learn binary, held binary"

    def cut(node: np.ndarray, ids: np.ndarray, packed: np.ndarray) -> list[bytes]:
        order = np.argsort(node, kind="stable")
        ends = np.searchsorted(node[order], ids, "right")
        return [packed[order[a:b]].tobytes() for a, b in zip([0, *ends[:-1]], ends)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[int, list[int]] = {}
        for number, tree in shared.value:
            trees.setdefault(tree, []).append(number)
        for batch in batches:
            row, fraud, codes, places = _arrays(batch)
            whole = _packed(codes, row, fraud.astype(np.uint8))
            for tree, numbers in trees.items():
                draws = g.bootstrap(row, np.array([tree]), rules.seed)[0]
                packed = _packed(codes, (2 * draws + fraud).astype(np.uint8))
                out: list[tuple] = []
                for number in numbers:
                    part, held = shared.value[number, tree], _held(by_number[number], places)
                    node = part.place(codes)
                    learn = (draws > 0) & ~held & ~np.isin(node, list(part.closed))
                    tested = held if held_too else np.zeros(len(held), bool)
                    ids = np.unique(node[learn | tested])
                    blobs = (cut(node[mark], ids, what[mark]) for mark, what in ((learn, packed), (tested, whole)))
                    out += [(number, tree, int(k), *both) for k, *both in zip(ids, *blobs)]
                if out:
                    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], ["job", "tree", "node", "learn", "held"])

    return rows.mapInArrow(run, schema)


def _unpacked(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def _grown(rows: pa.Table, jobs: dict[int, g.Job], upper: dict, rules: g.Rules, features: int, cuts=None):
    """Nodes below the node that all ``rows`` are at, the held-out rows and their shares."""
    number, tree, node = (rows[c][0].as_py() for c in ("job", "tree", "node"))
    job, part, depth = jobs[number], upper[number, tree], node.bit_length() - 1
    learn, held = _unpacked(rows["learn"], features + 1), _unpacked(rows["held"], features + 9)
    row = np.ascontiguousarray(held[:, features : features + 8]).view(np.int64).ravel()
    fraud = np.concatenate([learn[:, features] & 1, held[:, features + 8]]).astype(np.int64)
    if len(learn):
        one = np.ones(1)
        roots = dict(
            tree=np.array([tree]), seed=g._tree_seeds(np.array([tree]), rules.seed), node=np.array([node]), depth=np.array([depth]),
            clean=job.clean * one, fraud=job.fraud * one,
        )
        codes = np.concatenate([learn[:, :features], held[:, :features]])
        drawn, at = (learn[:, features] >> 1).astype(np.int64), np.arange(len(codes))
        zeros, kept = np.zeros(len(learn), np.int64), np.zeros(len(held), np.int64)
        nodes, shares = g.grow(codes, fraud, zeros, at[: len(learn)], drawn, roots, rules, kept, at[len(learn) :], cuts)
    else:  # an upper leaf
        nodes = None
        shares = np.full((len(held), len(cuts[0]), len(cuts[1])), part.shares.get(node, 0.0))
    if cuts is not None:
        for i, cut in enumerate(cuts[0]):
            if cut is not None and cut < depth:
                shares[:, i, :] = part.shares[node >> (depth - cut)]
    return number, nodes, row, fraud[len(learn) :], shares.reshape(len(held), shares.shape[1] * shares.shape[2])


def _width(rows: DataFrame) -> int:
    return len(rows.select("codes").first()["codes"])


def fit_nodes(rows: DataFrame, jobs: Sequence[g.Job], rules: g.Rules) -> DataFrame:
    spark = rows.sparkSession
    upper, nodes = upper_levels(rows, jobs, rules)
    shared, by_number, features = spark.sparkContext.broadcast(upper), {j.number: j for j in jobs}, _width(rows)

    def run(group: pa.Table) -> pa.Table:
        number, found, *_ = _grown(group, by_number, shared.value, rules, features)
        return pa.Table.from_batches([g.node_rows(number, found)])

    routed = _routed(rows, jobs, upper, rules, False)
    below = routed.groupBy("job", "tree", "node").applyInArrow(run, g.NODES)
    return checkpointed(below.unionByName(spark.createDataFrame(nodes, g.NODES)))


def held_out_shares(rows: DataFrame, jobs: Sequence[g.Job], rules: g.Rules, bands: Sequence[int], depths: Sequence[int | None], splits: Sequence[int]) -> DataFrame:
    spark = rows.sparkSession
    upper, _ = upper_levels(rows, jobs, rules)
    shared, by_number, features = spark.sparkContext.broadcast(upper), {j.number: j for j in jobs}, _width(rows)

    def run(group: pa.Table) -> pa.Table:
        number, _, row, fraud, shares = _grown(group, by_number, shared.value, rules, features, (depths, splits))
        band = int(np.searchsorted(bands, group["tree"][0].as_py(), "right"))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(row) + 1) * (len(depths) * len(splits)), pa.int32()), pa.array(shares.ravel()))
        same = [pa.array(np.full(len(row), x), pa.int32()) for x in (number, band)]
        return pa.Table.from_arrays([*same, pa.array(row), pa.array(fraud.astype(np.int32)), lists], ["job", "band", "row", "fraud", "shares"])

    routed = _routed(rows, jobs, upper, rules, True)
    schema = "job int, band int, row bigint, fraud int, shares array<double>"
    found = checkpointed(routed.groupBy("job", "tree", "node").applyInArrow(run, schema))
    return g.sum_shares(found, len(depths) * len(splits))
