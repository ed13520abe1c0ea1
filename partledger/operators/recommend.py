"""Similar claims: amounts per part, a low-rank projection, and exact top-n cosine search."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from partledger.config import DEFAULTS
from partledger.functions.numbers import rounded
from partledger.operators.blocks import BLOCK_ROWS, block_join, matrix, parallelism
from partledger.operators.ordering import hash_sample
from partledger.session import checkpointed, released

MAX_GRAM_PARTS = 2048  # up to here the part-by-part matrix is formed on the driver; beyond, it is only multiplied with
EXTRA_DIRECTIONS = 6
RESIDUAL = 1e-10  # of a direction, against its eigenvalue
SMALL = 1e-12  # … or against the largest one, where that is more
BASIS_BLOCKS = 12  # blocks of directions that are kept before the basis is cut back
MAX_PRODUCTS = 400
CELL_ROWS = 4096
PIVOT_ROWS = 65_536
MAX_CELLS = 4096
GROUP_ROWS, MAX_GROUPS = 64, 1024  # of a block's points around one centre; centres of a block
FIRST_GROUPS = 4
BLOCK_VALUES = 8_000_000  # numbers in one side of a block
PASS_VISITS = 2_000_000  # of rows to other cells in one turn, or as many as there are rows


def interaction_table(
    rows: DataFrame,
    part: str,
    claim: str = DEFAULTS.claim_id,
    amount: str = DEFAULTS.amount,
    weight: str | None = None,
) -> DataFrame:
    """``claim_id, part, amount``: summed amount per claim and part; absent pairs mean zero."""
    x = F.col(amount).cast("double") * (F.col(weight) if weight else F.lit(1))
    return (
        rows.where(F.col(claim).isNotNull() & F.col(part).isNotNull())
        .groupBy(F.col(claim).alias("claim_id"), F.col(part).alias("part"))
        .agg(F.coalesce(F.sum(x), F.lit(0.0)).alias("amount"))
    )


def part_scales(inter: DataFrame, claims: int) -> DataFrame:
    """``part, mean, std`` over all claims, zeros included; population std, constant columns get 1."""
    share = F.col("n") / F.lit(float(claims))
    variance = share * F.col("v") + share * (1 - share) * F.col("m") * F.col("m")
    constant = variance <= 1e-14 * F.col("m") * F.col("m")
    return (
        inter.groupBy("part")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("amount").alias("m"), F.var_pop("amount").alias("v"))
        .select(
            "part",
            (share * F.col("m")).alias("mean"),
            F.when(constant, F.lit(1.0)).otherwise(F.sqrt(variance)).alias("std"),
            constant.alias("constant"),
        )
    )


def standardise_parts(inter: DataFrame, claims: int) -> DataFrame:
    """The stored cells of the standardised matrix; an absent cell is ``-mean / std`` of its part."""
    scales = part_scales(inter, claims)
    return inter.join(scales, "part").select(
        "claim_id", "part", ((F.col("amount") - F.col("mean")) / F.col("std")).alias("z")
    )


@dataclass
class SvdModel:
    """``components``: part, std and one column per direction; ``shift``: projection of the column means."""

    components: DataFrame
    shift: list[float]
    explained: list[float]
    claims: int
    parts: int

    @property
    def rank(self) -> int:
        return len(self.shift)


def svd_fit(
    inter: DataFrame, components: int = DEFAULTS.components, max_gram_parts: int = MAX_GRAM_PARTS
) -> SvdModel:
    """Leading right singular vectors of the standardised claims-by-parts matrix, never built densely.

    Every direction ``v`` and eigenvalue ``l`` of the part-by-part matrix ``G`` has ``|G v - l v| <= RESIDUAL * l`` (or ``SMALL`` times the largest ``l``), whatever the width.
    ``inter`` is read several times and should be checkpointed or stored.
    """
    claims = inter.select("claim_id").distinct().count()
    if claims < 2:
        raise ValueError("need at least 2 claims for recommendations")
    scales = checkpointed(part_scales(inter, claims))
    parts = scales.count()
    rank = max(1, min(components, min(claims, parts) - 1, claims - 1))
    usable = scales.where(~F.col("constant"))
    solve = _gram_directions if parts <= max_gram_parts else _iterated_directions
    directions, values = solve(inter, usable, claims, rank)
    shift = _shift(directions, rank)
    total = max(usable.count(), 1)
    return SvdModel(directions, shift, [float(v) / claims / total for v in values], claims, parts)


def _shift(directions: DataFrame, rank: int) -> list[float]:
    scaled_mean = F.col("mean") / F.col("std")
    row = directions.agg(*[F.coalesce(F.sum(scaled_mean * F.col(f"v{i}")), F.lit(0.0)) for i in range(rank)]).first()
    return [float(x) for x in row]


def _gram_directions(inter: DataFrame, scales: DataFrame, claims: int, rank: int):
    """Exact: partial part-by-part matrices per task, non-zero cells summed by Spark, decomposed on the driver."""
    spark = inter.sparkSession
    table = scales.orderBy("part").toPandas()  # at most max_gram_parts rows
    width = len(table)
    if width == 0:
        table[[f"v{i}" for i in range(rank)]] = 0.0
        schema = "part string, mean double, std double, " + ", ".join(f"v{i} double" for i in range(rank))
        return spark.createDataFrame(table.drop(columns="constant"), schema), [0.0] * rank
    table["place"] = np.arange(width)
    places = F.broadcast(spark.createDataFrame(table[["part", "place", "std"]], "part string, place int, std double"))
    rows = (
        inter.join(places, "part")
        .groupBy("claim_id")
        .agg(F.collect_list(F.struct("place", (F.col("amount") / F.col("std")).alias("x"))).alias("cells"))
        .select("cells.place", "cells.x")
    )

    def partial(batches):
        gram = np.zeros(width * width)
        for batch in batches:
            sizes = batch["place"].map(len)
            for size, same in batch.groupby(sizes):
                place, x = np.stack(same["place"]).astype(np.int64), np.stack(same["x"])
                step = max(1, 4_000_000 // (size * size))
                for start in range(0, len(same), step):
                    p, v = place[start : start + step], x[start : start + step]
                    cell = (p[:, :, None] * width + p[:, None, :]).ravel()
                    gram += np.bincount(cell, (v[:, :, None] * v[:, None, :]).ravel(), width * width)
        row, column = np.nonzero(np.triu(gram.reshape(width, width)))
        yield pd.DataFrame({"i": row, "j": column, "x": gram[row * width + column]})

    schema = "i int, j int, x double"
    summed = rows.mapInPandas(partial, schema).groupBy("i", "j").agg(F.sum("x").alias("x")).toPandas()
    gram = np.zeros((width, width))  # at most max_gram_parts squared
    gram[summed["i"], summed["j"]] = summed["x"]
    gram = np.triu(gram) + np.triu(gram, 1).T
    mean = (table["mean"] / table["std"]).to_numpy()
    values, vectors = np.linalg.eigh(gram - claims * np.outer(mean, mean))
    order = np.argsort(values)[::-1][:rank]
    for i in range(rank):
        table[f"v{i}"] = vectors[:, order[i]] if i < len(order) else 0.0
    schema = "part string, mean double, std double, " + ", ".join(f"v{i} double" for i in range(rank))
    names = ["part", "mean", "std", *[f"v{i}" for i in range(rank)]]
    kept = np.zeros(rank)
    kept[: len(order)] = np.maximum(values[order], 0.0)
    return spark.createDataFrame(table[names], schema), kept


def _projected(inter: DataFrame, directions: DataFrame, width: int, shift: list[float]) -> DataFrame:
    x = F.col("amount") / F.col("std")
    joined = inter.join(directions, "part", "left")
    return joined.groupBy("claim_id").agg(
        *[(F.coalesce(F.sum(x * F.col(f"v{i}")), F.lit(0.0)) - F.lit(shift[i])).alias(f"u{i}") for i in range(width)]
    )


def _multiplied(inter: DataFrame, directions: DataFrame, width: int) -> DataFrame:
    """``part, image``: the part-by-part matrix times ``v0`` …, by a join to the claims and one back.

    Projections are centred, so their sum over all claims is zero and absent cells add nothing on the way back.
    """
    left = _projected(inter, directions, width, _shift(directions, width))
    back = inter.join(left, "claim_id").groupBy("part").agg(*[F.sum(F.col("amount") * F.col(f"u{i}")).alias(f"w{i}") for i in range(width)])
    scaled = directions.select("part", "std").join(back, "part")
    return scaled.select("part", F.array(*[F.col(f"w{i}") / F.col("std") for i in range(width)]).alias("image"))


def _inner(df: DataFrame, a: str, b: str) -> np.ndarray:
    """Inner products, over all rows, of every column of the array ``a`` with every column of ``b``; summed per task first."""

    def partial(batches):
        total = None
        for batch in batches:
            if len(batch):
                more = _stack(batch[a]).T @ _stack(batch[b])
                total = more if total is None else total + more
        if total is not None:
            yield pd.DataFrame({"rows": [total.shape[0]], "x": [total.ravel()]})

    found = df.select(a, b) if a != b else df.select(a)
    parts = found.mapInPandas(partial, "rows int, x array<double>").collect()  # one small matrix for each task
    return sum(np.array(r["x"]).reshape(r["rows"], -1) for r in parts)


def _combined(df: DataFrame, terms: dict[str, list[tuple[str, np.ndarray]]]) -> DataFrame:
    """New array columns, each a sum of arrays times small matrices; ``part`` and the scales stay."""
    kept, used = ["part", "mean", "std"], sorted({c for parts in terms.values() for c, _ in parts})

    def run(batches):
        for batch in batches:
            out = batch[kept].copy()
            if len(batch):
                values = {c: _stack(batch[c]) for c in used}
                for name, parts in terms.items():
                    out[name] = list(sum(values[c] @ m for c, m in parts))
            else:
                for name in terms:
                    out[name] = []
            yield out

    schema = "part string, mean double, std double, " + ", ".join(f"{c} array<double>" for c in terms)
    return df.select(*kept, *used).mapInPandas(run, schema)


def _orthonormal(gram: np.ndarray) -> np.ndarray:
    """The matrix that makes columns with these inner products orthonormal; dependent directions are left out."""
    values, vectors = np.linalg.eigh(gram)
    good = values > max(values.max(), 0.0) * 1e-13
    return vectors[:, good] / np.sqrt(values[good])


def _iterated_directions(inter: DataFrame, scales: DataFrame, claims: int, rank: int):
    """Wide part lists: a block Krylov space grown by residuals until each one is small; no part-by-part matrix.

    ``basis`` and its image under the matrix are stored tables with one array a part. Each round adds the residuals of the leading
    Ritz pairs (block Lanczos with full orthogonalisation); a long basis is cut back to its Ritz vectors.
    """
    block = rank + EXTRA_DIRECTIONS
    names = scales.select(F.col("part").cast("string").alias("part"), "mean", "std")
    inter = inter.select("claim_id", F.col("part").cast("string").alias("part"), "amount")
    draws = [(F.pmod(F.xxhash64(F.col("part"), F.lit(i)), F.lit(2_000_003)) / 1_000_001.5 - 1.0) for i in range(block)]
    fresh = checkpointed(names.withColumn("fresh", F.array(*draws)))
    if fresh.isEmpty():
        return names.select("*", *[F.lit(0.0).alias(f"v{i}") for i in range(rank)]), [0.0] * rank
    table = None
    for _ in range(MAX_PRODUCTS):
        for _ in range(2):  # orthogonal to the basis, twice for accuracy
            if table is not None:
                both = table.join(fresh.select("part", "fresh"), "part")
                overlap = _inner(both, "basis", "fresh")
                fresh = checkpointed(_combined(both, {"fresh": [("fresh", np.eye(overlap.shape[1])), ("basis", -overlap)]}))
            change = _orthonormal(_inner(fresh, "fresh", "fresh"))
            if not change.shape[1]:
                break
            fresh = checkpointed(_combined(fresh, {"fresh": [("fresh", change)]}))
        width = change.shape[1]
        if width:
            columns = fresh.select("part", "mean", "std", *[F.col("fresh")[i].alias(f"v{i}") for i in range(width)])
            grown = fresh.join(_multiplied(inter, columns, width), "part")
            if table is None:
                table = checkpointed(grown.select("part", "mean", "std", F.col("fresh").alias("basis"), "image"))
            else:
                own = grown.select("part", "fresh", F.col("image").alias("more"))
                wider = table.join(own, "part")
                table = checkpointed(wider.select("part", "mean", "std", F.concat("basis", "fresh").alias("basis"), F.concat("image", "more").alias("image")))
        values, vectors = np.linalg.eigh(_symmetric(_inner(table, "basis", "image")))
        order = np.argsort(values)[::-1]
        values, vectors = values[order], vectors[:, order]
        lead = vectors[:, :block]
        fresh = checkpointed(_combined(table, {"fresh": [("image", lead), ("basis", -lead * values[:block])]}))
        size = np.sqrt(np.maximum(np.diag(_inner(fresh, "fresh", "fresh")), 0.0))
        if not width or (size[:rank] <= np.maximum(RESIDUAL * values[: len(size[:rank])], SMALL * values[0])).all():
            break
        if vectors.shape[0] > BASIS_BLOCKS * block:
            short = vectors[:, : 3 * block]
            table = checkpointed(_combined(table, {"basis": [("basis", short)], "image": [("image", short)]}))
    else:
        raise ArithmeticError(f"directions have not settled after {MAX_PRODUCTS} products")
    kept = np.zeros((vectors.shape[0], rank))
    kept[:, : min(rank, vectors.shape[1])] = vectors[:, :rank]
    final = checkpointed(_combined(table, {"v": [("basis", kept)]}))
    found = np.zeros(rank)
    found[: min(rank, len(values))] = np.maximum(values[:rank], 0.0)
    return final.select("part", "mean", "std", *[F.col("v")[i].alias(f"v{i}") for i in range(rank)]), found


def _symmetric(matrix: np.ndarray) -> np.ndarray:
    return (matrix + matrix.T) / 2


def svd_project(inter: DataFrame, model: SvdModel) -> DataFrame:
    """``claim_id, vec``: coordinates of every claim."""
    components = F.broadcast(model.components) if model.parts <= MAX_GRAM_PARTS else model.components
    wide = _projected(inter, components, model.rank, model.shift)
    return wide.select("claim_id", F.array(*[f"u{i}" for i in range(model.rank)]).alias("vec"))


def unit_vector(vec: Column) -> Column:
    """The vector at length one; a zero vector stays zero."""
    length = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda s, x: s + x * x))
    return F.when(length > 0, F.transform(vec, lambda x: x / length)).otherwise(vec)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two double arrays; 0 when one of them is zero."""
    return F.aggregate(F.zip_with(unit_vector(a), unit_vector(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _stack(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(float)


def _slices(rows: int, width: int, values: int = 2_000_000):
    """Slices of ``rows`` rows whose products with ``width`` columns stay within ``values`` cells."""
    step = max(1, values // max(width, 1))
    return [slice(start, start + step) for start in range(0, rows, step)]


def _apart(cosines: np.ndarray) -> np.ndarray:
    """Distances of unit vectors with these cosines."""
    return np.sqrt(np.maximum(2.0 - 2.0 * cosines, 0.0))


def _grouped(points: np.ndarray, centres: np.ndarray):
    """Nearest centre of every row and the distance to it; zero rows belong to the group after the last."""
    home, away = np.full(len(points), len(centres)), np.zeros(len(points))
    for part in _slices(len(points), len(centres)) if len(centres) else ():
        far = points[part] @ centres.T
        home[part] = far.argmax(axis=1)
        away[part] = _apart(far.max(axis=1))
    home[~points.any(axis=1)] = len(centres)
    return home, away


def _by_group(visit: np.ndarray):
    """Every group that some row visits, with the rows that do."""
    group, row = np.nonzero(visit.T)
    cuts = np.flatnonzero(np.diff(group)) + 1
    return zip(group[np.r_[0, cuts]].tolist(), np.split(row, cuts)) if len(group) else ()


def _looked_up(asked: np.ndarray, points: np.ndarray, floor: np.ndarray, keep: int):
    """Row, place and cosine of every pair that can be among the ``keep`` best of its row and reach its ``floor``; little else.

    Points lie in groups around some of them. A row first looks at the nearest groups; the cosines found there tell which
    groups can hold a better one: by the group's ball and by the plane half-way between its centre and the row's own.
    """
    solid = np.flatnonzero(points.any(axis=1))
    wanted = min(len(solid), MAX_GROUPS, 1 + len(points) // GROUP_ROWS)
    centres = points[solid[np.linspace(0, len(solid) - 1, wanted).astype(int)]] if wanted else points[:0]
    home, away = _grouped(points, centres)
    order = np.argsort(home, kind="stable")
    ends = np.searchsorted(home[order], np.arange(wanted + 2))
    ordered = points[order]
    full = np.diff(ends) > 0
    radius = np.full(wanted + 1, -np.inf)
    np.maximum.at(radius, home, away)
    between = np.maximum(_apart(centres @ centres.T), 1e-6)
    found = [(np.empty(0, int), np.empty(0, int), np.empty(0))]
    for part in _slices(len(asked), wanted):
        mine, least = asked[part], floor[part] - 1e-9
        visit = np.repeat(full[None, :], len(mine), axis=0)
        empty = ~mine.any(axis=1)
        if wanted:
            far = _apart(mine @ centres.T)
            own = far.argmin(axis=1)
            first = np.zeros((len(mine), wanted), bool)
            near = np.argpartition(far, min(FIRST_GROUPS, wanted) - 1, axis=1)[:, :FIRST_GROUPS]
            np.put_along_axis(first, near, True, axis=1)
            best = np.full((len(mine), keep), -np.inf)
            for group, rows in _by_group(first & full[:wanted]):
                seen = np.concatenate([best[rows], mine[rows] @ ordered[ends[group] : ends[group + 1]].T], axis=1)
                best[rows] = np.partition(seen, -keep, axis=1)[:, -keep:]
            least = np.maximum(least, best.min(axis=1))
            plane = (far**2 - far[np.arange(len(far)), own][:, None] ** 2) / (2.0 * between[own])
            reach = np.maximum(far - radius[:wanted], plane) <= (_apart(least - 2e-9) + 1e-7)[:, None]
            visit[:, :wanted] &= reach | empty[:, None]
        least = least - 2e-9  # cosines are compared at 9 places
        for group, rows in _by_group(visit):
            cosines = mine[rows] @ ordered[ends[group] : ends[group + 1]].T
            row, at = np.nonzero(cosines >= least[rows, None])
            found.append((part.start + rows[row], order[ends[group] + at], cosines[row, at]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _nearest(n: int):
    """Kernel: the n best right rows per left row by (cosine at 9 places, then id), of those that reach its ``floor`` if it has one."""

    def kernel(left: pa.Table, right: pa.Table) -> pd.DataFrame:
        right = right.sort_by("id")
        queries, ids = left["query"].to_pandas().to_numpy(), right["id"].to_pandas().to_numpy()
        floor = left["floor"].to_numpy() if "floor" in left.column_names else np.full(len(queries), -2_000_000_000)
        asked, points = matrix(left["unit"]), matrix(right["unit"])
        row, at, cosines = _looked_up(asked, points, floor / 1e9, min(n, len(ids)))
        score = np.rint(cosines * 1e9).astype(np.int64)
        good = score >= floor[row]  # only hits that can still enter the list
        row, at, score = row[good], at[good], score[good]
        best = np.lexsort((at, -score, row))  # equal cosines: the smaller id first
        row, at, score = row[best], at[best], score[best]
        kept = np.arange(len(row)) - np.searchsorted(row, row) < n
        return pd.DataFrame({"query": queries[row[kept]], "other": ids[at[kept]], "points": score[kept]})

    return kernel


def _best(candidates: DataFrame, n: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("points"), "other")
    return candidates.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)


def top_similar(vectors: DataFrame, n: int = DEFAULTS.top_n, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Exact top-n cosine neighbours of every row: ``claim_id, other_id, score, similarity_score, rank``.

    ``vectors`` is ``claim_id, vec``. Ties go to the smaller id; a row is never its own neighbour.

    * Equal vectors are compared once. Of many copies only the n+1 smallest ids can be anybody's neighbours.
    * Vectors are grouped around a bounded number of pivots. A row first searches its own group; the distance
      to its n-th hit then tells which other groups can still hold a better one: those whose ball around the
      pivot, and whose side of the plane half-way to the own pivot, come near enough.
    """
    units = vectors.select(F.col("claim_id").alias("id"), unit_vector(F.col("vec")).alias("unit"))
    copies = Window.partitionBy("unit").orderBy("id")
    points = checkpointed(units.select("id", "unit", F.row_number().over(copies).alias("copy"), F.first("id").over(copies).alias("owner")))
    kind = dict(points.dtypes)["id"]
    schema = f"query {kind}, other {kind}, points long"
    keep = n + 1
    rows = points.where(F.col("copy") <= keep).count()
    if rows <= cell_rows:
        one = points.where(F.col("copy") <= keep).withColumn("cell", F.lit(0))
        found = block_join(_asking(one), one.select("id", "unit", "cell"), "query", "id", _nearest(keep), schema)
        stored = [points]
    else:
        few = min(rows // CELL_ROWS, parallelism(vectors.sparkSession))  # a small table still uses all cores
        found, stored = _pivot_search(points, rows, keep, min(MAX_CELLS, max(2, few, rows // PIVOT_ROWS)), schema)
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("points")).alias("lost"), "other"))).alias("hits")
    hits = _best(found, keep).groupBy("query").agg(ordered)
    others = F.slice(F.filter("hits", lambda h: h["other"] != F.col("id")), 1, n)
    owned = stored[0].select("id", F.col("owner").alias("query"))
    lists = checkpointed(owned.join(hits, "query").select("id", others.alias("hits")))  # one row a claim: a fifth of the ids
    released(*stored)
    edges = lists.select("id", F.posexplode("hits").alias("at", "hit"))
    score = -F.col("hit.lost") / F.lit(1e9)
    return edges.select(
        F.col("id").alias("claim_id"),
        F.col("hit.other").alias("other_id"),
        score.alias("score"),
        rounded(score, 4).alias("similarity_score"),
        (F.col("at") + 1).alias("rank"),
    )


def _asking(points: DataFrame) -> DataFrame:
    """One row for each of the different vectors, in its cell."""
    return points.where("copy = 1").select(F.col("id").alias("query"), "unit", "cell")


def _pivot_search(points: DataFrame, rows: int, keep: int, cells: int, schema: str) -> tuple[DataFrame, list[DataFrame]]:
    """Candidates ``query, other, points`` and the stored tables that they need; the first has the rows of ``points``, which is released."""
    nonzero = points.where((F.col("copy") <= keep) & F.exists("unit", lambda x: x != 0))
    chosen = hash_sample(nonzero, F.col("id"), cells, nonzero.count()).select("unit").toPandas()  # at most MAX_CELLS
    pivots = _stack(chosen["unit"])
    cells = len(pivots)
    zero = cells  # zero vectors have cosine 0 with everything; they form a cell that everyone visits
    apart = np.maximum(_apart(pivots @ pivots.T), 1e-6)
    block_rows = min(2 * PIVOT_ROWS, max(BLOCK_ROWS, BLOCK_VALUES // pivots.shape[1]))

    @F.pandas_udf("cell int, away double")
    def home(units: pd.Series) -> pd.DataFrame:
        cell, away = _grouped(_stack(units), pivots)
        return pd.DataFrame({"cell": cell, "away": away})

    own = (F.col("h.cell").alias("cell"), F.col("h.away").alias("away"))
    stored = checkpointed(points.withColumn("h", home("unit")).select("id", "unit", "copy", "owner", *own))
    released(points)
    placed = stored.where(F.col("copy") <= keep)
    reach = placed.groupBy("cell").agg(F.max("away").alias("away")).toPandas()  # one row per cell
    radius = np.full(cells + 1, -np.inf)
    radius[reach["cell"].to_numpy()] = reach["away"].to_numpy()
    if radius[zero] > -np.inf:
        radius[zero] = np.inf
    at_home, right = _asking(placed), placed.select("id", "unit", "cell")
    near = checkpointed(_best(block_join(at_home, right, "query", "id", _nearest(keep), schema, block_rows), keep))
    last = near.where(F.col("place") == keep).select("query", "points")

    @F.pandas_udf("array<int>")
    def reachable(units: pd.Series, own: pd.Series, points: pd.Series) -> pd.Series:
        rows, mine, cells_of = _stack(units), own.to_numpy(), []
        limit = _apart((points.fillna(-1e9).to_numpy(dtype=float) - 2) / 1e9) + 1e-7
        for part in _slices(len(rows), cells):  # rows times pivots at once would be hundreds of megabytes
            far, at = _apart(rows[part] @ pivots.T), np.minimum(mine[part], cells - 1)
            plane = (far**2 - far[np.arange(len(far)), at][:, None] ** 2) / (2.0 * apart[at])
            bound = np.column_stack([np.maximum(far - radius[:cells], plane), np.full(len(far), -radius[zero])])
            bound[~rows[part].any(axis=1)] = -np.inf
            visit = (bound <= limit[part][:, None]) & (radius > -np.inf)
            visit[np.arange(len(far)), mine[part]] = False
            cells_of += [np.flatnonzero(v).astype(np.int32) for v in visit]
        return pd.Series(cells_of)

    floor = F.coalesce("points", F.lit(-2_000_000_000)).alias("floor")
    away = reachable.asNondeterministic()("unit", "cell", "points").alias("cells")  # else the filter runs it once more
    asks = checkpointed(at_home.join(last, "query", "left").select("query", "unit", floor, away).where("size(cells) > 0"))
    visits = asks.agg(F.coalesce(F.sum(F.size("cells")), F.lit(0))).first()[0]
    # A row travels to every cell that it visits: in turns, so that disks hold one turn, each of cells enough for all cores.
    passes = max(1, min(-(-visits // max(rows, PASS_VISITS)), cells // parallelism(points.sparkSession)))
    found = [near.select("query", "other", "points")]
    for turn in range(passes):
        mine = F.filter("cells", lambda c: c % passes == turn)
        probes = asks.select("query", "unit", "floor", F.explode(mine).alias("cell"))
        more = block_join(probes, right.where(F.col("cell") % passes == turn), "query", "id", _nearest(keep), schema, block_rows)
        found.append(checkpointed(more))
    released(asks)
    return reduce(DataFrame.unionByName, found), [stored, near, *found[1:]]


def pair_similarity(vectors: DataFrame, pairs: DataFrame) -> DataFrame:
    """Cosine of listed pairs: ``claim_id, other_id, similarity_score``, and the other columns of ``pairs`` as they are."""
    left = vectors.select("claim_id", F.col("vec").alias("_a"))
    right = vectors.select(F.col("claim_id").alias("other_id"), F.col("vec").alias("_b"))
    value = rounded(cosine(F.col("_a"), F.col("_b")), 4)
    kept = [c for c in pairs.columns if c not in ("claim_id", "other_id", "similarity_score")]
    return pairs.join(left, "claim_id").join(right, "other_id").select(
        "claim_id", "other_id", value.alias("similarity_score"), *kept
    )


def recommend_batch(requests: DataFrame, edges: DataFrame, n: int = DEFAULTS.top_n) -> DataFrame:
    """Neighbours of requested claims; an id without any gets one row with status ``unknown claim``."""
    found = edges.where(F.col("rank") <= n).select("claim_id", "other_id", "similarity_score", "rank")
    status = F.when(F.col("other_id").isNull(), "unknown claim").otherwise("ok")
    return requests.select("claim_id").join(found, "claim_id", "left").withColumn("status", status)


def evaluate_recommender(edges: DataFrame, model: SvdModel, n: int = DEFAULTS.top_n) -> DataFrame:
    """One row of quality numbers. A claim's own score counts as 0, so it can be among the top n."""
    scores = F.slice(F.sort_array(F.concat(F.collect_list("score"), F.array(F.lit(0.0))), asc=False), 1, n)
    per_claim = edges.where(F.col("rank") <= n).groupBy("claim_id").agg(scores.alias("top"))
    mean = F.aggregate("top", F.lit(0.0), lambda s, x: s + x) / F.size("top")
    covered = (F.col("top")[0] >= DEFAULTS.coverage_score).cast("int")
    return per_claim.agg(F.avg(covered).alias("covered"), F.avg(mean).alias("mean")).select(
        F.lit(model.claims).cast("long").alias("num_claims"),
        F.lit(model.parts).cast("long").alias("num_parts"),
        rounded(F.lit(sum(model.explained) * 100), 2).alias("svd_explained_variance_pct"),
        rounded(F.col("covered") * 100, 2).alias("coverage_pct"),
        rounded(F.col("mean"), 4).alias("avg_top_n_similarity"),
    )
