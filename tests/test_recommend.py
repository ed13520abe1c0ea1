import os

import numpy as np
import pytest

from partledger.operators import recommend


def dense_reference(rows, k):
    claims, parts = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
    x = np.zeros((len(claims), len(parts)))
    for c, p, v in rows:
        x[claims.index(c), parts.index(p)] = v
    std = x.std(axis=0)
    z = (x - x.mean(axis=0)) / np.where(std == 0, 1, std)
    u, s, _ = np.linalg.svd(z, full_matrices=False)
    return claims, u[:, :k] * s[:k], (s[:k] ** 2).sum() / (s**2).sum()


@pytest.fixture(scope="module")
def inter(spark):
    rng = np.random.default_rng(2)
    rows = {}
    for c in range(120):
        for p in rng.choice(12, rng.integers(1, 6), replace=False):
            rows[f"c{c:03d}", f"p{p:02d}"] = float(np.round(rng.lognormal(3, 1), 2))
        rows[f"c{c:03d}", "same"] = 5.0  # constant column
    rows = [(c, p, v) for (c, p), v in rows.items()]
    return spark.createDataFrame(rows, "claim_id string, part string, amount double"), rows


@pytest.mark.parametrize("limit", [2048, 2])
def test_projection(inter, limit):
    df, rows = inter
    model = recommend.svd_fit(df, 4, max_gram_parts=limit)
    claims, latent, share = dense_reference(rows, 4)
    vecs = recommend.svd_project(df, model).toPandas().set_index("claim_id").loc[claims, "vec"]
    got = np.stack(vecs)
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    assert np.allclose(unit(got) @ unit(got).T, unit(latent) @ unit(latent).T, atol=1e-9)
    assert np.isclose(sum(model.explained), share, atol=1e-9)


def test_wide_and_flat_spectrum(spark):
    """200 columns of nearly equal strength, without the part-by-part matrix: directions, residuals and neighbours of numpy."""
    rng = np.random.default_rng(17)
    rows = [(f"c{c:04d}", f"p{p:03d}", float(np.round(rng.lognormal(3, 1), 2))) for c in range(300) for p in rng.choice(200, 12, replace=False)]
    df = spark.createDataFrame(rows, "claim_id string, part string, amount double").coalesce(2).cache()
    k = 10
    model = recommend.svd_fit(df, k, max_gram_parts=0)
    claims, latent, share = dense_reference(rows, k)
    assert np.isclose(sum(model.explained), share, atol=1e-9)
    found = model.components.toPandas().sort_values("part")
    assert len(found) == 200
    v = found[[f"v{i}" for i in range(k)]].to_numpy()
    assert np.allclose(v.T @ v, np.eye(k), atol=1e-9)
    parts, x = found["part"].tolist(), np.zeros((len(claims), 200))
    place, column = {c: i for i, c in enumerate(claims)}, {p: i for i, p in enumerate(parts)}
    for c, p, amount in rows:
        x[place[c], column[p]] = amount
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    strength = np.array(model.explained) * len(claims) * 200
    residual = np.linalg.norm(z.T @ (z @ v) - v * strength, axis=0)
    assert (residual <= 2e-10 * strength).all()
    edges = recommend.top_similar(recommend.svd_project(df, model)).collect()
    got = {(r["claim_id"], r["rank"]): r["other_id"] for r in edges}
    unit = latent / np.linalg.norm(latent, axis=1, keepdims=True)
    points = unit @ unit.T
    np.fill_diagonal(points, -2)
    order = np.argsort(-points, axis=1)[:, :5]
    assert got == {(claims[i], r + 1): claims[order[i, r]] for i in range(len(claims)) for r in range(5)}


def test_one_claim_is_an_error(spark):
    one = spark.createDataFrame([("a", "p", 1.0)], "claim_id string, part string, amount double")
    with pytest.raises(ValueError):
        recommend.svd_fit(one)


def test_duplicate_pairs_are_summed(spark):
    rows = spark.createDataFrame([("1", "p", 2.0, 2), ("1", "p", 3.0, 2), (None, "p", 1.0, 1)], "CLAIMNO string, part string, TOTAL_AMOUNT double, w int")
    found = recommend.interaction_table(rows, "part", weight="w").collect()
    assert [tuple(r) for r in found] == [("1", "p", 10.0)]


def brute(ids, x, n):
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    u = np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)
    points = np.rint(u @ u.T * 1e9).astype(np.int64)
    out = {}
    for i, a in enumerate(ids):
        order = sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-points[i, j], ids[j]))[:n]
        out[a] = [(ids[j], points[i, j]) for j in order]
    return out


@pytest.mark.parametrize("cell_rows", [10**6, 50])
def test_neighbours_with_copies_and_zeros(spark, cell_rows):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 4))
    x[:100] = x[0]  # a third of all rows are copies
    x[100:110] = 0.0
    x[110:120] = -x[120:130]
    ids = [f"c{i:03d}" for i in rng.permutation(300)]
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in zip(ids, x)], "claim_id string, vec array<double>")
    edges = recommend.top_similar(df, 5, cell_rows=cell_rows).toPandas()
    wanted = brute(ids, x, 5)
    assert len(edges) == 1500 and (edges["claim_id"] != edges["other_id"]).all()
    for claim, part in edges.sort_values("rank").groupby("claim_id"):
        assert list(part["other_id"]) == [o for o, _ in wanted[claim]], claim
        assert np.allclose(part["score"] * 1e9, [p for _, p in wanted[claim]], atol=1.5)


def test_few_rows_and_evaluation(spark):
    df = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [-1.0, 0.0]), ("c", [-1.0, -1.0])], "claim_id string, vec array<double>")
    edges = recommend.top_similar(df, 5)
    assert edges.count() == 6
    model = recommend.SvdModel(None, [0.0], [0.5], 3, 2)
    row = recommend.evaluate_recommender(edges, model).first()
    r = 2**-0.5
    tops = [[0, -r, -1], [r, 0, -1], [r, 0, -r]]  # the own score counts as 0
    assert np.isclose(row["avg_top_n_similarity"], np.mean([np.mean(t) for t in tops]), atol=1e-4)
    assert row["coverage_pct"] == 66.67
    asked = recommend.recommend_batch(spark.createDataFrame([("a",), ("x",)], "claim_id string"), edges).toPandas()
    assert list(asked[asked.claim_id == "x"]["status"]) == ["unknown claim"]
    assert len(asked[asked.claim_id == "a"]) == 2


def test_no_row_gets_more_than_its_list_from_a_block():
    """Zero vectors have the same cosine with everything and a floor that everything reaches."""
    import pyarrow as pa

    from partledger.operators.recommend import _nearest

    right = pa.table({"id": list(range(500)), "unit": [[1.0, 0.0]] * 500})
    left = pa.table({"query": [1000, 1001], "unit": [[0.0, 0.0], [1.0, 0.0]], "floor": [-2_000_000_000, 10**9]})
    found = _nearest(6)(left, right)
    assert sorted(found["other"]) == sorted(list(range(6)) * 2)


def test_wide_tables_of_pivots_take_little_memory(spark, monkeypatch):
    """Rows are held against the pivots in slices; all rows of a batch at once took gigabytes in every worker."""
    sizes = []
    real = recommend._apart
    monkeypatch.setattr(recommend, "_apart", lambda c: sizes.append(c.size) or real(c))
    rng = np.random.default_rng(3)
    points, centres = rng.normal(size=(3000, 3)), rng.normal(size=(2000, 3))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    home, away = recommend._grouped(points, centres)
    assert max(len(points[s]) for s in recommend._slices(3000, 2000)) * 2000 <= 2_000_000
    assert (home == (points @ centres.T).argmax(axis=1)).all() and max(sizes) <= 2_000_000


def test_rows_are_sent_to_few_cells(spark, monkeypatch):
    """Of 20,000 points in six dimensions each row is sent to few other cells, and loses no neighbour."""
    sent = []
    real = recommend.block_join
    monkeypatch.setattr(recommend, "block_join", lambda left, *a: sent.append(left.count()) or real(left, *a))
    rng = np.random.default_rng(4)
    x = rng.normal(size=(20000, 6))
    ids = np.arange(20000)
    df = spark.createDataFrame([(int(i), [float(v) for v in row]) for i, row in zip(ids, x)], "claim_id long, vec array<double>")
    edges = recommend.top_similar(df.coalesce(4)).toPandas()
    assert len(sent) == 2 and sent[1] < 4 * len(x)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    by_claim = edges.sort_values("rank").groupby("claim_id")["other_id"].apply(list)
    for i in range(0, 20000, 500):
        points = np.rint(u @ u[i] * 1e9)
        points[i] = -1e18
        assert by_claim[i] == list(np.lexsort((ids, -points))[:5])


def test_neighbours_in_turns_leave_no_files(spark, monkeypatch):
    """Visits to other cells in several turns give the same neighbours; of all stored tables only the neighbours' stays."""
    from partledger.session import shared_folder

    rng = np.random.default_rng(11)
    points = rng.normal(size=(9000, 6))
    points[100:140] = points[7]
    df = spark.createDataFrame([(f"c{i:05d}", [float(x) for x in p]) for i, p in enumerate(points)], "claim_id string, vec array<double>").coalesce(4)
    want = {(r["claim_id"], r["rank"]): r["other_id"] for r in recommend.top_similar(df).collect()}
    monkeypatch.setattr(recommend, "PASS_VISITS", 1)
    monkeypatch.setattr(recommend, "CELL_ROWS", 100)
    monkeypatch.setattr(recommend, "parallelism", lambda _: 12)
    searched, before = [], set(os.listdir(shared_folder(spark)))
    joined = recommend.block_join
    monkeypatch.setattr(recommend, "block_join", lambda *a: searched.append(1) or joined(*a))
    monkeypatch.setattr(recommend, "PIVOT_ROWS", 250)
    found = {(r["claim_id"], r["rank"]): r["other_id"] for r in recommend.top_similar(df).collect()}
    assert found == want and len(found) == 45_000 and len(searched) > 2
    assert len(set(os.listdir(shared_folder(spark))) - before) == 1


def test_pairs_keep_other_columns(spark):
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 1.0])], "claim_id string, vec array<double>")
    pairs = spark.createDataFrame([("a", "b", 0.25)], "claim_id string, other_id string, found double")
    assert [tuple(r) for r in recommend.pair_similarity(vectors, pairs).collect()] == [("a", "b", 0.7071, 0.25)]
