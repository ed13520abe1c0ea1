import numpy as np
import pytest
from pyspark.sql import functions as F

from partledger.operators import ordering
from partledger.operators.ordering import exact_quantiles, hash_rank, running_totals
from partledger.operators.sampling import repeated_folds, stratified_split


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(1)
    values = np.round(rng.lognormal(3, 1, 3000), 2)
    values[:1000] = 7.0  # one value holds a third of the rows
    groups = rng.integers(0, 3, 3000)
    weights = rng.integers(1, 5, 3000)
    rows = [(int(g), float(v), int(w)) for g, v, w in zip(groups, values, weights)]
    return spark.createDataFrame(rows, "g int, v double, w int"), groups, values, weights


def test_quantiles(numbers):
    df, groups, values, weights = numbers
    found = exact_quantiles(df, "v", {"a": 0.0, "b": 0.37, "c": 0.99, "d": 1.0}, by=["g"])
    for row in found.collect():
        wanted = np.quantile(values[groups == row.g], [0.0, 0.37, 0.99, 1.0])
        assert np.allclose([row.a, row.b, row.c, row.d], wanted, rtol=1e-12)
    weighted = exact_quantiles(df, "v", {"p": 0.99}, weight="w").first()["p"]
    assert np.isclose(weighted, np.quantile(np.repeat(values, weights), 0.99), rtol=1e-12)


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_over_ranges(numbers, descending):
    df, _, values, _ = numbers
    counts = df.groupBy("v").agg(F.count("*").alias("n"))
    rows = running_totals(counts, "v", ["n"], descending=descending).collect()
    for row in rows:
        wanted = (values >= row.v).sum() if descending else (values <= row.v).sum()
        assert row.cum_n == wanted


def test_hash_rank_is_a_permutation_per_group(spark):
    df = spark.range(5000).withColumn("g", F.when(F.col("id") % 3 == 0, 1).otherwise(0))
    ranked = hash_rank(df, F.col("id"), ["g"]).toPandas()
    for _, part in ranked.groupby("g"):
        assert sorted(part["rank"]) == list(range(1, len(part) + 1))
    again = hash_rank(df.repartition(13), F.col("id"), ["g"]).toPandas()
    merged = ranked.merge(again, on="id")
    assert (merged["rank_x"] == merged["rank_y"]).all()


def test_null_labels_keep_their_rows(spark):
    rows = spark.createDataFrame([(i, None if i % 10 == 0 else i % 2) for i in range(100)], "claim_id int, is_fraud int")
    split = stratified_split(rows, "claim_id", "is_fraud", 0.2)
    assert split.count() == 100
    assert split.where("is_fraud IS NULL AND split = 'test'").count() == 2
    assert repeated_folds(rows, "claim_id", "is_fraud", 5, 3).count() == 300
    assert running_totals(rows.withColumn("n", F.lit(1)), "claim_id", ["n"], by=["is_fraud"]).count() == 100


def test_quantiles_read_value_by_value_only_near_their_places(spark, monkeypatch):
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.lognormal(3, 2, 4000), np.full(500, 7.0), [-1e9, 1e12]])
    weights, groups = rng.integers(1, 5, len(values)), rng.integers(0, 2, len(values))
    rows = [(None if g else 0, float(v), int(n)) for g, v, n in zip(groups, values, weights)]
    df = spark.createDataFrame(rows, "g int, v double, w int").repartition(7)
    seen = []
    near_counts = ordering._near_counts
    monkeypatch.setattr(ordering, "FEW_VALUES", 100)
    monkeypatch.setattr(ordering, "BINS", 64)
    monkeypatch.setattr(ordering, "MAX_ROUNDS", 9)
    monkeypatch.setattr(ordering, "_near_counts", lambda *a: seen.append(near_counts(*a)) or seen[-1])
    shares = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.99, "e": 1.0}
    for row in exact_quantiles(df, "v", shares, by=["g"]).collect():
        mine = groups == (row.g is None)
        assert np.allclose([row[n] for n in shares], np.quantile(values[mine], list(shares.values())), rtol=1e-12)
    for row in exact_quantiles(df, "v", shares, weight="w", by=["g"]).collect():
        mine = groups == (row.g is None)
        wanted = np.quantile(np.repeat(values[mine], weights[mine]), list(shares.values()))
        assert np.allclose([row[n] for n in shares], wanted, rtol=1e-12)
    whole = exact_quantiles(df, "v", {"p": 0.99}, weight="w").first()["p"]
    assert np.isclose(whole, np.quantile(np.repeat(values, weights), 0.99), rtol=1e-12)
    for counts, total in zip(seen, (len(values), weights.sum(), weights.sum())):
        assert counts.agg(F.sum("_n")).first()[0] == total
        assert counts.count() < len(values) / 2


def test_quantiles_of_infinite_values(spark, monkeypatch):
    monkeypatch.setattr(ordering, "FEW_VALUES", 1)
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 5, "-inf", "inf")], "v double")
    assert exact_quantiles(df, "v", {"p": 0.5}).first()["p"] == 3.0


@pytest.mark.parametrize("ratio", [0.0, 0.2, 1.0])
def test_split_takes_the_first_hashes_and_orders_one_range(spark, ratio):
    import hashlib

    df = spark.range(6000).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("c"))
    split = stratified_split(df, "k", "c", ratio)
    for c in (None, 1, 2):
        keys = sorted((str(i) for i in range(6000) if (i % 3 or None) == c), key=lambda k: hashlib.md5(k.encode()).hexdigest())
        found = {r.k for r in split.where(F.col("c").eqNullSafe(F.lit(c)) & (F.col("split") == "test")).collect()}
        assert found == set(keys[: round(ratio * len(keys))])
    single = stratified_split(df.select("k"), "k", "c", ratio)
    assert single.where("split = 'test'").count() == round(ratio * 6000) and single.count() == 6000
    nulls = spark.createDataFrame([(None, 0)] * 10, "k string, c int")
    assert stratified_split(nulls, "k", "c", 0.3).where("split = 'test'").count() == 3
