import numpy as np
import pytest
from pyspark.sql import functions as F

from partledger.config import FEATURES, TRUTH
from partledger.operators import evaluate, forest, iforest, sampling
from partledger.plans import lookups
from partledger.sources import models


def blob(spark, normal, far, seed=0):
    rng = np.random.default_rng(seed)
    x = np.vstack([rng.normal(0, 1, (normal, 9)), rng.normal(8, 1, (far, 9))])
    rows = [(f"c{i:04d}", *map(float, r), int(i >= normal)) for i, r in enumerate(x)]
    schema = "CLAIMNO string, " + ", ".join(f"{f} double" for f in FEATURES) + ", IS_FRAUD int"
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("normal, far", [(200, 10), (900, 60)])
def test_isolation_forest(spark, normal, far, tmp_path):
    df = blob(spark, normal, far)
    model = iforest.fit(df, trees=60)
    assert model.sample == min(256, normal + far)
    scored = iforest.score(df, model).toPandas()
    assert abs(scored["is_fraud"].sum() - 0.1 * len(scored)) <= 1.5
    assert scored.nsmallest(far, "anomaly_score")[TRUTH].mean() > 0.95
    assert ((scored["anomaly_score"] < 0) == (scored["anomaly_label"] == -1)).all()
    iforest.save(model, spark, str(tmp_path / "m"))
    again = iforest.score(df, iforest.load(spark, str(tmp_path / "m"))).toPandas()
    assert np.allclose(again["anomaly_score"], scored["anomaly_score"])
    sizes = model.nodes.groupby("tree").size()
    assert len(sizes) == 60 and sizes.max() <= 2 * model.sample


def test_every_row_can_be_drawn(spark):
    """Of 20,000 rows that differ in one value, far more than a pool of trees x sample rows come up as split bounds' neighbours."""
    df = spark.range(20_000).select(F.col("id").cast("string").alias("CLAIMNO"), *[F.col("id").cast("double").alias(f) for f in FEATURES])
    small = [iforest.fit(df, trees=4, sample=16, seed=k).nodes for k in range(6)]
    splits = np.concatenate([n.loc[n["feature"] >= 0, "split"].to_numpy() for n in small])
    scale = (splits - splits.min()) / (splits.max() - splits.min())
    assert len(np.unique(splits)) > 200 and np.histogram(scale, 10)[0].min() > 0


def test_isolation_forest_needs_rows(spark):
    with pytest.raises(ValueError):
        iforest.fit(blob(spark, 5, 0).where("IS_FRAUD = 9"))


def test_expected_path():
    assert np.allclose(iforest.expected_path([0, 1, 2]), [0, 0, 1])
    harmonic = sum(1 / i for i in range(1, 256))
    assert abs(float(iforest.expected_path(256)) - (2 * harmonic - 2 * 255 / 256)) < 0.01


def test_random_forest_beats_the_baselines(spark, tmp_path):
    rng = np.random.default_rng(4)
    df = blob(spark, 500, 80).withColumn("total_amount", F.col("total_amount") + F.rand(1))
    split = sampling.stratified_split(df, "CLAIMNO")
    train, test = (split.where(F.col("split") == s).drop("split") for s in ("train", "test"))
    params = forest.ForestParams(trees=15, depth=5)
    model = forest.fit(train, params=params)
    scored = forest.score(test, model)
    f1 = evaluate.binary_metrics(scored, TRUTH, "is_fraud").first()["f1_score"]
    flat = evaluate.binary_metrics(iforest.score(test, iforest.fit(train, trees=30)), TRUTH, "is_fraud").first()["f1_score"]
    assert f1 >= flat and f1 > 0.9
    folder = str(tmp_path)
    models.save_forest(model, spark, folder)
    found = models.load_available(spark, folder)
    assert list(found) == [models.FOREST] and found[models.FOREST].threshold == model.threshold
    again = forest.score(test, found[models.FOREST])
    assert scored.select("CLAIMNO", "fraud_probability").exceptAll(again.select("CLAIMNO", "fraud_probability")).isEmpty()
    top = forest.importances(spark, model).toPandas()
    assert len(top) == 9 and abs(top["importance"].sum() - 1) < 0.01 and top["importance"].is_monotonic_decreasing


def test_folds_and_grid(spark):
    folds = sampling.repeated_folds(blob(spark, 150, 40), "CLAIMNO", splits=3, repeats=1)
    ranking = forest.grid_search(folds, {"trees": [3], "depth": [2, 4], "min_split": [2]})
    assert len(ranking) == 2 and ranking[0][1] >= ranking[1][1]
    table = forest.fold_table(spark, forest.cross_validate(folds, params=ranking[0][0]))
    assert table.count() == 15
    assert {r["folds"] for r in forest.cv_summary(table).collect()} == {3}


def test_quotes(spark):
    model = iforest.fit(blob(spark, 300, 20), trees=20)
    quotes = spark.createDataFrame([(0.5, 1), (90.0, 3)], "total_amount double, part_count int")
    found = lookups.score_quotes(quotes, model).toPandas()
    assert set(found["status"]) <= {"SUSPICIOUS", "NORMAL"} and found.loc[1, "status"] == "SUSPICIOUS"


def test_queries_run_the_published_job():
    from partledger.config import DEFAULTS
    from partledger.plans import workspace

    assert workspace.QUERY_FOREST == forest.ForestParams() and workspace.QUERY_FOREST.trees == 300 and workspace.QUERY_FOREST.depth == 12
    assert len(forest.grid_points(workspace.QUERY_GRID)) == 36 and workspace.QUERY_GRID == DEFAULTS.grid
    assert workspace.QUERY_SPLITS * workspace.QUERY_REPEATS == 15


def test_isolation_scores_run_on_all_cores(spark):
    df = blob(spark, 60, 10).coalesce(1)
    model = iforest.fit(df, trees=5)
    assert iforest.raw_scores(df, model).rdd.getNumPartitions() > 1
    x = np.random.default_rng(1).normal(size=(40, len(model.features)))
    x[3, 2] = np.nan
    paths = []
    for row in x:
        total = 0.0
        for _, tree in model.nodes.groupby("tree"):
            nodes, at = tree.set_index("node"), 0
            while nodes.loc[at, "feature"] >= 0:
                at = nodes.loc[at, "left" if row[nodes.loc[at, "feature"]] <= nodes.loc[at, "split"] else "right"]
            total += nodes.loc[at, "path"]
        paths.append(total / 5)
    assert np.allclose(iforest._mean_path(x, iforest._walkable(model.nodes)), paths)
