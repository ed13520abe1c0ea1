import pytest
from pyspark.sql import functions as F

from partledger import schemas
from partledger.config import Settings
from partledger.operators import forest
from partledger.plans import training
from partledger.sources import files, models, views
from partledger.streaming import requests

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("run"))
    folder = str(tmp_path_factory.mktemp("data"))
    files.write_csv(views.surveyor(spark, FOLDER), f"{folder}/{files.SURVEYOR_FILE}")
    files.write_csv(views.garage(spark, FOLDER), f"{folder}/{files.GARAGE_FILE}")
    survey, garage, primary = files.read_claims(spark, folder)
    assert primary.count() == 0 and primary.columns == schemas.PRIMARY_PARTS.names
    settings = Settings(iso_trees=30, cv_splits=2, cv_repeats=1)
    run = training.run(spark, survey, garage, out, settings, params=forest.ForestParams(trees=5, depth=4))
    return run, out, survey, garage


def test_every_stage_reports(spark, trained):
    run, out, _, _ = trained
    assert set(run.metrics) == {"data", "part_matching", "association_mining", "recommender", "fraud_detection", "common_parts"}
    assert not [s for s, m in run.metrics.items() if "error" in m], run.metrics
    assert run.metrics["data"]["merged_rows"] == 30016
    stored = spark.read.json(f"{out}/metrics")
    assert stored.where("metric = 'forest_f1_score'").count() == 1
    assert spark.read.parquet(f"{out}/fraud_predictions").count() == run.tables["features"].count()
    assert set(models.load_available(spark, f"{out}/models")) == {
        models.MATCHER, models.RECOMMENDER, models.ANOMALY, models.FOREST,
    }


def test_failing_stage_is_reported(spark, trained, tmp_path):
    _, _, survey, garage = trained
    broken = survey.where("CLAIMNO = '0'").withColumn("TXT_PARTS_NAME", F.lit("")).drop("IS_FRAUD")
    settings = Settings(iso_trees=5)
    run = training.run(spark, broken, garage, str(tmp_path), settings)
    assert "error" in run.metrics["part_matching"] and "error" in run.metrics["recommender"]
    assert "total_claims" not in run.metrics["part_matching"] and run.metrics["data"]["surveyor_rows"] > 0


def test_sampling_run_uses_the_sample(spark, trained, tmp_path):
    _, _, survey, garage = trained
    settings = Settings(iso_trees=10, sample_size=2000, cv_splits=2, cv_repeats=1)
    run = training.run(spark, survey.drop("IS_FRAUD"), garage, str(tmp_path), settings)
    assert run.metrics["data"]["merged_rows"] == 2000
    assert "forest_f1_score" not in run.metrics["fraud_detection"]


def test_columns_of_other_names(spark, trained, tmp_path):
    """An amount, claim or label under another name; an amount on the garage side only; none at all."""
    _, _, survey, garage = trained
    settings = Settings(iso_trees=5, cv_splits=2, cv_repeats=1, sample_size=1500)
    params = forest.ForestParams(trees=3, depth=3)
    other = survey.withColumnsRenamed({"TOTAL_AMOUNT": "CLAIM_AMOUNT", "IS_FRAUD": "FRAUD_FLAG"})
    run = training.run(spark, other, garage, str(tmp_path / "a"), settings, params=params)
    assert not [s for s, m in run.metrics.items() if "error" in m], run.metrics
    assert "forest_all_f1_score" in run.metrics["fraud_detection"]
    run = training.run(spark, survey.drop("TOTAL_AMOUNT"), garage, str(tmp_path / "b"), settings, params=params)
    assert not [s for s, m in run.metrics.items() if "error" in m], run.metrics
    with pytest.raises(ValueError):
        training.run(spark, survey.drop("TOTAL_AMOUNT"), garage.drop("TOTAL_AMOUNT"), str(tmp_path / "c"), settings)


def test_grid_search_is_the_normal_path(spark, trained, tmp_path):
    _, _, survey, garage = trained
    grid = {"trees": [2, 3], "depth": [2, None], "min_split": [2, 5]}
    settings = Settings(iso_trees=5, cv_splits=2, cv_repeats=1, grid=grid)
    run = training.run(spark, survey, garage, str(tmp_path), settings)
    assert "forest_best_params" in run.metrics["fraud_detection"], run.metrics["fraud_detection"]
    kept = models.load_available(spark, f"{tmp_path}/models")[models.FOREST]
    assert set(kept.parts) == {"importances", "report", "folds", "grid"} and kept.parts["grid"].count() == 8


def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_csv(spark, str(tmp_path / "none.csv"), schemas.GARAGE, "Garage")


def test_csv_nulls_and_types(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text('CLAIMNO,IS_FRAUD,TOTAL_AMOUNT,TXT_PARTS_NAME,EXTRA\n007,1.0,NaN,"a, ""b""",x\nNA,,12.5,null,y\n')
    rows = files.read_csv(spark, str(path), schemas.SURVEYOR).collect()
    assert tuple(rows[0]) == ("007", 1, None, 'a, "b"', "x")
    assert tuple(rows[1]) == (None, None, 12.5, None, "y")


def test_request_streams(spark, trained, tmp_path):
    _, out, _, _ = trained
    loaded = models.load_available(spark, f"{out}/models")
    source = tmp_path / "names"
    spark.createDataFrame([("Red-WIDGET economy",), ("zzz",)], "name string").write.json(str(source))
    stream = spark.readStream.schema("name string").json(str(source))
    q = requests.part_answers(stream, loaded[models.MATCHER], str(tmp_path / "answers"), str(tmp_path / "cp1"))
    q.processAllAvailable()
    q.stop()
    assert spark.read.parquet(str(tmp_path / "answers")).count() == 2

    quotes = tmp_path / "quotes"
    spark.createDataFrame([(10.0, 1), (9e7, 3)], "total_amount double, part_count int").write.json(str(quotes))
    stream = spark.readStream.schema("total_amount double, part_count int").json(str(quotes))
    scores = requests.quote_scores(stream, loaded[models.ANOMALY])
    q = scores.writeStream.format("memory").queryName("quote_scores").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("quote_scores").count() == 2

    ids = tmp_path / "ids"
    spark.createDataFrame([("0",), ("nobody",)], "claim_id string").write.json(str(ids))
    stream = spark.readStream.schema("claim_id string").json(str(ids))
    q = requests.claim_answers(stream, loaded[models.RECOMMENDER], str(tmp_path / "claims"), str(tmp_path / "cp2"))
    q.processAllAvailable()
    q.stop()
    assert spark.read.parquet(str(tmp_path / "claims")).where("status = 'unknown claim'").count() == 1
