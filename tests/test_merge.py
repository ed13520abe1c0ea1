import math

import pytest
from pyspark.sql import functions as F

from partledger import schemas
from partledger.operators import features, merge, profile

KEYS = ["REFERENCE_NUM", "VEHICLE_MODEL_CODE", "CLAIMNO"]


@pytest.fixture(scope="module")
def small(spark):
    survey = [
        ("R1", "V1", " 1 ", "Front Door", "P001", 10.0, 0),
        ("R1", "V1", "1\t", None, "P001", 30.0, 1),
        ("R2", "V1", "2", "  ", None, -5.0, 0),
        ("R2", "V1", "2", "Lamp", "P002", 0.0, 0),
        ("R2", "V1", "2", "Lamp", "P002", 0.0, 0),
        ("R3", "V1", "3", "Wing", "P003", None, None),
        ("R4", "V1", "4", "Wing", "P003", 5e9, 1),
        (None, "V1", "5", "Wing", "P003", 1.0, 1),
        ("R6", "V1", "6", "Wing", "P003", 1.0, 1),
    ]
    garage = [
        ("R1", "V1", "1", "a", "front door", 9.0),
        ("R1", "V1", "1", "b", "rear door", 8.0),
        ("R2", "V1", "2", "c", "lamp", 1.0),
        ("R3", "V1", "3", "d", "wing", 1.0),
        ("R4", "V1", "4", "e", "wing", 1.0),
        (None, "V1", "5", "f", "wing", 1.0),
        ("R7", "V1", "7", "g", "wing", 1.0),
    ]
    s = merge.clean_claims(spark.createDataFrame(survey, schemas.SURVEYOR), "TXT_PARTS_NAME")
    g = merge.clean_claims(spark.createDataFrame(garage, schemas.GARAGE), "PARTDESCRIPTION")
    return s, g


def test_merge_shape_and_names(small):
    merged = merge.merge_claims(*small)
    assert merged.columns == [
        *KEYS, "TXT_PARTS_NAME", "NUM_PART_CODE", "TOTAL_AMOUNT", "IS_FRAUD", "PARTNO", "PARTDESCRIPTION", "TOTAL_AMOUNT_garage",
    ]
    assert merged.groupBy("CLAIMNO").count().toPandas().set_index("CLAIMNO")["count"].to_dict() == {
        "1": 4, "2": 3, "3": 1, "4": 1,
    }
    first = merged.where("CLAIMNO = '1' and PARTNO = 'a'").toPandas()
    assert sorted(first["TOTAL_AMOUNT"]) == [10.0, 30.0]  # the survey amount
    assert set(first["TXT_PARTS_NAME"]) == {"front door", ""}


def test_null_keys_on_request(small):
    assert merge.merge_claims(*small, null_keys_match=True).where("CLAIMNO = '5'").count() == 1


def test_merge_errors(spark, small):
    s, g = small
    with pytest.raises(ValueError):
        merge.merge_claims(s.select("TXT_PARTS_NAME"), g)
    with pytest.raises(ValueError):
        merge.merge_claims(s.where("CLAIMNO = '6'"), g, require_rows=True)
    assert merge.merge_claims(s.drop("REFERENCE_NUM"), g).where("CLAIMNO = '5'").count() == 1


def test_cap_drops_nulls_and_outliers(spark, small):
    rows = [(float(i),) for i in range(1000)] + [(None,), (2e6,)]
    df = spark.createDataFrame(rows, "CLAIM_AMOUNT double")
    kept = merge.filter_amount_cap(df)
    assert kept.count() == 1000
    assert merge.filter_amount_cap(spark.range(3)).count() == 3


def test_features_with_and_without_fanout(small):
    s, g = small
    capped = merge.filter_amount_cap(merge.merge_claims(s, g))
    plain = features.claim_features(capped, label="IS_FRAUD").toPandas().set_index("CLAIMNO")
    weighted = features.claim_features(merge.claim_rows(s, g), merge.FANOUT, label="IS_FRAUD")
    weighted = weighted.toPandas().set_index("CLAIMNO").loc[plain.index]
    assert abs(plain - weighted).max().max() < 1e-9
    one = plain.loc["1"]
    assert (one.total_amount, one.part_count, one.IS_FRAUD) == (80.0, 4, 1)
    assert math.isclose(one.std_part_amount, math.sqrt(4 * 100 / 3))
    two = plain.loc["2"]
    assert two.coeff_variation == 0 and two.total_amount == -5.0  # mean not above zero
    assert "3" not in plain.index  # no amount


def test_weights_over_several_keys_of_one_claim(spark):
    survey = [("A", "V", "1", "x", "P", float(v), 0) for v in (1, 2, 3)] + [("B", "V", "1", "x", "P", float(v), 0) for v in (7, 8)]
    garage = [("A", "V", "1", "n", "g", 1.0)] * 2 + [("B", "V", "1", "n", "g", 1.0)] * 3
    s, g = spark.createDataFrame(survey, schemas.SURVEYOR), spark.createDataFrame(garage, schemas.GARAGE)
    plain = features.claim_features(merge.filter_amount_cap(merge.merge_claims(s, g))).toPandas()
    weighted = features.claim_features(merge.claim_rows(s, g), merge.FANOUT).toPandas()
    assert abs(plain.drop(columns="CLAIMNO") - weighted.drop(columns="CLAIMNO")).max().max() < 1e-9


def test_equal_amounts_have_no_spread(spark):
    rows = spark.createDataFrame([("1", 0.1, 3)] * 7 + [("1", 0.1, 2)] * 3, "CLAIMNO string, TOTAL_AMOUNT double, fanout int")
    assert features.claim_features(rows, "fanout").first().std_part_amount < 1e-12


def test_labels_and_quotes(spark, small):
    plain = features.claim_features(merge.merge_claims(*small))
    labelled = features.attach_labels(plain, small[0]).toPandas().set_index("CLAIMNO")["IS_FRAUD"].to_dict()
    assert labelled == {"1": 1, "2": 0, "3": 0, "4": 1}
    assert features.attach_labels(plain, small[0].drop("IS_FRAUD")).columns == plain.columns
    quotes = spark.createDataFrame([(100.0, 0), (100.0, 1), (90.0, 3), (0.0, 2)], "total_amount double, part_count int")
    found = features.quote_features(quotes).toPandas()
    assert list(found["avg_part_amount"]) == [100.0, 100.0, 30.0, 0.0]
    assert list(found["amount_range"]) == [0.0, 0.0, 60.0, 0.0]


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(500).select((F.col("id") % 50).alias("a"), F.lit("x").alias("b"))
    taken = merge.sample_n(df, 123).toPandas()
    assert len(taken) == 123 and taken.groupby("a").size().max() <= 10
    assert merge.sample_n(df.repartition(7), 123).toPandas().value_counts().to_dict() == taken.value_counts().to_dict()
    assert merge.sample_n(df, 0).count() == merge.sample_n(df, None).count() == merge.sample_n(df, 10**6).count() == 500


def test_profile(small):
    s, _ = small
    assert profile.duplicate_rows(s).first()["duplicates"] == 1
    missing = {r["column_name"]: r["missing"] for r in profile.missing_values(s).collect()}
    assert missing["TOTAL_AMOUNT"] == 1 and missing["REFERENCE_NUM"] == 1 and missing["TXT_PARTS_NAME"] == 0
    top = profile.common_parts(s, "TXT_PARTS_NAME").first()
    assert (top.part_name, top["count"], top.percentage) == ("wing", 4, 44.44)
    codes = {r[0]: r[1] for r in profile.primary_part_distribution(s, "NUM_PART_CODE").collect()}
    assert codes == {"P001": 2, "P002": 2, "P003": 4}


def test_small_samples_are_the_same_rows(spark, monkeypatch):
    df = spark.range(300).selectExpr("id % 90 AS a", "cast(id % 7 AS string) AS b").union(spark.sql("SELECT 5L, 'x' FROM range(40)"))
    written, real = [], merge.checkpointed
    monkeypatch.setattr(merge, "checkpointed", lambda x: written.append(real(x)) or written[-1])
    few = sorted(map(tuple, merge.sample_n(df, 50).collect()))
    assert [x.count() for x in written] == [50]  # only so many distinct rows are ordered
    monkeypatch.setattr(merge, "FEW_ROWS", 0)
    assert sorted(map(tuple, merge.sample_n(df, 50).collect())) == few and len(few) == 50


def test_claim_rows_carry_only_the_columns_that_are_read(small):
    s, g = small
    whole, narrow = merge.claim_rows(s, g), merge.claim_rows(s, g, keep=["CLAIMNO", "IS_FRAUD"])
    assert narrow.columns == ["CLAIMNO", "IS_FRAUD", "TOTAL_AMOUNT", merge.FANOUT]
    assert sorted(map(str, narrow.collect())) == sorted(map(str, whole.select(narrow.columns).collect()))


def test_cap_of_merged_rows_from_the_fanout(spark):
    survey = [("A", "V", "1", "x", "P", float(v), 0) for v in range(200)] + [("B", "V", "2", "x", "P", 5e5, 0)]
    garage = [("A", "V", "1", "n", "g", 1.0)] + [("B", "V", "2", "n", "g", 1.0)] * 9
    s, g = spark.createDataFrame(survey, schemas.SURVEYOR), spark.createDataFrame(garage, schemas.GARAGE)
    merged, counted = merge.merge_claims(s, g), merge.matched_survey(s, g).select("TOTAL_AMOUNT", merge.FANOUT).localCheckpoint()
    plain = merge.filter_amount_cap(merged)
    found = merge.filter_amount_cap(merged, "TOTAL_AMOUNT", merge.FANOUT, counted)
    assert plain.count() == found.count() == 209  # without the fan-out the cap would leave out the last claim
    assert merge.filter_amount_cap(merged, "TOTAL_AMOUNT", None, s).count() == 200
