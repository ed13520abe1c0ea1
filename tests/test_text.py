import pytest
from pyspark.sql import functions as F

from partledger.functions import numbers, text
from partledger.functions.columns import resolve_column


def one(spark, value, build):
    return spark.createDataFrame([(value,)], "t string").select(build(F.col("t")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "raw, cleaned",
    [
        (None, ""),
        ("  Front-Door,  LH ", "front door lh"),
        ("a\tb\n c", "a b c"),
        ("Café No.1", "caf no 1"),
        ("***", ""),
    ],
)
def test_clean_text(spark, raw, cleaned):
    assert one(spark, raw, text.clean_text) == cleaned


def test_key_keeps_inner_space(spark):
    assert one(spark, "\t 1 2 \n", text.normalise_key) == "1 2"


def test_tokens_and_ngrams(spark):
    assert one(spark, "door a lh front", lambda c: text.ngrams(text.tokens(c))) == [
        "door", "lh", "front", "door lh", "lh front",
    ]
    assert one(spark, "a b", lambda c: text.ngrams(text.tokens(c))) == []
    assert one(spark, "door", lambda c: text.ngrams(text.tokens(c), 1, 3)) == ["door"]


def test_token_sort_key(spark):
    assert one(spark, "Rear,Door  (LH)", text.token_sort_key) == "door lh rear"
    assert one(spark, "!!", text.token_sort_key) == ""
    assert one(spark, "café b", text.token_sort_key) == "b caf"


def test_synonyms_and_labels(spark):
    assert one(spark, "fr door assy x", text.canonical_parts) == "front door assembly x"
    assert one(spark, "  rear lamp", text.first_word_category) == "REAR"
    assert one(spark, "  ", text.first_word_category) == "OTHER"
    assert one(spark, None, text.first_word_category) == "OTHER"
    assert one(spark, "total_amount", text.title_case) == "Total Amount"
    assert one(spark, "0.98334", lambda c: text.percent_text(c.cast("double"))) == "98.33%"
    assert one(spark, None, lambda c: text.percent_text(c.cast("double"))) == "N/A"


def test_numbers(spark):
    row = spark.range(1).select(
        numbers.rounded(F.lit(2.675), 2).alias("tie"),
        numbers.clip(F.lit(7.0), 0, 5).alias("clip"),
        numbers.ratio_or_zero(F.lit(1), F.lit(0)).alias("zero"),
    ).first()
    assert (row.tie, row.clip, row.zero) == (2.68, 5.0, 0.0)


def test_resolve_column(spark):
    df = spark.createDataFrame([], "PART_CODE string, PART_X string, CLAIM_AMOUNT double")
    assert resolve_column(df, "PART", exclude="CODE") == "PART_X"
    assert resolve_column(df, "AMOUNT", preferred=["TOTAL_AMOUNT"]) == "CLAIM_AMOUNT"
    with pytest.raises(ValueError):
        resolve_column(df, "LABEL")
