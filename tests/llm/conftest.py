import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def documents(spark):
    """Make a documents table with clashing extra columns from (doc_id, text, source, lang) rows."""

    def make(rows):
        frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
        extra = ("row", "name", "n", "pos", "kept_before", "score")
        return frame.withColumns({c: F.lit("extra") for c in extra}).withColumn("n_chars", F.length("text").cast("long"))

    return make
