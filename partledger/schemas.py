"""Schemas of the three input tables. Identifiers are read as text so that keys keep their spelling."""

from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


SURVEYOR = _schema(
    REFERENCE_NUM=T.StringType(),
    VEHICLE_MODEL_CODE=T.StringType(),
    CLAIMNO=T.StringType(),
    TXT_PARTS_NAME=T.StringType(),
    NUM_PART_CODE=T.StringType(),
    TOTAL_AMOUNT=T.DoubleType(),
    IS_FRAUD=T.IntegerType(),
)

GARAGE = _schema(
    REFERENCE_NUM=T.StringType(),
    VEHICLE_MODEL_CODE=T.StringType(),
    CLAIMNO=T.StringType(),
    PARTNO=T.StringType(),
    PARTDESCRIPTION=T.StringType(),
    TOTAL_AMOUNT=T.DoubleType(),
)

PRIMARY_PARTS = _schema(PART_CATEGORY=T.StringType(), NUM_PART_CODE=T.StringType())
