"""Surveyor, garage and primary-part tables derived from the benchmark's order tables.

One SQL text serves Spark and the SQL oracle, so both see the same input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

GARAGE_SQL = """
SELECT 'R' || CAST(l_orderkey AS STRING)      AS REFERENCE_NUM,
       'V' || CAST(o_custkey % 7 AS STRING)   AS VEHICLE_MODEL_CODE,
       CAST(l_orderkey AS STRING)             AS CLAIMNO,
       l_partkey                              AS PARTNO,
       p_name || ' ' || p_type                AS PARTDESCRIPTION,
       l_extendedprice                        AS TOTAL_AMOUNT
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey
"""

PRIMARY_PARTS_SQL = """
SELECT w AS PART_CATEGORY, 'P' || lpad(CAST(row_number() OVER (ORDER BY w) AS STRING), 3, '0') AS NUM_PART_CODE
FROM (SELECT DISTINCT upper(split_part(p_name, ' ', 1)) AS w FROM {part}) d
"""

SURVEYOR_SQL = """
SELECT 'R' || CAST(l_orderkey AS STRING)      AS REFERENCE_NUM,
       'V' || CAST(o_custkey % 7 AS STRING)   AS VEHICLE_MODEL_CODE,
       CAST(l_orderkey AS STRING)             AS CLAIMNO,
       CASE l_partkey % 4
            WHEN 0 THEN p_name || ' ' || p_type
            WHEN 1 THEN p_type || ' - ' || p_name
            WHEN 2 THEN replace(replace(p_name, 'widget', 'wdgt'), 'gear', 'gr') || ' ' || p_type
            ELSE upper(p_name) || ',  ' || p_type END AS TXT_PARTS_NAME,
       NUM_PART_CODE,
       l_extendedprice * (1 - l_discount)
             * CASE WHEN o_orderpriority = '1-URGENT' THEN 3.0 ELSE 1.0 END AS TOTAL_AMOUNT,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS IS_FRAUD
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey
JOIN {primary_parts} ON PART_CATEGORY = upper(split_part(p_name, ' ', 1))
"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def garage(spark: SparkSession, folder: str) -> DataFrame:
    tables = {n: table(spark, folder, n) for n in ("lineitem", "orders", "part")}
    return spark.sql(GARAGE_SQL, **tables)


def primary_parts(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(PRIMARY_PARTS_SQL, part=table(spark, folder, "part"))


def surveyor(spark: SparkSession, folder: str) -> DataFrame:
    tables = {n: table(spark, folder, n) for n in ("lineitem", "orders", "part")}
    return spark.sql(SURVEYOR_SQL, primary_parts=primary_parts(spark, folder), **tables)
