"""Block join: compare every row of one side with every row of its cell on the other side.

For best-match and distance operators that have no equality key. Each cell is cut into blocks of bounded size
on both sides, however large the cell is; a task holds one block of each side and emits a reduced result per
left row (its best candidates, its distance sums), never the pairs.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

BLOCK_ROWS = 2048


def parallelism(spark: SparkSession) -> int:
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread(df: DataFrame) -> DataFrame:
    """The rows over all cores: narrow rows lie in few files, and Python work on them costs far more than this shuffle.

    Rows that come from no file, such as a few requests, stay where and in the order they are if every core has a part already.
    """
    if not df.isStreaming and not df.inputFiles() and df.rdd.getNumPartitions() >= df.sparkSession.sparkContext.defaultParallelism:
        return df
    return df.repartition(parallelism(df.sparkSession))


def block_join(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    right_id: str,
    kernel: Callable[[pa.Table, pa.Table], pd.DataFrame],
    schema: str,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Both sides carry an integer ``cell``; left rows may occur in several cells. Cells must be few.

    Returns the kernel's rows of all block pairs; the caller merges them per left id.
    """
    blocks = {}
    for side, df in (("l", left), ("r", right)):
        size = F.ceil(F.count(F.lit(1)) / block_rows).cast("int")
        blocks[side] = df.groupBy("cell").agg(size.alias(f"{side}_blocks"))
    grid = F.broadcast(blocks["l"].join(blocks["r"], "cell"))
    numbered = []
    for df, key, own, other in ((left, left_id, "l", "r"), (right, right_id, "r", "l")):
        own_block = F.pmod(F.xxhash64(key), F.col(f"{own}_blocks")).cast("int")
        every_other = F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1))
        numbered.append(
            df.join(grid, "cell")
            .withColumn(f"{own}_block", own_block)
            .withColumn(f"{other}_block", every_other)
            .drop("l_blocks", "r_blocks")
        )
    keys = ["cell", "l_block", "r_block"]
    # Comparing costs far more than the bytes shuffled, so the number of tasks is fixed here: adaptive merging of
    # small partitions would leave most cores idle. Renaming gives fresh columns; the sides may share lineage.
    tasks = 4 * parallelism(left.sparkSession)
    grouped = [df.toDF(*df.columns).repartition(tasks, *keys).groupBy(*keys) for df in numbered]

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def compare(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return pa.table({n: [] for n in names}, schema=arrow)
        return pa.Table.from_pandas(kernel(a, b), schema=arrow, preserve_index=False)

    return grouped[0].cogroup(grouped[1]).applyInArrow(compare, schema)


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """A list column of equal lengths as a two-dimensional array."""
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)
