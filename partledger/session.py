"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks; a cluster job brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("partledger")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application; they may not have it on their path."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="partledger-"), "partledger")
    context.addPyFile(shutil.make_archive(archive, "zip", os.path.dirname(package), os.path.basename(package)))
    _shipped.add(context.applicationId)


_local_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A local test session without that setting gets a temporary folder; a cluster session without it is an error,
    because executors could not see each other's files.
    """
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    _local_folder = _local_folder or tempfile.mkdtemp(prefix="partledger-")
    return _local_folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and continue from its files.

    Used where an intermediate table is read several times. Unlike cached blocks the files outlive any executor;
    unlike an RDD checkpoint they are columnar, so readers prune columns, push filters down and know the size.
    Shuffle files of a query that has ended go at once from here on: whatever is read again is a written table.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def released(*tables: DataFrame) -> None:
    """Delete the files of ``checkpointed`` tables that nobody will read again; other files stay."""
    for table in tables:
        spark = table.sparkSession
        root = os.path.basename(shared_folder(spark))
        for folder in {os.path.dirname(f) for f in table.inputFiles()}:
            if os.path.basename(os.path.dirname(folder)) == root:
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
