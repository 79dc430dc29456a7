"""Session settings and the shared folder that jobs may write intermediate tables to."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streams keep the keys they have seen on disk, not in the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Texts differ in length by three orders of magnitude, so an Arrow batch is
    # bounded by bytes as well as by rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}


def build_session(app_name: str = "pairtables", **extra: str) -> SparkSession:
    """A session with the settings the jobs are tuned for; ``extra`` keys use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The parent of all tables that this application writes; drop it when they are done with.

    It is below ``spark.checkpoint.dir``, or below the warehouse where that is not set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/pairtables-{spark.sparkContext.applicationId}"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new, unused path for a table that all executors can read."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}/{name}"


def drop_shared_folder(spark: SparkSession) -> None:
    """Remove the tables that this application wrote; none of its results can be read after that."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: computed once, and kept when an
    executor is lost."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
