"""An index of shards: their first and last key and their rows, so that a read opens only what it needs.

The index lies in ``_index`` below the shards, where reads of the shards do not see it. It holds
one row per shard and is added to; shards that it has are not opened again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from pairtables import fixed_values as fixed
from pairtables.sources.tables import read_if_there, read_shards

FOLDER = "_index"


def _schema(key: T.StructField) -> T.StructType:
    return T.StructType(
        [
            T.StructField("shard", T.StringType()),
            T.StructField("first_key", key.dataType),
            T.StructField("last_key", key.dataType),
            T.StructField("n_rows", T.LongType()),
        ]
    )


def index_shards(spark: SparkSession, root: str, key: T.StructField) -> DataFrame:
    """Add the shards that the index lacks, reading their key column only, and return the index.

    A shard without rows is not in it, and null keys count as rows. Names are listed by the
    driver, as for any read of the directory.
    """
    path = f"{root}/{FOLDER}"
    known = read_if_there(spark, path, _schema(key))
    rows = read_shards(spark, root, T.StructType([key]), "")
    if known is not None:
        names = rows.select("shard").distinct().join(known.select("shard"), "shard", "left_anti")
        rows = rows.where(F.col("shard").isin([r["shard"] for r in names.collect()]))
    new = rows.groupBy("shard").agg(
        F.min(key.name).alias("first_key"), F.max(key.name).alias("last_key"), F.count(F.lit(1)).alias("n_rows")
    )
    # One small file, or none when nothing is new.
    new.where(F.col("shard").isNotNull()).coalesce(1).write.mode("append").parquet(path)
    return read_index(spark, root, key)


def read_index(spark: SparkSession, root: str, key: T.StructField, prefix: str = fixed.SHARD_PREFIX) -> DataFrame:
    """The index of the shards whose name starts with ``prefix``, with ``start``: the rows of all
    shards before, in the order of keys. A shard that a repeated run has added twice counts once."""
    index = spark.read.schema(_schema(key)).parquet(f"{root}/{FOLDER}").dropDuplicates(["shard"])
    index = index.where(F.col("shard").startswith(prefix))
    before = Window.orderBy(F.asc_nulls_first("first_key"), "shard")  # one narrow row per shard
    return index.withColumn("start", F.sum("n_rows").over(before) - F.col("n_rows"))


def _opened(spark: SparkSession, root: str, schema: T.StructType, index: DataFrame, which: Column) -> tuple[DataFrame, list]:
    """The rows of the shards that a condition on the index names, and these shards."""
    follow = Window.orderBy("start")
    ahead = index.withColumn("_before", F.max("last_key").over(follow.rowsBetween(Window.unboundedPreceding, -1)))
    wanted = ahead.where(which).orderBy("start").collect()
    if any(r["_before"] is not None and r["first_key"] is not None and r["first_key"] <= r["_before"] for r in wanted):
        raise ValueError(f"shards below {root} share a range of keys, so the index gives no positions")
    return read_shards(spark, root, schema).where(F.col("shard").isin([r["shard"] for r in wanted])), wanted


def read_slice(
    spark: SparkSession, root: str, schema: T.StructType, start: int, end: int, key: str = "record_id"
) -> DataFrame:
    """The rows at positions ``start`` to ``end`` (exclusive) in the order of keys, with ``position``
    and ``shard``; shards before and after are not opened. The shards' ranges of keys are apart."""
    index = read_index(spark, root, schema[key])
    inside = (F.col("start") < end) & (F.col("start") + F.col("n_rows") > start)
    rows, shards = _opened(spark, root, schema, index, inside)
    starts = spark.createDataFrame([(r["shard"], r["start"]) for r in shards], "shard string, _start long")
    # A window per shard; a shard is one task's work wherever it is written or read.
    place = F.row_number().over(Window.partitionBy("shard").orderBy(key)).cast("long") - 1
    numbered = rows.withColumn("_place", place).join(F.broadcast(starts), "shard")
    numbered = numbered.withColumn("position", F.col("_start") + F.col("_place"))
    return numbered.where(F.col("position").between(start, end - 1)).select(*schema.names, "shard", "position")


def read_keys(
    spark: SparkSession, root: str, schema: T.StructType, low, high, key: str = "record_id"
) -> DataFrame:
    """The rows whose key is between two keys, both included; opens only shards that may hold some."""
    index = read_index(spark, root, schema[key])
    names = index.where((F.col("first_key") <= F.lit(high)) & (F.col("last_key") >= F.lit(low))).select("shard")
    rows = read_shards(spark, root, schema).where(F.col("shard").isin([r["shard"] for r in names.collect()]))
    return rows.where(F.col(key).between(F.lit(low), F.lit(high)))
