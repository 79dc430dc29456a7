"""Parquet tables: read, append, shard and consolidate."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from pairtables import fixed_values as fixed
from pairtables.operators.position import ROWS_PER_BUCKET, with_batches
from pairtables.operators.prefilter import split_by_keys
from pairtables.session import stored


def read_dataset(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All shards under a path as one table."""
    return spark.read.schema(schema).parquet(path)


def append_dataset(df: DataFrame, path: str) -> None:
    """Add rows to a table. Part files get unique names, so nothing is overwritten."""
    df.write.mode("append").parquet(path)


def shard_name(start: str = "batch_start", end: str = "batch_end"):
    """``batch-{start}-{end}`` with seven digits each."""
    return F.format_string(fixed.SHARD_FORMAT, F.col(start), F.col(end))


def with_shards(
    df: DataFrame,
    batch_size: int = fixed.BATCH_SIZE,
    order_by: str = "record_id",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add the name of the shard each row belongs to."""
    helper = ["position", "batch", "batch_start", "batch_end"]
    numbered = with_batches(df, order_by, batch_size, rows_per_bucket)
    return numbered.withColumn("shard", shard_name()).drop(*helper)


def read_if_there(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The table at a path, or None if there is no such path. Any other error is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def write_shards(
    df: DataFrame,
    root: str,
    batch_size: int = fixed.BATCH_SIZE,
    order_by: str = "record_id",
    rows_per_bucket: int = ROWS_PER_BUCKET,
    only: Column | None = None,
) -> None:
    """Write one ``shard=batch-…`` directory per batch, except those that are there already.

    ``df`` is the whole table: a shard's name comes from the positions of its rows in it, so
    a run that goes on after an interruption writes the shards that are missing and no
    others. ``only``, a condition on the columns of ``df`` and ``shard``, leaves shards for a
    later run. A shard replaces its own directory at most. In a first run rows leave the
    numbering sorted by key within a range of keys, so each task writes the shards of its own
    range, one after the other; a resumed run reads and shuffles the rows of missing shards only.
    ``batch_size`` should grow with the table: every batch is a directory.
    """
    names = T.StructType([T.StructField("shard", T.StringType())])
    there = read_if_there(df.sparkSession, root, names)
    if there is None:
        sharded = with_shards(df, batch_size, order_by, rows_per_bucket).sortWithinPartitions("shard")
    else:
        sharded = _missing_rows(df, there.select("shard").distinct(), batch_size, order_by, rows_per_bucket)
    if only is not None:
        sharded = sharded.where(only)
    writer = sharded.write.partitionBy("shard")
    writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(root)


#: Ranges of keys that a resumed run reads, as a condition of its scan.
MAX_RANGES = 64


def _missing_rows(
    df: DataFrame, there: DataFrame, batch_size: int, order_by: str, rows_per_bucket: int
) -> DataFrame:
    """The rows of the shards that are not there, with ``shard``, one task per shard.

    Keys alone are numbered. Missing shards that follow one another make one range of keys, and
    neighbouring ranges are joined until ``MAX_RANGES`` are left; only rows in these ranges are
    read and meet the keys that are missing.
    """
    keys = with_batches(df.select(order_by), order_by, batch_size, rows_per_bucket)
    keys = keys.select(F.col(order_by).alias("_key"), "batch", shard_name().alias("shard"))
    missing = stored(keys.join(there, "shard", "left_anti"), "missing")
    # One row per missing shard: as many as the run is going to write directories.
    per_shard = missing.groupBy("batch").agg(
        F.min("_key").alias("low"), F.max("_key").alias("high"), F.count_if(F.col("_key").isNull()).alias("nulls")
    )
    island = F.col("batch") - F.row_number().over(Window.orderBy("batch"))
    islands = per_shard.withColumn("island", island).groupBy("island").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("nulls").alias("nulls")
    )
    ranges = islands.withColumn("range", F.ntile(MAX_RANGES).over(Window.orderBy("island"))).groupBy("range").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("nulls").alias("nulls")
    ).collect()
    key = F.col(order_by)
    inside = [key.between(F.lit(r["low"]), F.lit(r["high"])) for r in ranges if r["low"] is not None]
    inside += [key.isNull()] if any(r["nulls"] for r in ranges) else []
    rows = df.where(reduce(Column.__or__, inside, F.lit(False)))
    found = rows.join(missing.select("_key", "shard"), F.col(order_by).eqNullSafe(F.col("_key")))
    return found.select(*df.columns, "shard").repartition("shard")


def read_shards(
    spark: SparkSession, root: str, schema: T.StructType, prefix: str = fixed.SHARD_PREFIX
) -> DataFrame:
    """The shards whose name starts with ``prefix``; other directories are pruned, not read."""
    with_shard = T.StructType([*schema.fields, T.StructField("shard", T.StringType())])
    return spark.read.schema(with_shard).parquet(root).where(F.col("shard").startswith(prefix))


def one_per_key(df: DataFrame, key: str, *order) -> DataFrame:
    """The first row of every key. Each map task keeps one row per key before the shuffle."""
    ranked = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def merged(done: DataFrame, new: DataFrame, key: str = "record_id") -> DataFrame:
    """Finished rows and new rows, one row per key; the new row wins.

    Finished rows whose key is not new and is not there twice pass as they are: only keys are
    grouped to find those that are, and a bitmap of them tells the rows that meet the new ones.
    """
    twice = done.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(key)
    touched = stored(new.select(key).unionByName(twice).distinct(), "touched")
    maybe, unchanged = split_by_keys(done, touched, key)
    both = maybe.withColumn("_old", F.lit(1)).unionByName(
        new.withColumn("_old", F.lit(0)), allowMissingColumns=True
    )
    rest = [F.xxhash64(*[c for c in both.columns if c != "_old"])]
    changed = one_per_key(both, key, F.col("_old"), *rest).drop("_old")
    return unchanged.unionByName(changed, allowMissingColumns=True)


def consolidate(done: DataFrame, new: DataFrame, path: str, key: str = "record_id") -> DataFrame:
    """Write finished and new rows as one table in a new directory, and read it back."""
    table = merged(done, new, key)
    table.write.mode("errorifexists").parquet(path)
    return read_dataset(table.sparkSession, path, table.schema)
