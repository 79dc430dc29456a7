"""Consolidation in place: only the shards that hold changed keys are written again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pairtables import fixed_values as fixed
from pairtables.operators.position import ROWS_PER_BUCKET, with_batches
from pairtables.operators.prefilter import split_by_keys
from pairtables.session import stored
from pairtables.sources.shard_index import FOLDER
from pairtables.sources.tables import one_per_key, read_if_there, read_shards, shard_name, write_shards


def consolidate_shards(
    new: DataFrame,
    root: str,
    schema: T.StructType,
    key: str = "record_id",
    batch_size: int = fixed.BATCH_SIZE,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Put new rows into the shards below ``root``, and read all of them back, one row per key.

    The rows are those that ``consolidate`` gives: a new row takes the place of the old one, and of
    keys that the shards hold twice one row is left, in the first of their shards. A new row of a
    key that is there goes to the shard of that key; the others make new shards, numbered after the
    last. All other shards keep their files. Null keys are one key. Only the keys of the table are
    read, by one grouping and one pass over a bitmap, and the rows of the shards that change.
    A run that was interrupted may be run again: shards it has written hold its rows by then.
    """
    spark, names = new.sparkSession, T.StructType([T.StructField("shard", T.StringType())])
    fields = [f for f in new.schema.fields if f.name not in schema.names]
    schema = T.StructType([*schema.fields, *fields])
    if read_if_there(spark, root, names) is None:
        hashed = one_per_key(new, key, F.xxhash64(*new.columns))
        write_shards(hashed, root, batch_size, key, rows_per_bucket)
        return read_shards(spark, root, schema).drop("shard")
    keys = read_shards(spark, root, T.StructType([schema[key]])).select(key, "shard")
    twice = keys.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(key)
    twice = stored(twice, "twice")
    changed = stored(new.select(key).unionByName(twice).distinct(), "changed")
    maybe, _ = split_by_keys(keys, changed, key)
    asked = changed.withColumnRenamed(key, "_key")
    held = maybe.join(asked, F.col(key).eqNullSafe(F.col("_key"))).select("_key", "shard")
    held = stored(held.distinct(), "held")
    # As many names as there are directories to write.
    touched = [r["shard"] for r in held.select("shard").distinct().collect()]
    old = read_shards(spark, root, schema).where(F.col("shard").isin(touched))
    maybe, same = split_by_keys(old, changed, key)
    both = maybe.drop("shard").withColumn("_old", F.lit(1)).unionByName(
        new.withColumn("_old", F.lit(0)), allowMissingColumns=True
    )
    picked = one_per_key(both, key, F.col("_old"), F.xxhash64(*schema.names)).drop("_old")
    # A key that the bitmap let pass by chance is in one shard only, like any other unchanged one.
    home = maybe.select(F.col(key).alias("_key"), "shard").groupBy("_key").agg(F.min("shard").alias("shard"))
    placed = stored(picked.join(home, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key"), "placed")
    last = F.max(F.regexp_extract("shard", r"-(\d+)$", 1).try_cast("long"))
    end = keys.agg(F.greatest(F.count(F.lit(1)), last)).first()[0] or 0
    more = with_batches(placed.where("shard is null").drop("shard"), key, batch_size, rows_per_bucket)
    for bound in ("batch_start", "batch_end"):
        more = more.withColumn(bound, F.col(bound) + F.lit(end))
    columns = [*schema.names, "shard"]
    rows = same.select(*columns).unionByName(placed.where("shard is not null").select(*columns))
    rows = rows.unionByName(more.withColumn("shard", shard_name()).select(*columns))
    # Written beside the table first: the shards that it replaces are read until then.
    rows = stored(rows.repartition("shard"), "rows")
    writer = rows.write.partitionBy("shard").mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(root)
    if not twice.isEmpty():
        _drop_emptied(spark, root, touched, rows)
    return read_shards(spark, root, schema).drop("shard")


def _drop_emptied(spark: SparkSession, root: str, touched: list[str], rows: DataFrame) -> None:
    """Remove shards whose rows are all in other shards now, and the index, which counts them."""
    left = {r["shard"] for r in rows.select("shard").distinct().collect()}
    gone = [f"shard={name}" for name in touched if name not in left]
    for name in [*gone, FOLDER]:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
