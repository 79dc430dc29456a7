"""Stable positions, batches and row ranges without a global window.

A position is exact whatever the bucket bounds are: rows are numbered inside key ranges,
and every range starts where the ranges before it end. The bounds only decide how evenly
the work is spread: they are drawn by weight, so that a range holds neither more rows nor more
bytes than it should, however much the rows differ in width.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from pairtables import fixed_values as fixed

ROWS_PER_BUCKET = 1_000_000
#: Bytes of rows that one task sorts, as far as single rows allow.
BYTES_PER_BUCKET = 256 * 1024 * 1024
MAX_BUCKETS = 16_384
_FAN_OUT = 128
_SAMPLES_PER_BUCKET = 16


def _row_bytes(df: DataFrame) -> Column:
    """What a row takes: eight bytes per plain value, the length of texts, nested values as JSON."""
    size = F.lit(0).cast("long")
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            value = F.to_json(value)
        elif not isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size += 8
            continue
        size += F.coalesce(F.octet_length(value), F.lit(0))
    return size


def _bounds(weighted: DataFrame, key: str, total: int, buckets: int) -> list:
    """At most ``buckets - 1`` ascending values that cut the keys into ranges of similar weight.

    A row stands for as many points of a sample as it has units of weight; the rest of a unit is
    drawn by its hash. The sample has some 16 rows per range, is cut in one task, and only the
    bounds themselves reach the driver.
    """
    unit = max(1, total // (buckets * _SAMPLES_PER_BUCKET))
    drawn = (F.pmod(F.xxhash64(key), F.lit(unit)) < F.pmod("_weight", F.lit(unit))).cast("long")
    points = weighted.select(key, (F.floor(F.col("_weight") / unit) + drawn).alias("_points"))
    points = points.where("_points > 0").groupBy(key).agg(F.sum("_points").alias("_points"))
    before = F.sum("_points").over(Window.orderBy(key)) - F.col("_points")
    share = F.floor(before * buckets / F.sum("_points").over(Window.partitionBy()))
    cuts = points.select(key, share.alias("_share")).where("_share > 0").groupBy("_share").agg(F.min(key))
    return sorted(row[1] for row in cuts.collect())


def _bucket(key: Column, bounds: list, dtype: T.DataType) -> Column:
    """Number of bounds that are not above the key, found in two steps of at most 128 compares."""
    if not bounds:
        return F.lit(0)

    def literal(values: list) -> Column:
        return F.array(*[F.lit(v).cast(dtype) for v in values])

    groups = [bounds[i : i + _FAN_OUT] for i in range(0, len(bounds), _FAN_OUT)]
    if len(groups) == 1:
        return F.size(F.filter(literal(bounds), lambda b: b <= key))
    coarse = F.size(F.filter(literal([g[0] for g in groups[1:]]), lambda b: b <= key))
    inner = F.element_at(F.array(*[literal(g) for g in groups]), coarse + 1)
    return coarse * _FAN_OUT + F.size(F.filter(inner, lambda b: b <= key))


def with_positions(
    df: DataFrame,
    order_by: str = "record_id",
    rows_per_bucket: int = ROWS_PER_BUCKET,
    bytes_per_bucket: int = BYTES_PER_BUCKET,
) -> tuple[DataFrame, int]:
    """Add ``position``, counted from 0 in the order of a unique key; also return the row count."""
    # A row weighs its bytes and one part in rows_per_bucket of a range.
    weight = _row_bytes(df) + F.lit(max(1, bytes_per_bucket // rows_per_bucket))
    weighted = df.select(order_by, weight.alias("_weight"))
    n, total = weighted.agg(F.count(F.lit(1)), F.sum("_weight")).first()
    wanted = math.ceil((total or 0) / bytes_per_bucket)
    buckets = min(MAX_BUCKETS, max(1, wanted))
    bounds = _bounds(weighted, order_by, total, buckets) if buckets > 1 else []
    bucket = _bucket(F.col(order_by), bounds, df.schema[order_by].dataType)
    if not bounds:  # one range, so there is nothing to add
        return df.withColumn("position", F.row_number().over(Window.orderBy(order_by)).cast("long") - 1), n
    # The partition id, times zero, keeps the optimizer from moving the lambda of the bucket to the
    # other side of the join below when a caller filters by position, where its key is not known.
    placed, ranges = df.withColumn("_bucket", bucket + F.spark_partition_id() * 0), ["_bucket"]
    parts = math.ceil(wanted / buckets)
    if parts > 1:  # more rows than the ranges are meant for: cut each at some of its own keys
        placed, ranges = _with_parts(placed, order_by, n, buckets, min(parts, _FAN_OUT)), ["_bucket", "_part"]
    sizes = placed.groupBy(*ranges).agg(F.count(F.lit(1)).alias("_n"))
    totals = dict(sizes.groupBy("_bucket").agg(F.sum("_n")).collect())
    starts, total = [], 0
    for b in sorted(totals):
        starts.append((b, total))
        total += totals[b]
    offsets = df.sparkSession.createDataFrame(starts, "_bucket int, _start long")
    if parts > 1:  # at most _FAN_OUT rows for each of MAX_BUCKETS
        before = F.sum("_n").over(Window.partitionBy("_bucket").orderBy("_part")) - F.col("_n")
        offsets = sizes.withColumn("_before", before).join(F.broadcast(offsets), "_bucket").select(
            *ranges, (F.col("_start") + F.col("_before")).alias("_start")
        )
    inside = Window.partitionBy(*ranges).orderBy(order_by)
    numbered = (
        placed.withColumn("_row", F.row_number().over(inside))
        .join(F.broadcast(offsets), ranges, "left")
        .withColumn("position", F.col("_start") + F.col("_row") - 1)
        .drop(*ranges, "_row", "_start")
    )
    return numbered, n


def _with_parts(placed: DataFrame, key: str, n: int, buckets: int, parts: int) -> DataFrame:
    """Add ``_part``: the number of the range's own cuts, at most ``parts - 1``, that are not above the key."""
    step = max(1, n // (buckets * parts * _SAMPLES_PER_BUCKET))
    picked = placed.where(F.pmod(F.xxhash64(key, F.lit(1)), F.lit(step)) == 0).select("_bucket", key).distinct()
    picked = picked.groupBy("_bucket").agg(F.sort_array(F.collect_list(key)).alias("_keys"))
    at = F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(parts - 1)), lambda i: F.floor(F.size("_keys") * i / parts)))
    cuts = picked.select("_bucket", F.transform(at, lambda i: F.get("_keys", i.cast("int"))).alias("_cuts"))
    joined = placed.join(F.broadcast(cuts), "_bucket", "left")
    part = F.size(F.filter(F.coalesce("_cuts", F.array().cast(cuts.schema["_cuts"].dataType)), lambda c: c <= F.col(key)))
    return joined.withColumn("_part", part).drop("_cuts")


def with_batches(
    df: DataFrame,
    order_by: str = "record_id",
    batch_size: int = fixed.BATCH_SIZE,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add ``position``, ``batch`` and the batch's ``batch_start`` and ``batch_end`` (exclusive)."""
    numbered, n = with_positions(df, order_by, rows_per_bucket)
    return (
        numbered.withColumn("batch", F.expr(f"position div {int(batch_size)}"))
        .withColumn("batch_start", F.col("batch") * batch_size)
        .withColumn("batch_end", F.least(F.col("batch_start") + batch_size, F.lit(n)))
    )


def slice_rows(
    df: DataFrame,
    start: int,
    end: int,
    order_by: str = "record_id",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """The rows at positions ``start`` to ``end`` (exclusive).

    Only keys are numbered to find the first and the last one; then the rows between these two
    are read, a condition that reaches the scan, and no other row is shuffled.
    """
    keys, _ = with_positions(df.select(order_by), order_by, rows_per_bucket)
    first, low, high, nulls = keys.where(F.col("position").between(start, end - 1)).agg(
        F.min("position"), F.min(order_by), F.max(order_by), F.count_if(F.col(order_by).isNull())
    ).first()
    if first is None:
        return df.where("false").withColumn("position", F.lit(0).cast("long"))
    inside = F.col(order_by).isNull() if nulls else F.lit(False)
    if low is not None:
        inside |= F.col(order_by).between(F.lit(low), F.lit(high))
    part, _ = with_positions(df.where(inside), order_by, rows_per_bucket)
    return part.withColumn("position", F.col("position") + first)
