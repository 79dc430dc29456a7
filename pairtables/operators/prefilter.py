"""Rows that certainly hold none of some keys, told by a bitmap, so that only the others are shuffled."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pairtables.session import stored

#: Bits of one value of ``bitmap_construct_agg``.
BLOCK_BITS = 32_768
HASHES = 3
BITS_PER_KEY = 16
#: The bitmaps go to every executor: 64 MB at most. With more keys than fit, more rows pass as possible.
MAX_BITS = 2**29


def _positions(key: str, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i + 1), key), F.lit(min(bits, BLOCK_BITS))) for i in range(HASHES)]


def _is_set(bitmap: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.getbit(byte.cast("int"), position.cast("int") % 8) == 1


def split_by_keys(
    rows: DataFrame, keys: DataFrame, key: str, bits_per_key: int = BITS_PER_KEY, max_bits: int = MAX_BITS
) -> tuple[DataFrame, DataFrame]:
    """The rows that may hold one of ``keys``, and those that certainly do not.

    Every key sets three bits of its block; bitmaps are built by the map tasks and merged, and
    ``rows`` is not shuffled. A row whose bits are all set may hold a key, and one that holds a
    key always is among these. Rows with a null key are too.
    """
    keys = keys.select(key).where(F.col(key).isNotNull())
    bits = max(1, min(max_bits, keys.count() * bits_per_key))
    block = F.pmod(F.xxhash64(key), F.lit(math.ceil(bits / BLOCK_BITS))).alias("_block")
    cells = keys.select(block, F.explode(F.array(*_positions(key, bits))).alias("_cell"))
    bitmaps = stored(cells.groupBy("_block").agg(F.bitmap_construct_agg("_cell").alias("_bits")), "bitmaps")
    # One row of 4 KB for each BLOCK_BITS of the bits, so max_bits bounds what is broadcast.
    own = "_"  # a prefix that no column of the caller has
    while any(c.startswith(own) for c in rows.columns):
        own += "_"
    bitmaps = bitmaps.select(F.col("_block").alias(f"{own}block"), F.col("_bits").alias(f"{own}bits"))
    asked = rows.withColumn(f"{own}block", block).join(F.broadcast(bitmaps), f"{own}block", "left")
    bitmap = F.col(f"{own}bits")
    hit = reduce(Column.__and__, [_is_set(bitmap, p) for p in _positions(key, bits)])
    maybe = F.col(key).isNull() | (bitmap.isNotNull() & F.coalesce(hit, F.lit(False)))
    asked = asked.withColumn(f"{own}maybe", maybe)
    is_maybe = F.col(f"{own}maybe")
    return asked.where(is_maybe).select(*rows.columns), asked.where(~is_maybe).select(*rows.columns)


def filtered_anti_join(
    rows: DataFrame, keys: DataFrame, key: str, bits_per_key: int = BITS_PER_KEY, max_bits: int = MAX_BITS
) -> DataFrame:
    """The rows whose key is not among ``keys``, as a left anti join gives them; rows that the bitmap
    clears are not shuffled. For few remaining rows and many keys, as when most work is done anew."""
    maybe, clear = split_by_keys(rows, keys, key, bits_per_key, max_bits)
    return clear.unionByName(maybe.join(keys.select(key), key, "left_anti"))
