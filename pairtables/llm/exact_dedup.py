"""Exact duplicates by a Bloom filter of repeated hashes, built in one pass and asked in a second."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pairtables.llm.common import MAX_FREQUENT, frequency_join, stored
from pairtables.session import shared_path

#: Bits of one block; the block's bitmap is one value of ``bitmap_construct_agg``.
BLOCK_BITS = 32_768
HASHES = 3
#: One filter has at most 64 MB; larger tables take several, each for its share of the hashes.
MAX_FILTER_BITS = 2**29
#: Values of the hash by which rows are dealt to rounds.
DEALS = 2**20


def _positions(key: Column) -> list[Column]:
    """Places of a hash inside its block."""
    return [F.shiftrightunsigned(key, 15 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)) for i in range(HASHES)]


def _bit(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.getbit(byte.cast("int"), position.cast("int") % 8)


def _share(rows: DataFrame, blocks: int) -> tuple[DataFrame, DataFrame]:
    """Rows whose hash is certainly single, and rows whose hash may be repeated.

    First pass: every row sets ``HASHES`` cells of its block, and the cells that were set
    twice make the filter. Second pass: a row all of whose cells were set twice may be
    repeated. A repeated text always is among those.
    """
    placed = rows.withColumn("_block", F.pmod(F.xxhash64(F.lit(1), "_sha"), F.lit(blocks)))
    cells = F.explode(F.array_distinct(F.array(*_positions(F.xxhash64("_sha")))))
    filter_ = (
        placed.select("_block", cells.alias("_cell"))
        .groupBy("_block", "_cell").count().where(F.col("count") > 1)
        .groupBy("_block").agg(F.bitmap_construct_agg("_cell").alias("_bits"))
    )
    # blocks * 4 KB, at most MAX_FILTER_BITS / 8 bytes.
    asked = placed.join(F.broadcast(filter_), "_block", "left")
    hits = [_bit(F.col("_bits"), p) == 1 for p in _positions(F.xxhash64("_sha"))]
    maybe = F.col("_bits").isNotNull() & reduce(Column.__and__, hits)
    kept = [F.coalesce(maybe, F.lit(False)).alias("_maybe"), *rows.columns]
    asked = asked.select(*kept)
    return asked.where(~F.col("_maybe")), asked.where("_maybe")


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bits_per_row: int = 24,
    max_filter_bits: int = MAX_FILTER_BITS,
    max_frequent: int = MAX_FREQUENT,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical; null counts as empty. Of equal texts the row
    with the largest id stays; a null id is below all others, and of rows that repeat both
    id and text one stays. An empty table gives no rows; other columns are not looked at.

    Texts are hashed once and (id, digest) is stored, the rows of a file sorted by a hash of the
    digest. Where one filter does not hold all rows, each round takes a range of that hash, reads
    the pages of its range and stores its result before the next one starts. Only rows that the filter calls
    possibly repeated are shuffled; groups are pre-aggregated and stored, and the join that gives
    each row its group's values sends the largest groups' values to every executor.
    """
    digests = docs.select(
        F.col(id_col).alias("_id"),
        F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)).alias("_sha"),
        F.monotonically_increasing_id().alias("_row"),
    )
    deal = F.pmod(F.xxhash64(F.lit(2), "_sha"), F.lit(DEALS)).cast("int")
    rows = stored(digests.withColumn("_deal", deal).sortWithinPartitions("_deal"), "digests")
    wanted = max(1, rows.count()) * bits_per_row
    rounds = math.ceil(wanted / max_filter_bits)
    blocks = max(1, math.ceil(min(wanted / rounds, max_filter_bits) / BLOCK_BITS))
    path = shared_path(docs.sparkSession, "result")
    for i in range(rounds):
        low, high = i * DEALS // rounds, (i + 1) * DEALS // rounds
        share = rows if rounds == 1 else rows.where(F.col("_deal").between(low, high - 1))
        single, maybe = _share(share, blocks)
        last = F.max(F.struct(F.col("_id").isNotNull(), "_id", "_row")).alias("_last")
        groups = stored(maybe.groupBy("_sha").agg(F.count(F.lit(1)).alias("_n"), last), "groups")
        grouped = frequency_join(maybe, groups.withColumn("_size", F.col("_n")), ["_sha"], "_n", max_frequent)
        part = _result(single, F.col("_id"), F.lit(1), F.lit(True), id_col).unionByName(
            _result(grouped, F.col("_last._id"), F.col("_size"), F.col("_row") == F.col("_last._row"), id_col)
        )
        if rounds == 1:
            return part
        part.write.mode("append").parquet(path)
    return docs.sparkSession.read.schema(part.schema).parquet(path)


def _result(df: DataFrame, keep: Column, size: Column, kept: Column, id_col: str) -> DataFrame:
    return df.select(
        F.col("_id").alias(id_col),
        keep.alias("keep_id"),
        size.cast("long").alias("group_size"),
        kept.alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def op3_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = """
with t as (select doc_id, sha256(coalesce(text, '')) as text_sha256 from documents),
g as (select text_sha256, max(doc_id) as keep_id, count(*) as group_size from t group by 1)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256
from t join g using (text_sha256)
"""
