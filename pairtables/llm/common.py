"""Helpers of the corpus operators: stored tables, words, row keys, bounded lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pairtables.session import shared_path

#: A word is a run of anything but space and the five ASCII control characters of white space.
WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: it survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def words(text: Column) -> Column:
    """The words of a text, in order; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def text_key(text: Column) -> list[Column]:
    """128 bits that stand for a text; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text), F.xxhash64(F.lit(1), text)]


def in_fold(id_col: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id's text falls into a fold; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def sample_by_hash(ids: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` rows, those whose id has the smallest hash: the same at every run."""
    return ids.orderBy(F.xxhash64("_id"), "_id").limit(rows)


#: Rows of a table that go to every executor in :func:`frequency_join`; some 100 bytes each.
MAX_FREQUENT = 300_000


def frequency_join(
    rows: DataFrame, table: DataFrame, on: list[str], count: str, max_frequent: int = MAX_FREQUENT
) -> DataFrame:
    """``rows`` joined (inner) with a stored ``table`` that has each key once and, as ``count``, how
    often the key occurs in ``rows``; the count is not in the result.

    The most frequent keys, at most ``max_frequent``, are broadcast, so a key that a third of all
    rows hold is not gathered anywhere. Any other key occurs less often than the least of these,
    and is joined by a shuffle of the rows that met no frequent key.
    """
    level = F.floor(F.log2(count)).cast("int")
    sizes = dict(table.groupBy(level.alias("_level")).count().collect())  # at most 64 rows
    least, taken = max(sizes, default=0) + 1, 0
    while least > 0 and taken + sizes.get(least - 1, 0) <= max_frequent:
        least -= 1
        taken += sizes.get(least, 0)
    frequent = F.broadcast(table.where(F.col(count) >= 2**least).drop(count).withColumn("_met", F.lit(True)))
    found = rows.join(frequent, on, "left" if least else "inner")
    if not least:
        return found.drop("_met")
    rest = table.where(F.col(count) < 2**least).drop(count)
    missed = found.where(F.col("_met").isNull()).select(*rows.columns)
    return found.where("_met").drop("_met").unionByName(missed.join(rest, on))
