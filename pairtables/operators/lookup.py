"""Joins against a table with one row per key, safe for hot keys and for large lookup tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pairtables.session import stored

#: A lookup table below both bounds is broadcast.
MAX_BROADCAST_ROWS = 50_000
MAX_BROADCAST_BYTES = 16 * 1024 * 1024
#: Rows of a key that one task gets. A hot key has one salt for each of these.
HOT_ROWS = 1_000_000


def null_key(col: str) -> Column:
    """A text key in which null is a key of its own."""
    return F.concat(F.when(F.col(col).isNull(), "0").otherwise("1"), F.coalesce(F.col(col).cast("string"), F.lit("")))


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    spread: str,
    how: str = "left",
    max_rows: int = MAX_BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Join ``right``, which holds each key once, to ``left``.

    ``right`` holds keys and small values. It is computed once, into the shared folder, where
    its rows and bytes are counted: within the bounds it is broadcast and ``left`` is not
    shuffled. Beyond them both sides are shuffled on the key and a salt.
    """
    right = stored(right, "lookup")
    texts = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in right.columns]
    size = right.agg(F.count(F.lit(1)).alias("rows"), F.sum(sum(texts, F.lit(0))).alias("bytes")).first()
    if size["rows"] <= max_rows and (size["bytes"] or 0) <= max_bytes:
        return left.join(F.broadcast(right), on, how)
    return salted_join(left, right, on, spread, how, hot_rows)


def salted_join(
    left: DataFrame, right: DataFrame, on: list[str], spread: str, how: str = "left", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Shuffle join in which a key of ``left`` with more than ``hot_rows`` rows has as many
    salts as it has ``hot_rows``, so that its tasks stay the same size however large it is.

    ``spread`` is a column of ``left`` that differs between the rows of a key. Keys are
    counted inside the job. The table of hot keys has at most one row per ``hot_rows`` rows
    of ``left``, so it is broadcast; only their rows of ``right`` are repeated.
    """
    counts = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max(1, hot_rows))
    hot = counts.select(*on, F.ceil(F.col("_n") / max(1, hot_rows)).cast("int").alias("_salts"))
    # A null key matches nothing, so its rows may go anywhere.
    no_key = sum((F.col(k).isNull().cast("int") for k in on), F.lit(0)) > 0
    salts = F.when(no_key, F.lit(65_536)).otherwise(F.coalesce("_salts", F.lit(1)))
    keyed = left.join(F.broadcast(hot), on, "left").withColumn("_salt", F.pmod(F.xxhash64(spread), salts).cast("int"))
    last = F.coalesce("_salts", F.lit(1)) - 1
    repeated = right.join(F.broadcast(hot), on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), last)))
    return keyed.drop("_salts").join(repeated.drop("_salts"), [*on, "_salt"], how).drop("_salt")
