"""A seeded split that depends on each row's key alone."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from pairtables import fixed_values as fixed

_DIGITS_PER_PASS = 4


def split_hash(key: str, seed: int = fixed.SPLIT_SEED) -> Column:
    """32 hex digits that order the rows at random, the same in every run."""
    return F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f":{seed}")))


def _smallest(df: DataFrame, key: str, seed: int, wanted: int) -> Column:
    """Predicate for the rows with the ``wanted`` smallest hashes.

    Each pass counts rows by four more digits, inside the one prefix the cut falls into, so
    the driver sees at most 16^4 counts and no rows. Rows with equal keys stay together.
    """
    hashes = df.select(split_hash(key, seed).alias("h"))
    prefix, missing = "", wanted
    while len(prefix) < 32:
        length = len(prefix) + _DIGITS_PER_PASS
        counts = (
            hashes.where(F.col("h").startswith(prefix))
            .groupBy(F.substring("h", 1, length).alias("p"))
            .count()
            .collect()
        )
        for row in sorted(counts):
            prefix = row["p"]
            if row["count"] >= missing:
                break
            missing -= row["count"]
        if row["count"] == missing:
            break
    return F.substring(split_hash(key, seed), 1, len(prefix)) <= prefix


def is_test_row(
    df: DataFrame,
    key: str = "record_id",
    test_size: float = fixed.TEST_SIZE,
    seed: int = fixed.SPLIT_SEED,
    exact: bool = False,
) -> Column:
    """Predicate of the test side.

    By default a row's side never changes when rows are added or moved. ``exact`` makes the
    test side ``ceil(test_size * n)`` rows for a unique key, by counting first.
    """
    if exact:
        n = df.count()
        wanted = math.ceil(test_size * n)
        return _smallest(df, key, seed, wanted) if wanted else F.lit(False)
    limit = math.floor(test_size * 16**8)
    if limit >= 16**8:
        return F.lit(True)
    return F.substring(split_hash(key, seed), 1, 8) < f"{limit:08x}"


def train_test_split(
    df: DataFrame,
    key: str = "record_id",
    test_size: float = fixed.TEST_SIZE,
    seed: int = fixed.SPLIT_SEED,
    exact: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The training side and the test side; the test side has the small hashes."""
    test = is_test_row(df, key, test_size, seed, exact)
    return df.where(~test), df.where(test)
