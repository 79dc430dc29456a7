"""Completion counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairtables.functions.text import is_empty
from pairtables.operators.pairs import PROVIDERS


def completion(providers: tuple[str, ...] = PROVIDERS):
    """Aggregates: rows, and non-empty answers per provider. White space counts as an answer."""
    done = [F.count_if(~is_empty(F.col(p))).alias(f"{p}_done") for p in providers]
    return [*done, F.count("*").alias("n_rows")]


def batch_progress(
    df: DataFrame, by: str = "batch", providers: tuple[str, ...] = PROVIDERS
) -> DataFrame:
    """Completion of every batch."""
    return df.groupBy(by).agg(*completion(providers))
