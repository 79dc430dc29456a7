"""Stored sums of metrics that new rows are added to, so that a mean never reads old rows again.

A state is a table ``(…by, part, total, n)``: the sum and the number of scored rows of each metric,
and the n-gram totals that corpus BLEU is made of. Two states are merged by adding them up. Counts
are exact in ``total`` up to 2^53.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pairtables.operators.lexical import BLEU_PARTS, bleu_of_sums

_BLEU = "bleu/"


def metric_state(
    df: DataFrame, metrics: dict[str, str], by: list[str] | None = None, bleu: bool = False
) -> DataFrame:
    """The state of some rows: ``metrics`` maps a metric's name to its column, and ``bleu`` adds
    what rows hold in ``bleu_stats``. One aggregation, whose map tasks send one row per group."""
    by = by or []
    sources = [(name, F.col(column)) for name, column in metrics.items()]
    if bleu:
        sources += [(f"{_BLEU}{part}", F.col(f"bleu_stats.{part}")) for part in BLEU_PARTS]
    aggregates, rows = [], []
    for i, (name, value) in enumerate(sources):
        total = F.coalesce(F.sum(value.cast("double")), F.lit(0.0))
        aggregates += [total.alias(f"_t{i}"), F.count(value).alias(f"_n{i}")]
        rows.append(
            F.struct(F.lit(name).alias("part"), F.col(f"_t{i}").alias("total"), F.col(f"_n{i}").alias("n"))
        )
    return df.groupBy(*by).agg(*aggregates).select(*by, F.inline(F.array(*rows)))


def merge_states(state: DataFrame, by: list[str] | None = None) -> DataFrame:
    """States that were put together with ``unionByName``, added up."""
    return state.groupBy(*(by or []), "part").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def means_of_state(state: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Mean and number of rows of every metric as ``(…by, metric, value, n)``, BLEU among them:
    what ``metric_means`` gives for all rows that the state has seen."""
    by, whole = by or [], merge_states(state, by)
    is_bleu = F.col("part").startswith(_BLEU)
    means = whole.where(~is_bleu).select(
        *by, F.col("part").alias("metric"), F.try_divide("total", "n").alias("value"), "n"
    )
    sums = [F.sum(F.when(F.col("part") == f"{_BLEU}{p}", F.col("total"))).alias(f"_{p}") for p in BLEU_PARTS]
    rows = F.sum(F.when(F.col("part") == f"{_BLEU}output_tokens", F.col("n"))).alias("_bleu_n")
    bleu = whole.where(is_bleu).groupBy(*by).agg(*sums, rows).where("_bleu_n is not null")
    return means.unionByName(bleu.select(*by, F.lit("bleu").alias("metric"), bleu_of_sums().alias("value"), F.col("_bleu_n").alias("n")))


def add_increment(state: DataFrame, root: str, increment: str) -> None:
    """Store the state of one increment in a directory of its own. An increment that is added again,
    as by a repeated run, takes the place of itself, so its rows count once."""
    state.coalesce(1).write.mode("overwrite").parquet(f"{root}/increment={increment}")


def read_state(spark: SparkSession, root: str, by: list[T.StructField]) -> DataFrame:
    """All increments below a path, one row per group and part of each; their rows are merged by
    :func:`means_of_state`. They are as many as increments and groups, whatever the rows behind them."""
    fields = [
        *by, T.StructField("part", T.StringType()), T.StructField("total", T.DoubleType()),
        T.StructField("n", T.LongType()), T.StructField("increment", T.StringType()),
    ]
    return spark.read.schema(T.StructType(fields)).parquet(root)
