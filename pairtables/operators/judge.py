"""Judge prompts, parsing of judge responses, and scores per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pairtables import fixed_values as fixed
from pairtables.functions.text import prompt_text
from pairtables.operators.pairs import single_value


def found_score(col: Column) -> Column:
    """The first digit from 1 to 5, or null."""
    return F.regexp_extract(col, fixed.SCORE_PATTERN, 0).try_cast("double")


def parse_score(col: Column) -> Column:
    """The first digit from 1 to 5 as a number, else 3.0."""
    return F.coalesce(found_score(col), F.lit(fixed.DEFAULT_SCORE))


def judge_prompts(df: DataFrame, key: str = "record_id") -> DataFrame:
    """One request per row and judge metric, for :func:`pairtables.operators.infer.batch_infer`."""
    requests = F.array(
        *[
            F.struct(F.lit(metric).alias("metric"), prompt_text(metric).alias("prompt"))
            for metric in fixed.JUDGE_METRICS
        ]
    )
    return df.select(key, F.inline(requests))


def judge_scores(
    df: DataFrame, responses: DataFrame, key: str = "record_id", metrics=fixed.JUDGE_METRICS,
    order: str | None = None,
) -> DataFrame:
    """Add a score per metric from responses ``(key, metric, response)``.

    A missing, failed or unreadable response scores 3.0, and ``defaulted`` counts how many
    of a row's scores came about that way. A judge's answers to one key must be one, or be
    ordered by the column ``order``; the last counts.
    """
    wide = responses.groupBy(key).agg(
        *[
            single_value(found_score(F.col("response")), F.col("metric") == m, order, "answer of a judge")
            .alias(f"_{m}")
            for m in metrics
        ]
    )
    joined = df.join(wide, key, "left")
    scores = {m: F.coalesce(F.col(f"_{m}"), F.lit(fixed.DEFAULT_SCORE)) for m in metrics}
    defaulted = sum((F.col(f"_{m}").isNull().cast("int") for m in metrics), F.lit(0))
    return joined.withColumns({**scores, "defaulted": defaulted}).select(
        *df.columns, *metrics, "defaulted"
    )
