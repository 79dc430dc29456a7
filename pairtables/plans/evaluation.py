"""Evaluation: from predictions to per-source metrics, the gate and the comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pairtables import fixed_values as fixed
from pairtables.operators.judge import judge_scores
from pairtables.operators.lexical import lexical_scores
from pairtables.operators.metric_state import add_increment, means_of_state, metric_state, read_state
from pairtables.operators.report import check_thresholds, compare_sources, metric_means

LEXICAL = ("rouge1", "rouge2", "rougeL", "token_count")
_COLUMNS = {name: name for name in LEXICAL} | {f"{m}/v1/mean": m for m in fixed.JUDGE_METRICS}
METRIC_NAMES = [*LEXICAL, "bleu", *[f"{m}/v1/mean" for m in fixed.JUDGE_METRICS]]


def score_rows(rows: DataFrame, responses: DataFrame, key: str = "record_id") -> DataFrame:
    """Every score of every row. Lexical scores need no shuffle; judge scores are joined by key."""
    return judge_scores(lexical_scores(rows), responses, key)


def metrics_of(scored: DataFrame, by: list[str]) -> DataFrame:
    """Means of all row scores, and corpus BLEU, as one long table from one aggregation."""
    return metric_means(scored, _COLUMNS, by, bleu=True)


def add_scores(scored: DataFrame, path: str, increment: str, by: str = "source") -> DataFrame:
    """Add the scores of new rows to the sums below ``path``; metrics of all rows added so far.

    Old rows are not read. An increment added again takes the place of itself.
    """
    add_increment(metric_state(scored, _COLUMNS, [by], bleu=True), path, increment)
    return means_of_state(read_state(scored.sparkSession, path, [scored.schema[by]]), [by])


def evaluate(
    rows: DataFrame, responses: DataFrame, path: str | None = None, by: str = "source"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Metrics, gate and comparison of all sources in one job.

    With ``path`` the scored rows are written there first and read back, so that the scores
    are computed once however many reports are made of them.
    """
    scored = score_rows(rows, responses)
    if path:
        scored.write.mode("errorifexists").parquet(path)
        scored = rows.sparkSession.read.schema(scored.schema).parquet(path)
    metrics = metrics_of(scored, [by])
    return metrics, check_thresholds(metrics, by=by), compare_sources(metrics, METRIC_NAMES, by)
