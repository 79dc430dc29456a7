"""Answers: fill what is missing, batch by batch, and go on after an interruption."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from pairtables import fixed_values as fixed
from pairtables.functions.text import render_prompt, strip
from pairtables.operators.infer import batch_infer, infer_by_chunk
from pairtables.operators.pairs import (
    PROVIDERS,
    fill_missing,
    pending_outputs,
    pending_rows,
    stamp_settings,
)


def request_answers(
    df: DataFrame,
    models: dict[str, Callable[[list[str]], list[str]]],
    batch_size: int = fixed.BATCH_SIZE,
    key: str = "record_id",
    path: str | None = None,
    **calls,
) -> DataFrame:
    """``(key, provider, response, error)`` for every missing answer, from one function per provider.

    With ``path`` the answers are stored there chunk by chunk, and a second run asks for the rest;
    ``calls`` are options such as ``in_flight``, ``seconds`` and ``tries`` of the calls.
    """
    pending = pending_outputs(df, tuple(models), key)
    answered = []
    for provider, model in models.items():
        asked = render_prompt(pending.where(F.col("provider") == provider), provider)
        keys, options = [key, "provider"], {"batch_size": batch_size, **calls}
        if path is None:
            answered.append(batch_infer(asked, model, keys, **options))
        else:
            answered.append(infer_by_chunk(asked, model, f"{path}/{provider}", keys, **options))
    both = reduce(DataFrame.unionByName, answered)
    return both.withColumn("response", strip(F.col("response")))


def fill_answers(
    df: DataFrame,
    models: dict[str, Callable[[list[str]], list[str]]],
    path: str,
    done: DataFrame | None = None,
    batch_size: int = fixed.BATCH_SIZE,
    key: str = "record_id",
    **calls,
) -> DataFrame:
    """Rows not done yet, with their answers filled in and their settings stamped.

    Answers are stored below ``path`` chunk by chunk before they are joined. A second run with
    the same path, after an interruption or with more rows, asks for what has no answer there.
    """
    rest = df if done is None else pending_rows(df, done, key)
    answers = request_answers(rest, models, batch_size, key, path, **calls)
    return stamp_settings(fill_missing(rest, answers, PROVIDERS, key))
