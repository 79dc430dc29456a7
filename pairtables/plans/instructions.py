"""Instructions: plan the requests that are still needed, and take in their responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pairtables import fixed_values as fixed
from pairtables.functions.text import render_prompt
from pairtables.operators.generation import generation_plan, topic_coverage
from pairtables.operators.pairs import stamp_settings
from pairtables.sources.records import rejects, valid_records, validate_records
from pairtables.sources.tables import one_per_key


def key_of(*columns: str) -> Column:
    """A 128-bit key of some columns; each is written with its length, and null as such."""
    parts = []
    for name in columns:
        text = F.col(name).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.md5(F.concat(*parts))


def planned_requests(
    records: DataFrame,
    targets: DataFrame,
    models: list[str],
    batch_size: int = fixed.BATCH_SIZE,
    planning: int = 1,
) -> DataFrame:
    """Request texts for every topic that is short of its target, with a key of their own.

    ``planning`` counts the times a plan is made, from 1: a later one, for what is still
    missing after the responses to the one before, has keys of its own.
    """
    plan = generation_plan(topic_coverage(records, targets), models, batch_size)
    asked = render_prompt(stamp_settings(plan), "instructions").withColumn("planning", F.lit(int(planning)))
    return asked.withColumn("record_id", key_of("planning", "topic", "round", "model"))


def accepted_records(responses: DataFrame, whole_response: bool = True) -> tuple[DataFrame, DataFrame]:
    """Typed records with a key made of topic and instruction, one row per pair; and rejects.

    Of records with the same pair the one with the first model, then the lowest temperature,
    is taken.
    """
    rows = validate_records(responses, "response", whole_response)
    records = valid_records(rows).select("model", "topic", "instruction", "temperature")
    keyed = records.withColumn("record_id", key_of("topic", "instruction"))
    return one_per_key(keyed, "record_id", "model", "temperature"), rejects(rows)
