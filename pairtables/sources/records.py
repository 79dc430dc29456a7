"""Validation of structured responses: JSON text in, typed records and rejects out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_TEXT_FIELDS = ("model", "topic", "instruction")
_NUMBER_KINDS = "^(BIGINT|DOUBLE|FLOAT|DECIMAL|STRING|BOOLEAN)"
# Fields stay untyped in the parse, so that a number in place of a text can be told apart.
_SHAPE = "records array<struct<model variant, topic variant, instruction variant, temperature variant>>"
_NO_LIST = "no list of records"


def _is_kind(value: Column, pattern: str) -> Column:
    return F.coalesce(F.schema_of_variant(value).rlike(pattern), F.lit(False))


def _problem(item: Column) -> Column:
    """Why a record is not valid, or null."""
    checks = F.when(item.isNull(), "not an object")
    for name in _TEXT_FIELDS:
        checks = checks.when(~_is_kind(item[name], "^STRING$"), f"{name} is not text")
    number = F.try_variant_get(item["temperature"], "$", "double")
    readable = number.isNotNull() & _is_kind(item["temperature"], _NUMBER_KINDS)
    return checks.when(~readable, "temperature is not a number")


def _entry(pos: Column, reason: Column, rejected: Column, item: Column | None = None) -> Column:
    def field(name: str, kind: str) -> Column:
        value = F.lit(None) if item is None else F.when(reason.isNull(), F.try_variant_get(item[name], "$", kind))
        return value.cast(kind).alias(name)

    return F.struct(
        pos.cast("int").alias("pos"),
        reason.cast("string").alias("reason"),
        rejected.cast("string").alias("rejected"),
        *[field(name, "string") for name in _TEXT_FIELDS],
        field("temperature", "double"),
    )


def validate_records(df: DataFrame, json_col: str, whole_response: bool = True) -> DataFrame:
    """Records and rejects of responses ``{"records": [...]}`` as one table.

    A record needs three texts and a number; its row has ``pos`` and its fields. With
    ``whole_response`` one bad record rejects its response, as a validated response object
    does; otherwise only that record. The row of a reject has ``reason`` and, as ``rejected``,
    the response (or the record).

    Every response is parsed once. What becomes of it is decided inside the row, as a list
    of entries that is then laid out in rows. Where both :func:`valid_records` and
    :func:`rejects` are wanted, write this table once and filter what was written.
    """
    kept = [c for c in df.columns if c != json_col]
    items = F.from_json(json_col, _SHAPE)["records"]
    parsed = df.withColumn("_items", items)
    checked = parsed.withColumn("_problems", F.transform("_items", _problem))
    first = F.try_element_at(F.array_compact("_problems"), F.lit(1))
    nowhere, whole = F.lit(None), F.col(json_col)
    per_record = F.transform(
        F.arrays_zip(F.col("_items").alias("item"), F.col("_problems").alias("problem")),
        lambda z, i: _entry(
            i, z["problem"], F.when(z["problem"].isNotNull(), F.to_json(z["item"])), z["item"]
        ),
    )
    entries = F.when(F.col("_items").isNull(), F.array(_entry(nowhere, F.lit(_NO_LIST), whole)))
    if whole_response:
        entries = entries.when(first.isNotNull(), F.array(_entry(nowhere, first, whole)))
    return checked.select(*kept, F.inline(entries.otherwise(per_record)))


def valid_records(rows: DataFrame) -> DataFrame:
    """The typed records of :func:`validate_records`."""
    return rows.where(F.col("reason").isNull()).drop("reason", "rejected")


def rejects(rows: DataFrame) -> DataFrame:
    """The rejects of :func:`validate_records`."""
    return rows.where(F.col("reason").isNotNull()).drop(*_TEXT_FIELDS, "temperature")
