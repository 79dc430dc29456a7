"""Shaping, filling and joining instruction-answer rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from pairtables import fixed_values as fixed
from pairtables.functions.text import flatten_text, is_blank
from pairtables.operators.lookup import lookup_join
from pairtables.operators.split import is_test_row

PROVIDERS = ("gpt_output", "gemini_output")


def _require(df: DataFrame, column: str) -> None:
    if column not in df.columns:
        raise ValueError(f"no column {column!r}; the table has {', '.join(df.columns)}")


def select_source(df: DataFrame, source: str, key: str = "record_id") -> DataFrame:
    """Key, instruction and one answer column, which becomes ``output``."""
    _require(df, source)
    return df.select(key, "instruction", F.col(source).alias("output"))


def build_eval_frame(df: DataFrame, source: str, key: str = "record_id", **split) -> DataFrame:
    """The test side as ``inputs`` and ``targets``."""
    _require(df, source)
    target = flatten_text(F.col(source), df.schema[source].dataType)
    return df.where(is_test_row(df, key, **split)).select(
        key, F.col("instruction").alias("inputs"), target.alias("targets")
    )


def build_eval_frames(df: DataFrame, sources: tuple[str, ...] = PROVIDERS, key: str = "record_id", **split) -> DataFrame:
    """The test side of several sources, with their name as ``source``, in one pass over the table."""
    for source in sources:
        _require(df, source)
    sides = F.array(
        *[
            F.struct(F.lit(s).alias("source"), flatten_text(F.col(s), df.schema[s].dataType).alias("targets"))
            for s in sources
        ]
    )
    return df.where(is_test_row(df, key, **split)).select(
        key, F.col("instruction").alias("inputs"), F.inline(sides)
    )


def ordered_turns(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", content: str = "text",
    turns_per_block: int = 10_000,
) -> DataFrame:
    """``conv_id``, ``position`` (from 0, without gaps), ``role``, ``content``: the turns of every
    conversation in order, whatever its length.

    Turns are numbered inside blocks of turn numbers, and a block starts where the blocks
    before it end, so a long conversation is spread over tasks.
    """
    block = F.expr(f"{turn} div {int(turns_per_block)}")
    rows = df.select(conv, turn, F.col(role).alias("role"), F.col(content).alias("content"), block.alias("_block"))
    sizes = rows.groupBy(conv, "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(conv).orderBy("_block")) - F.col("_n")
    starts = sizes.select(conv, "_block", before.alias("_start"))
    inside = F.row_number().over(Window.partitionBy(conv, "_block").orderBy(turn)) - 1
    numbered = rows.withColumn("_row", inside)
    same = [numbered[conv].eqNullSafe(starts[conv]), numbered["_block"].eqNullSafe(starts["_block"])]
    return numbered.join(starts, same).select(
        numbered[conv], (F.col("_start") + F.col("_row")).alias("position"), "role", "content"
    )


def assemble_messages(
    df: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    content: str = "text",
    turns_per_row: int = 10_000,
) -> DataFrame:
    """``messages`` of every conversation, packed from :func:`ordered_turns`.

    A row holds ``turns_per_row`` messages. ``part`` counts the rows of a conversation from 0
    and ``n_parts`` says how many there are: 1 unless it has more turns than that, so a reader
    can tell, and no task has to hold all of a longer one.
    """
    rows = ordered_turns(df, conv, turn, role, content, turns_per_row)
    part = F.floor(F.col("position") / int(turns_per_row)).alias("part")
    message = F.struct("position", "role", "content")
    packed = rows.groupBy(conv, part).agg(F.sort_array(F.collect_list(message)).alias("_ordered"))
    n_parts = (F.max("part").over(Window.partitionBy(conv)) + 1).alias("n_parts")
    messages = F.transform(
        "_ordered", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))
    )
    return packed.select(conv, "part", n_parts, messages.alias("messages"))


def stamp_settings(
    df: DataFrame, temperature: float = fixed.TEMPERATURE, max_tokens: int = fixed.MAX_TOKENS
) -> DataFrame:
    """Set the generation settings on every row, rows without an instruction included."""
    return df.withColumns(
        {"temperature": F.lit(float(temperature)), "max_tokens": F.lit(int(max_tokens))}
    )


def split_blank(df: DataFrame, column: str = "instruction") -> tuple[DataFrame, DataFrame]:
    """Rows with text, and rows that pass through unfilled because the text is blank."""
    blank = is_blank(F.col(column))
    return df.where(~blank), df.where(blank)


def pending_outputs(
    df: DataFrame, providers: tuple[str, ...] = PROVIDERS, key: str = "record_id"
) -> DataFrame:
    """One row per missing answer: key, provider and instruction."""
    wanted = F.array(
        *[F.when(is_blank(F.col(p)), F.lit(p)) for p in providers]
    )
    return (
        df.where(~is_blank(F.col("instruction")))
        .select(key, "instruction", F.explode(F.array_compact(wanted)).alias("provider"))
        .select(key, "provider", "instruction")
    )


def single_value(value: Column, wanted: Column, order: str | None, what: str) -> Column:
    """The one wanted value of a group, or the last by ``order``; without an order a second
    value is an error, as either could be meant."""
    if order is not None:
        return F.max_by(F.when(wanted, value), F.when(wanted, F.col(order)))
    repeated = F.raise_error(F.lit(f"repeated {what}: name a column that orders them"))
    return F.when(F.count_if(wanted) > 1, repeated).otherwise(F.max(F.when(wanted, value)))


def fill_missing(
    df: DataFrame,
    answers: DataFrame,
    providers: tuple[str, ...] = PROVIDERS,
    key: str = "record_id",
    order: str | None = None,
) -> DataFrame:
    """Put answers ``(key, provider, response)`` where one is missing and keep the rest.

    A failed call has no response and leaves the old value. The answers are brought to one
    row per key first, so both sides meet in one shuffle on the unique key. A provider's
    answers to one key must be one, or be ordered by the column ``order``; the last counts.
    """
    wide = answers.groupBy(key).agg(
        *[
            single_value(F.col("response"), F.col("provider") == p, order, "answer").alias(f"_new_{p}")
            for p in providers
        ]
    )
    may_fill = ~is_blank(F.col("instruction"))
    filled = {
        p: F.when(
            may_fill & is_blank(F.col(p)) & F.col(f"_new_{p}").isNotNull(), F.col(f"_new_{p}")
        ).otherwise(F.col(p))
        for p in providers
    }
    return df.join(wide, key, "left").withColumns(filled).select(*df.columns)


def attach_outputs(df: DataFrame, predictions: DataFrame, key: str = "record_id") -> DataFrame:
    """Add ``outputs`` by key; a row without a prediction keeps null."""
    return df.join(predictions.select(key, "outputs"), key, "left")


def pending_rows(df: DataFrame, done: DataFrame, key: str = "record_id") -> DataFrame:
    """Rows whose key is not among the finished ones."""
    return df.join(done.select(key), key, "left_anti")


def concat_all(parts: list[DataFrame], schema: T.StructType | None = None) -> DataFrame:
    """All rows of all parts; columns are matched by name. No part gives an empty table."""
    if not parts:
        return SparkSession.active().createDataFrame([], schema or T.StructType([]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def mark_existing(df: DataFrame, registry: DataFrame, key: str, spread: str, flag: str = "registered") -> DataFrame:
    """Add whether a row's key is registered; a null key is not."""
    known = registry.select(key).where(F.col(key).isNotNull()).distinct().withColumn(flag, F.lit(True))
    joined = lookup_join(df, known, [key], spread)
    return joined.select(*df.columns, F.coalesce(flag, F.lit(False)).alias(flag))


def only_existing(df: DataFrame, registry: DataFrame, key: str, spread: str) -> DataFrame:
    """Rows whose key is registered."""
    return lookup_join(df, registry.select(key).distinct(), [key], spread, "left_semi")


def only_missing(df: DataFrame, registry: DataFrame, key: str, spread: str) -> DataFrame:
    """Rows whose key is not registered."""
    return lookup_join(df, registry.select(key).distinct(), [key], spread, "left_anti")
