"""Column expressions over text. All of them stay inside the JVM."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pairtables import fixed_values as fixed

def strip(col: Column) -> Column:
    """Remove white space at both ends, tabs and line breaks included."""
    return F.btrim(col, F.lit(fixed.WHITE_SPACE))


def is_blank(col: Column) -> Column:
    """True for null, empty and white-space-only text."""
    return is_empty(F.ltrim(col, F.lit(fixed.WHITE_SPACE)))


def is_empty(col: Column) -> Column:
    """True for null and empty text; white space counts as content."""
    return F.coalesce(F.octet_length(col) == 0, F.lit(True))


def tokens(col: Column) -> Column:
    """Lower-cased word tokens."""
    return F.array_remove(F.split(F.lower(col), fixed.TOKEN_GAP), "")


def _variant_is(value: Column, kind: str) -> Column:
    return F.schema_of_variant(value).startswith(kind)


def _variant_scalar(value: Column) -> Column:
    text = F.try_variant_get(value, "$", "string")
    return F.when(_variant_is(value, "BOOLEAN"), F.initcap(text)).otherwise(text)


def _variant_item(value: Column, field: str, missing: Column) -> Column:
    """An object's ``field`` (or ``missing``), any other value as text."""
    found = F.try_variant_get(value, f"$.{field}", "string")
    return F.when(_variant_is(value, "OBJECT"), F.coalesce(found, missing)).otherwise(
        F.coalesce(_variant_scalar(value), F.lit(""))
    )


def _flatten_variant(value: Column) -> Column:
    items = F.try_variant_get(value, "$", "array<variant>")
    joined = F.array_join(
        F.transform(items, lambda item: _variant_item(item, "text", F.lit(""))), " "
    )
    return (
        F.when(F.is_variant_null(value), F.lit(None).cast("string"))
        .when(_variant_is(value, "ARRAY"), joined)
        .when(value.isNotNull(), _variant_item(value, "text", F.lit("")))
    )


def flatten_text(col: Column, dtype: T.DataType) -> Column:
    """An answer cell as one string, chosen by its declared type.

    Text stays as it is, an object gives its ``text`` (or ``''``), a list gives its items'
    text joined by one space, null stays null. A cell of mixed shape is a ``VARIANT``.
    """
    if isinstance(dtype, T.VariantType):
        return _flatten_variant(col)
    if isinstance(dtype, T.StructType):
        return F.when(col.isNotNull(), F.coalesce(_field_text(col, dtype), F.lit("")))
    if isinstance(dtype, T.MapType):
        return F.when(col.isNotNull(), F.coalesce(_map_text(col), F.lit("")))
    if isinstance(dtype, T.ArrayType):
        return F.array_join(
            F.transform(col, lambda item: F.coalesce(_item_text(item, dtype.elementType), F.lit(""))),
            " ",
        )
    return col.cast("string")


def _field_text(col: Column, dtype: T.StructType) -> Column:
    return col["text"].cast("string") if "text" in dtype.fieldNames() else F.lit("")


def _map_text(col: Column) -> Column:
    return F.try_element_at(col, F.lit("text")).cast("string")


def _item_text(item: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.VariantType):
        return _variant_item(item, "text", F.lit(""))
    if isinstance(dtype, T.MapType):
        return _map_text(item)
    return _field_text(item, dtype) if isinstance(dtype, T.StructType) else item.cast("string")


def flatten_json(col: Column) -> Column:
    """``flatten_text`` for cells that hold JSON text; text that is not JSON gives null."""
    return _flatten_variant(F.try_parse_json(col))


def normalize_content(col: Column, dtype: T.DataType) -> Column:
    """A provider's content as one stripped string."""
    return strip(flatten_text(col, dtype))


def normalize_prediction(col: Column) -> Column:
    """The predictions in one JSON response, as an array of strings.

    An object gives its ``predictions``, else its ``outputs``, else nothing; a list is taken
    as it is. An item that is an object gives its ``generated_text``, else its JSON text.
    """
    value = F.try_parse_json(col)
    listed = F.when(
        _variant_is(value, "OBJECT"),
        F.coalesce(
            F.try_variant_get(value, "$.predictions", "array<variant>"),
            F.try_variant_get(value, "$.outputs", "array<variant>"),
            F.array().cast("array<variant>"),
        ),
    ).otherwise(F.try_variant_get(value, "$", "array<variant>"))
    return F.transform(
        listed, lambda item: _variant_item(item, "generated_text", F.to_json(item))
    )


@dataclass(frozen=True)
class ChatTemplate:
    """Text placed around the role and the content of every message, and after the last one."""

    before_role: str = "<|im_start|>"
    after_role: str = "\n"
    after_content: str = "<|im_end|>\n"
    tail: str = ""


def render_messages(messages: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """An array of ``{role, content}`` as one text; null if a message has no role or content."""
    rendered = F.transform(
        messages,
        lambda m: F.concat(
            F.lit(template.before_role),
            m["role"],
            F.lit(template.after_role),
            m["content"],
            F.lit(template.after_content),
        ),
    )
    whole = ~F.exists(rendered, lambda text: text.isNull())
    return F.when(whole, F.concat(F.array_join(rendered, ""), F.lit(template.tail)))


def chat_format(
    df: DataFrame,
    template: ChatTemplate = ChatTemplate(),
    instruction: str = "instruction",
    output: str = "output",
) -> DataFrame:
    """Add ``text``: the instruction as the user's message, then the answer as the assistant's."""
    messages = F.array(
        F.struct(F.lit("user").alias("role"), F.col(instruction).alias("content")),
        F.struct(F.lit("assistant").alias("role"), F.col(output).alias("content")),
    )
    return df.withColumn("text", render_messages(messages, template))


def preview(col: Column, n: int, always: bool = False) -> Column:
    """The first ``n`` characters; ``...`` follows if text was cut off, or always."""
    cut = F.concat(F.substring(col, 1, n), F.lit("..."))
    return cut if always else F.when(F.length(col) > n, cut).otherwise(col)


def model_slug(
    col: Column, suffix: Column | None = None, catalog: str | None = None, schema: str | None = None
) -> Column:
    """A model's registered name: ``/`` and ``-`` become ``_``, dots go, suffix and prefix are added."""
    slug = F.translate(col, "/-.", "__")
    if suffix is not None:
        slug = F.concat_ws("_", slug, suffix)
    return slug if catalog is None else F.concat_ws(".", F.lit(catalog), F.lit(schema), slug)


def model_uri(name: Column, alias: str | None = None) -> Column:
    """The address of a registered model: under an alias, else its latest version."""
    return F.concat(F.lit("models:/"), name, F.lit(f"@{alias}" if alias else "/latest"))


def endpoint_name(model: Column, version: Column) -> Column:
    """The name under which a model version is served, before it is made a slug."""
    return F.concat(F.translate(model, ".-,", "__"), F.lit("_v"), version.cast("string"))


def endpoint_slug(col: Column) -> Column:
    """Lower case, with ``.``, ``/`` and ``_`` turned into ``-``."""
    return F.translate(F.lower(col), "./_", "---")


def run_name(source: Column, ts: Column) -> Column:
    """``eval_{source}_{yyyyMMdd_HHmmss}``."""
    return F.concat_ws("_", F.lit("eval"), source, F.date_format(ts, "yyyyMMdd_HHmmss"))


def prompt_text(kind: str) -> Column:
    """The request text of one kind; it reads the columns its template names."""
    parts = re.split(r"\{(\w+)\}", fixed.PROMPTS[kind])
    return F.concat(
        *[
            F.col(part).cast("string") if i % 2 else F.lit(part)
            for i, part in enumerate(parts)
            if part
        ]
    )


def render_prompt(df: DataFrame, kind: str, name: str = "prompt") -> DataFrame:
    """Add the request text of one kind as a column."""
    return df.withColumn(name, prompt_text(kind))
