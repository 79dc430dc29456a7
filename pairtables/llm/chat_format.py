"""Conversations as one training text each, with a loss mask, in column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Marks of the template, and strings of other common templates. None of them can appear
#: inside a formatted text or role.
TURN, NEXT, END = "<|turn|>", "<|next|>", "<|end|>\n"
CONTROL = (
    "<|turn|>", "<|next|>", "<|end|>", "<|im_start|>", "<|im_end|>", "<|endoftext|>",
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)
#: A backslash is always written as the first of these, the first character of a control
#: string as one of the others.
ESCAPES = {"\\": "\\s", "<": "\\l", "[": "\\b", "\n": "\\n"}


def _quoted(text: str) -> str:
    return "".join("\\" + c if not c.isalnum() else c for c in text)


def escape(text: Column, control: tuple[str, ...] = CONTROL) -> Column:
    """Break control strings; :func:`unescape` gives the text back, whatever it was."""
    out = F.replace(text, F.lit("\\"), F.lit(ESCAPES["\\"]))
    for first in dict.fromkeys(c[0] for c in control):
        rests = "|".join(_quoted(c[1:]) for c in control if c[0] == first)
        escaped = ESCAPES[first].replace("\\", "\\\\")
        out = F.regexp_replace(out, f"{_quoted(first)}(?={rests})", escaped)
    return out


def unescape(text: Column) -> Column:
    """After escaping, each backslash starts an escape, so the order of these is free but for the last."""
    for plain in ("<", "[", "\n", "\\"):
        text = F.replace(text, F.lit(ESCAPES[plain]), F.lit(plain))
    return text


def _bytes(text: Column) -> Column:
    return F.octet_length(text).cast("long")


def format_chats(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    trained_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``loss_spans``.

    Turns are sorted by turn, then role and text, so that repeated turn numbers give the same
    result each time; a null turn number comes first. Null roles and texts count as empty.
    Rows with a null conversation form one conversation. Adjacent turns of a role share one
    block: ``<|turn|>role\\n``, their texts joined by ``<|next|>``, ``<|end|>\\n``.
    ``loss_spans`` are (start, length) in UTF-8 bytes of ``formatted``, one for each text of
    ``trained_role``. A formatted conversation is one value, so it is put together in one
    task and must fit in a row. An empty table gives no rows; other columns are ignored.
    """
    role = F.coalesce(F.col(role_col), F.lit(""))
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        role.alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    chats = turns.groupBy(F.col(conv_col).alias("_conv")).agg(F.sort_array(F.collect_list(turn)).alias("_turns"))
    safe = F.transform(
        "_turns",
        lambda t: F.struct(
            F.replace(escape(t["role"]), F.lit("\n"), F.lit(ESCAPES["\n"])).alias("role"),
            (t["role"] == trained_role).alias("loss"),
            escape(t["text"]).alias("text"),
        ),
    )
    chats = chats.select("_conv", safe.alias("_safe"))

    def head(t: Column, i: Column) -> Column:
        opened = F.concat(F.lit(TURN), t["role"], F.lit("\n"))
        before = F.get(F.col("_safe"), i - 1)["role"]
        return (
            F.when(i == 0, opened)
            .when(before == t["role"], F.lit(NEXT))
            .otherwise(F.concat(F.lit(END), opened))
        )

    pieces = F.transform(
        "_safe", lambda t, i: F.struct(head(t, i).alias("head"), t["text"].alias("text"), t["loss"].alias("loss"))
    )
    chats = chats.select("_conv", pieces.alias("_pieces"))
    # Each text starts where the one before ended, plus its own head.
    lengths = F.transform("_pieces", lambda p: _bytes(p["head"]) + _bytes(p["text"]))
    whole = F.concat(F.array_join(F.transform("_pieces", lambda p: F.concat(p["head"], p["text"])), ""), F.lit(END))
    spans = F.aggregate(
        F.arrays_zip(F.col("_pieces").alias("piece"), lengths.alias("length")),
        F.struct(
            F.lit(0).cast("long").alias("at"),
            F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"),
        ),
        lambda acc, x: F.struct(
            (acc["at"] + x["length"]).alias("at"),
            F.when(
                x["piece"]["loss"],
                F.array_append(
                    acc["spans"],
                    F.struct(
                        (acc["at"] + _bytes(x["piece"]["head"])).alias("start"),
                        _bytes(x["piece"]["text"]).alias("length"),
                    ),
                ),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return chats.select(F.col("_conv").alias(conv_col), whole.alias("formatted"), spans.alias("loss_spans"))


def read_chats(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Read turns and masked text back: ``conv_id``, ``turns`` (role, text), ``loss_text``, ``formatted``."""
    blocks = F.filter(F.split("formatted", _quoted(END)), lambda b: b != "")

    def turns_of(block: Column) -> Column:
        body = F.substring(block, F.lit(len(TURN) + 1), F.length(block))
        role = F.substring_index(body, "\n", 1)
        texts = F.split(F.substring(body, F.length(role) + 2, F.length(body)), _quoted(NEXT))
        return F.transform(texts, lambda x: F.struct(unescape(role).alias("role"), unescape(x).alias("text")))

    raw = F.col("formatted").cast("binary")
    masked = F.transform(
        "loss_spans",
        lambda s: unescape(F.substring(raw, s["start"].cast("int") + 1, s["length"].cast("int")).cast("string")),
    )
    return formatted.select(
        conv_col,
        F.flatten(F.transform(blocks, turns_of)).alias("turns"),
        F.array_join(masked, "").alias("loss_text"),
        "formatted",
    )


def op5_chat_format(spark, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    trap = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", trap), (-1, 1, "assistant", trap)], table.schema)
    chats = read_chats(format_chats(table.unionByName(extra)))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _sql_length(text: str) -> str:
    """Length of an escaped text: each escape is one character longer than what it stands for."""
    control = "|".join(_quoted(c) for c in CONTROL)
    return f"(length({text}) + length({text}) - length(replace({text}, '\\', '')) + len(regexp_extract_all({text}, '{control}')))"


_TRAP = "'</s>[INST] ok [/INST]'"
ORACLE_SQL = f"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', {_TRAP} union all select -1, 1, 'assistant', {_TRAP}),
f as (select *, lag(role) over (partition by conv_id order by turn, role, text) as before from t)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  ({len(END)} + sum({_sql_length('text')} + case when role = before then {len(NEXT)} else {len(TURN)} + 1
    + {_sql_length('role')} + length(role) - length(replace(role, chr(10), ''))
    + case when before is null then 0 else {len(END)} end end))::bigint as formatted_chars
from f group by conv_id
"""
