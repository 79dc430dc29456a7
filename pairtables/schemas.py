"""Declared schemas; no read in this package infers one."""

from __future__ import annotations

from pyspark.sql import types as T

INSTRUCTION_RECORD = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("instruction", T.StringType()),
        T.StructField("temperature", T.DoubleType()),
    ]
)

DUAL_SOURCE = T.StructType(
    [
        T.StructField("record_id", T.LongType()),
        T.StructField("instruction", T.StringType()),
        T.StructField("gpt_output", T.StringType()),
        T.StructField("gemini_output", T.StringType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("max_tokens", T.IntegerType()),
    ]
)

CONVERSATIONS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

LABELS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("quality", T.IntegerType()),
        T.StructField("toxic", T.IntegerType()),
    ]
)

METRICS = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("n", T.LongType()),
    ]
)
