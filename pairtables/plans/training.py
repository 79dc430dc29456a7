"""Training rows: chat text, fixed-length encoding and the split."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairtables import fixed_values as fixed
from pairtables.functions.text import ChatTemplate, chat_format, flatten_text
from pairtables.operators.encode import build_vocab, encode
from pairtables.operators.pairs import select_source
from pairtables.operators.split import train_test_split
from pairtables.operators.subwords import encode_subwords


def training_text(
    df: DataFrame, source: str, template: ChatTemplate = ChatTemplate(), key: str = "record_id"
) -> DataFrame:
    """One source's pairs as chat text. Rows without an instruction or an answer have none and
    are left out; :func:`left_out` counts them."""
    pairs = select_source(df, source, key)
    flat = pairs.withColumn("output", flatten_text(F.col("output"), pairs.schema["output"].dataType))
    return chat_format(flat, template).where(F.col("text").isNotNull()).select(key, "text")


def left_out(df: DataFrame, source: str) -> DataFrame:
    """One row: how many rows of a source make no training text, by what they lack."""
    return select_source(df, source).select(
        F.col("instruction").isNull().alias("a"), F.col("output").isNull().alias("b")
    ).agg(
        F.count_if("a").alias("no_instruction"),
        F.count_if(~F.col("a") & F.col("b")).alias("no_answer"),
    )


def training_rows(
    df: DataFrame,
    source: str,
    vocabulary_size: int,
    max_len: int = fixed.MAX_SEQ_LENGTH,
    key: str = "record_id",
    **split,
) -> tuple[DataFrame, DataFrame]:
    """Encoded training and test rows of one source."""
    texts = training_text(df, source, key=key)
    encoded = encode(texts, build_vocab(texts, vocabulary_size), max_len=max_len).drop("text")
    return train_test_split(encoded, key, **split)


def subword_training_rows(
    df: DataFrame,
    source: str,
    vocabulary: str,
    pad_id: int,
    max_len: int = fixed.MAX_SEQ_LENGTH,
    key: str = "record_id",
    **split,
) -> tuple[DataFrame, DataFrame]:
    """The same with the tokens of a subword vocabulary file; nothing is learned from the rows."""
    encoded = encode_subwords(training_text(df, source, key=key), vocabulary, pad_id, max_len=max_len)
    return train_test_split(encoded.drop("text"), key, **split)
