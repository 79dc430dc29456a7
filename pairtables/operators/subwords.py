"""Token ids and token counts by a given subword vocabulary. Vocabularies are read, never trained.

The vocabulary is a file of one of the three usual kinds, chosen by its ending: ``.json`` (a
byte-pair model with its merges), ``.model`` (sentence pieces), ``.tiktoken`` (ranks). Its path
must be readable where tasks run. Texts are encoded where they are read: nothing is shuffled, and
each Python worker loads the file once.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from pairtables import fixed_values as fixed

#: How rank files cut texts before they merge, unless a pattern is given.
RANK_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters that are handed to an encoder at once; a longer text is encoded by itself, whole.
CHUNK_CHARS = 1 << 20

Encoder = Callable[[list[str]], list[list[int]]]


@lru_cache(maxsize=4)
def load_encoder(path: str, pattern: str = RANK_PATTERN) -> Encoder:
    """A function from texts to lists of ids, without special tokens: their strings are plain text."""
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        model = Tokenizer.from_file(path)
        model.encode_special_tokens = True
        model.no_truncation()
        model.no_padding()
        return lambda texts: [e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)]
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: pieces.encode(texts, num_threads=1)
    if path.endswith(".tiktoken"):
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}
        by_rank = tiktoken.Encoding(os.path.basename(path), pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [by_rank.encode_ordinary(text) for text in texts]
    raise ValueError(f"not a vocabulary of a known kind: {path}")


def _encoded(encode: Encoder, texts: list[str | None]) -> Iterator[list[int]]:
    """Ids of each text, in order; none for null."""
    start = 0
    while start < len(texts):
        stop, size = start, 0
        while stop < len(texts) and (stop == start or size + len(texts[stop] or "") <= CHUNK_CHARS):
            size += len(texts[stop] or "")
            stop += 1
        yield from encode([text or "" for text in texts[start:stop]])
        start = stop


def subword_ids(path: str, max_len: int | None = None, pattern: str = RANK_PATTERN) -> Callable[[Column], Column]:
    """A function of a text column that gives ``ids`` (the first ``max_len``, or all) and ``n``, the
    number of all; a null or empty text has none."""

    @F.pandas_udf("ids array<int>, n long")
    def ids_of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encode = load_encoder(path, pattern)
        for texts in batches:
            lists, sizes = [], []
            for row in _encoded(encode, texts.tolist()):  # lists of all ids of a batch are never held
                lists.append(np.array(row[:max_len], dtype=np.int32))
                sizes.append(len(row))
            yield pd.DataFrame({"ids": pd.Series(lists, dtype=object), "n": pd.Series(sizes, dtype="int64")})

    return ids_of


def subword_count(path: str, pattern: str = RANK_PATTERN) -> Callable[[Column], Column]:
    """A function of a text column that gives its number of tokens; 0 for a null or empty text."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = load_encoder(path, pattern)
        for texts in batches:
            yield pd.Series([len(row) for row in _encoded(encode, texts.tolist())], dtype="int64")

    return count


def encode_subwords(
    df: DataFrame,
    path: str,
    pad_id: int,
    col: str = "text",
    max_len: int = fixed.MAX_SEQ_LENGTH,
    pattern: str = RANK_PATTERN,
) -> DataFrame:
    """Add ``input_ids``, ``attention_mask`` and ``labels`` of ``max_len``, and ``truncated``.

    The same columns as :func:`pairtables.operators.encode.encode` gives for a word vocabulary:
    texts are cut at ``max_len`` tokens and filled up with ``pad_id``, labels copy the ids.
    """
    found = df.withColumn("_found", subword_ids(path, max_len, pattern)(F.col(col)))
    ids, n_pad = F.col("_found.ids"), F.lit(max_len) - F.size("_found.ids")
    return (
        found.withColumn("input_ids", F.concat(ids, F.array_repeat(F.lit(pad_id), n_pad)))
        .withColumn("attention_mask", F.concat(F.array_repeat(F.lit(1), F.size(ids)), F.array_repeat(F.lit(0), n_pad)))
        .withColumn("labels", F.col("input_ids"))
        .withColumn("truncated", F.col("_found.n") > max_len)
        .drop("_found")
    )
