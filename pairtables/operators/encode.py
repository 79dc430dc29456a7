"""Word vocabulary and fixed-length encoding."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from pairtables import fixed_values as fixed
from pairtables.functions.text import tokens
from pairtables.operators.lookup import HOT_ROWS, salted_join
from pairtables.session import stored

PAD, UNKNOWN, FIRST_WORD = 0, 1, 2
#: A vocabulary below both bounds goes to the executors as it is; a larger one is joined.
MAX_BROADCAST_WORDS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def build_vocab(df: DataFrame, max_size: int, col: str = "text") -> DataFrame:
    """The most frequent words as ``(token, count, id)``; ids from 2 by count, then by word.

    Counts are combined before the shuffle, so frequent words do not skew it, and ids are
    given only after the cut to ``max_size``.
    """
    counts = df.select(F.explode(tokens(F.col(col))).alias("token")).groupBy("token").count()
    top = counts.orderBy(F.desc("count"), "token").limit(max_size)
    rank = F.row_number().over(Window.orderBy(F.desc("count"), "token"))
    return top.withColumn("id", rank + (FIRST_WORD - 1))


def encode(
    df: DataFrame,
    vocab: DataFrame,
    col: str = "text",
    max_len: int = fixed.MAX_SEQ_LENGTH,
    max_words: int = MAX_BROADCAST_WORDS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Add ``input_ids``, ``attention_mask`` and ``labels`` of ``max_len``, and ``truncated``.

    Only the first ``max_len`` words of a row are looked up. A vocabulary within the bounds
    goes to the executors once, and rows are encoded where they are read, with no shuffle; a
    larger one is joined by word. Labels copy the ids, padding included.
    """
    vocab = stored(vocab.select("token", "id"), "vocabulary")
    size = vocab.agg(F.count(F.lit(1)).alias("words"), F.sum(F.octet_length("token")).alias("bytes")).first()
    found = tokens(F.coalesce(F.col(col), F.lit("")))
    cut = df.withColumn("_words", found).withColumn("_n", F.size("_words"))
    cut = cut.withColumn("_words", F.slice("_words", 1, max_len))
    if size["words"] <= max_words and (size["bytes"] or 0) <= max_bytes:
        looked_up = cut.withColumn("_ids", _broadcast_ids(df, vocab)("_words"))
    else:
        looked_up = _joined_ids(cut, vocab)

    def padded(values, fill: int):
        return F.concat(values, F.array_repeat(F.lit(fill), max_len - F.size("_ids")))

    ones = F.array_repeat(F.lit(1), F.size("_ids"))
    return (
        looked_up.withColumn("input_ids", padded(F.col("_ids"), PAD))
        .withColumn("attention_mask", padded(ones, 0))
        .withColumn("labels", F.col("input_ids"))
        .withColumn("truncated", F.col("_n") > max_len)
        .drop("_ids", "_words", "_n")
    )


def _broadcast_ids(df: DataFrame, vocab: DataFrame):
    """A function of a word list that gives its ids, all words of a batch at once."""
    words = vocab.orderBy("token").toPandas()
    sent = df.sparkSession.sparkContext.broadcast((pd.Index(words["token"]), words["id"].to_numpy(np.int32)))

    @F.pandas_udf("array<int>")
    def look_up(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index, ids = sent.value
        for lists in batches:
            sizes = [len(row) for row in lists]
            if not sum(sizes):
                yield pd.Series([[] for _ in sizes])
                continue
            places = index.get_indexer(np.concatenate(lists.to_numpy()))
            flat = np.where(places < 0, UNKNOWN, ids[places]) if len(ids) else np.full(len(places), UNKNOWN)
            yield pd.Series(np.split(flat.astype(np.int32), np.cumsum(sizes)[:-1]))

    return look_up


def _joined_ids(cut: DataFrame, vocab: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The same by a join on the word, salted for frequent words. A row's at most ``max_len``
    ids are put together again under a row number that is written first, so it stays the same."""
    rows = stored(cut.withColumn("_row", F.monotonically_increasing_id()), "rows")
    each = rows.select("_row", F.posexplode("_words").alias("_at", "token"))
    each = each.withColumn("_spread", F.xxhash64("_row", "_at"))
    found = salted_join(each, vocab, ["token"], "_spread", "left", hot_rows)
    item = F.struct("_at", F.coalesce("id", F.lit(UNKNOWN)).cast("int").alias("id"))
    lists = found.groupBy("_row").agg(F.sort_array(F.collect_list(item)).alias("_list"))
    ids = F.coalesce(F.transform("_list", lambda x: x["id"]), F.array().cast("array<int>"))
    return rows.join(lists, "_row", "left").withColumn("_ids", ids).drop("_row", "_list")
