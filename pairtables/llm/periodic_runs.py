"""Runs of repeated word sequences in texts, and the texts without the repetitions."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from pairtables.llm.repeats import runs

LEAST_WORDS, LEAST_TIMES = 6, 4
#: Words of texts that are sorted together; a longer text is taken by itself, whole.
CHUNK_WORDS = 1 << 18

_COUNTS = ("n_runs", "start", "length", "period", "exponent_milli")
_HASHES = ("runs_sha256", "collapsed_sha256")


def repeated_words(doc_id: int | None, n: int) -> np.ndarray | None:
    """For one id in ten, the places whose words make up the text; None for the others."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + np.arange(n - a) % p
    return at


def _rows(words: list[list[bytes]]) -> Iterator[tuple]:
    """Per text: the counts of the result, its two hashes."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    flat = np.array([w for text in words for w in text], dtype=object)
    codes, distinct = pd.factorize(flat) if len(flat) else (np.empty(0, dtype=np.int64), [])
    # Each text has its own numbers, and ends with one more, which no other place has.
    base = np.arange(len(words), dtype=np.int64) * (len(distinct) + 1)
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    symbols = np.repeat(base, sizes + 1) + len(distinct)
    is_word = np.ones(len(symbols), dtype=bool)
    is_word[starts + sizes] = False
    symbols[is_word] += codes - len(distinct)
    start, end, period = runs(symbols, LEAST_WORDS, LEAST_TIMES)
    owner = np.searchsorted(starts, start, side="right") - 1
    cuts = np.searchsorted(owner, np.arange(len(words) + 1))
    change = np.zeros(len(symbols) + 1, dtype=np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, end, -1)
    kept = np.cumsum(change[:-1]) == 0
    for k, text in enumerate(words):
        at, low, high = starts[k], cuts[k], cuts[k + 1]
        s, e, q = start[low:high] - at, end[low:high] - at, period[low:high]
        lines = "".join(f"{x},{y - x},{z}\n" for x, y, z in zip(s.tolist(), e.tolist(), q.tolist()))
        best = (None,) * 4
        if len(s):
            # Runs are in order of start and period, so the first of the longest is wanted.
            b = int(np.argmax(e - s))
            length, each = int(e[b] - s[b]), int(q[b])
            best = (int(s[b]), length, each, 1000 * length // each)
        if len(s):
            text = [text[i] for i in np.flatnonzero(kept[at : at + sizes[k]])]
        yield (
            len(s), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(text)).hexdigest()
        )


def _chunks(words: list[list[bytes]]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for k, text in enumerate(words):
        if size and size + len(text) > CHUNK_WORDS:
            yield start, k
            start, size = k, 0
        size += len(text)
    if start < len(words):
        yield start, len(words)


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repeat_some: bool = False
) -> DataFrame:
    """Per row of ``docs``: the id, n_runs, start, length, period and exponent_milli of the longest
    run (ties: smallest start, then period; nulls without a run), runs_sha256, collapsed_sha256.

    Words are runs of anything but ASCII white space. A run has the smallest period q, is at
    least 6 words and 4 * q long, and no neighbouring word extends it. A word is dropped from the
    collapsed text if it lies in a run after that run's first q words. ``repeat_some`` first
    makes a part of one text in ten periodic, by its id (see :func:`repeated_words`).

    Null and empty texts have no words: no runs, hashes of an empty string. Rows with null or
    repeated ids are kept as they are, a null id is never made periodic. Other columns are not
    looked at; an empty table gives no rows. Texts are read where they lie: nothing is shuffled.
    Memory is some 12 * log2(n) bytes for each of the n words of a chunk, or of a longer text.
    """
    schema = T.StructType(
        [
            docs.schema[id_col],
            *[T.StructField(c, T.LongType()) for c in _COUNTS],
            *[T.StructField(c, T.StringType()) for c in _HASHES],
        ]
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # bytes.split() cuts at space and the five ASCII control characters of white space
            words = [(text or b"").split() for text in batch.column(1).to_pylist()]
            if repeat_some:
                for k, doc_id in enumerate(batch.column(0).to_pylist()):
                    at = repeated_words(doc_id, len(words[k]))
                    if at is not None:
                        words[k] = [words[k][i] for i in at.tolist()]
            for start, stop in _chunks(words):
                columns = list(zip(*_rows(words[start:stop])))
                kinds = [pa.int64()] * len(_COUNTS) + [pa.string()] * len(_HASHES)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, stop - start), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                    names=schema.names,
                )

    return docs.select(id_col, F.col(text_col).cast("binary").alias("_text")).mapInArrow(find, schema)


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    return periodic_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"), repeat_some=True)
