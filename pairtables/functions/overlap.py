"""Arrow functions that compare the two texts of one row.

Both texts sit in the same row, so nothing has to be exploded, shuffled or grouped: a row
is compared where it is read. Built-in array functions can express the n-gram count too,
but took several times as long, and common subsequences would copy quadratically.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F, types as T

from pairtables import fixed_values as fixed

_words = re.compile(fixed.TOKEN_PATTERN).findall
#: Rows whose n-grams are counted together: their arrays stay in the processor's cache.
_ROWS = 50
#: Bytes of text whose words are held at once; a longer pair of texts is compared by itself, whole.
_BYTES = 1 << 20
#: Words that one big integer stands for. There is one such integer per distinct word, so without
#: a bound their memory would grow with the square of a text's length.
_BITS = 1 << 14


def pieces(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Start and end of stretches of a batch, bounded by rows and bytes: words take many times
    the memory of their text, so those of a whole batch are never held."""
    start = 0
    while start < len(sizes):
        stop, size = start, 0
        while stop < len(sizes) and stop < start + _ROWS and (stop == start or size + sizes[stop] <= _BYTES):
            size += sizes[stop]
            stop += 1
        yield start, stop
        start = stop


def ngram_overlaps(lefts: list[list[str]], rights: list[list[str]], max_n: int) -> np.ndarray:
    """Row by row how many n-grams two texts share, each as often as both hold it, for n from 1.

    All texts are one array of word numbers. An n-gram is the number of its first n - 1 words
    and that of its last; the pairs are numbered anew for each n, so they stay small and
    exact. Counts of (n-gram, row) on both sides are then met by one sorted intersection.
    """
    rows, known = len(lefts), {}
    sizes = np.array([len(x) for side in (lefts, rights) for x in side], dtype=np.int64)
    numbers = (known.setdefault(w, len(known)) for side in (lefts, rights) for x in side for w in x)
    flat = np.fromiter(numbers, dtype=np.int64, count=int(sizes.sum()))
    row = np.repeat(np.tile(np.arange(rows), 2), sizes)
    right = np.repeat(np.repeat([False, True], rows), sizes)
    to_end = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(flat))
    out, code = np.zeros((rows, max_n), dtype=np.int64), flat
    for n in range(1, max_n + 1):
        fits = to_end >= n
        if n > 1:
            last = np.zeros_like(flat)
            last[: max(0, len(flat) - n + 1)] = flat[n - 1 :]
            code = np.unique(np.where(fits, code * max(1, len(known)) + last, -1), return_inverse=True)[1]
        keys = code * rows + row
        a, n_a = np.unique(keys[fits & ~right], return_counts=True)
        b, n_b = np.unique(keys[fits & right], return_counts=True)
        _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
        out[:, n - 1] = np.bincount(a[i] % rows, weights=np.minimum(n_a[i], n_b[j]), minlength=rows) if rows else 0
    return out


def lcs_length(a: list[str], b: list[str], bits: int = _BITS) -> int:
    """Length of the longest common subsequence, one big integer per row of the table.

    The table is cut into strips of ``bits`` words of ``a``. What a row's sum carries out of one
    strip is added to the same row in the next.
    """
    head = 0
    while head < len(a) and head < len(b) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    carries = bytearray(len(b)) if len(a) > bits else None
    return head + tail + sum(_strip(a[i : i + bits], b, carries) for i in range(0, len(a), bits))


def _strip(a: list[str], b: list[str], carries: bytearray | None) -> int:
    """Words that a strip adds to the length; with ``carries``, those of the rows are replaced."""
    where: dict[str, int] = {}
    for i, token in enumerate(a):
        where[token] = where.get(token, 0) | 1 << i
    full = (1 << len(a)) - 1
    open_bits = full
    if carries is None:
        for token in b:
            hits = open_bits & where.get(token, 0)
            if hits:
                open_bits = (open_bits + hits | open_bits - hits) & full
    else:
        for j, token in enumerate(b):
            hits = open_bits & where.get(token, 0)
            if hits or carries[j]:
                total = open_bits + hits + carries[j]
                carries[j] = total > full
                open_bits = (total | open_bits - hits) & full
    return len(a) - open_bits.bit_count()


def batch_counts(left: pa.Array, right: pa.Array, max_n: int = 0, lcs: bool = False) -> np.ndarray:
    """Row by row the counts of :func:`overlap_counts`, from the texts of a batch."""
    counts = np.zeros((len(left), 2 + max_n + lcs), dtype=np.int64)
    sizes = pc.add(pc.binary_length(left), pc.binary_length(right)).to_pylist()
    for start, stop in pieces(sizes):
        lefts, rights = ([_words(x) for x in side[start:stop].to_pylist()] for side in (left, right))
        part = counts[start:stop]
        part[:, 0], part[:, 1] = [len(x) for x in lefts], [len(x) for x in rights]
        if max_n:
            part[:, 2 : 2 + max_n] = ngram_overlaps(lefts, rights, max_n)
        if lcs:
            part[:, -1] = [lcs_length(a, b) for a, b in zip(lefts, rights)]
    return counts


def overlap_counts(targets: Column, outputs: Column, max_n: int = 0, lcs: bool = False) -> Column:
    """A struct of token counts, shared n-grams for 1..max_n and, on demand, the LCS length.

    Null if either text is null. Texts are lower-cased in the JVM, so that tokens agree with
    :func:`pairtables.functions.text.tokens`.
    """
    fields = ["target_tokens", "output_tokens"]
    fields += [f"overlap{n}" for n in range(1, max_n + 1)]
    fields += ["lcs"] if lcs else []
    schema = T.StructType([T.StructField(f, T.LongType()) for f in fields])

    @F.arrow_udf(schema)
    def compare(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            counts = batch_counts(left, right, max_n, lcs)
            yield pa.StructArray.from_arrays([pa.array(column) for column in counts.T], fields)

    known = targets.isNotNull() & outputs.isNotNull()
    counted = compare(
        F.lower(F.coalesce(targets, F.lit(""))), F.lower(F.coalesce(outputs, F.lit("")))
    )
    return F.when(known, counted)
