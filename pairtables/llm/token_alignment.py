"""Two tokenizers' tokens of a text, aligned where both end, and how often ids are linked."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from pairtables.llm.common import stored
from pairtables.llm.merge_path import PIECE, common_values

TOKENIZERS = "/opt/tokenizers"
BYTE_VOCABULARY, PIECE_MODEL = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text that are encoded and merged at once; a longer text is taken by itself, whole.
CHUNK_BYTES = 1 << 20
#: Rows of the table of frequent pairs that goes to every executor; rarer ones are joined by shuffle.
MAX_BROADCAST_PAIRS = 500_000
_B = 1 << 32


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves, the others from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


#: How byte-level vocabularies of this kind cut texts before they merge (a fixed value).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space this long in one run goes to the slower encoder, as the other's pattern recurs on it.
_BLANKS = 5_000
_LONG_BLANK = re.compile(rf"\s{{{_BLANKS}}}")


@lru_cache(maxsize=2)
def _byte_level(path: str):
    """A function from texts to ids, and the bytes of each id.

    Where the file's merges are numbered in their order, and it cuts texts by ``SPLIT`` alone,
    ids are ranks, and the rank encoder gives the same ids in a quarter of the time.
    """
    import tiktoken
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    of_char = _byte_of_char()
    table = [b""] * tokenizer.get_vocab_size()
    for token, at in tokenizer.get_vocab().items():
        known = all(c in of_char for c in token)
        table[at] = bytes(of_char[c] for c in token) if known else token.encode()
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    model, cut = parts["model"], parts["pre_tokenizer"] or {}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ranked = all(model["vocab"][a + b] == 256 + k for k, (a, b) in enumerate(pairs))
    plain = cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space")
    rank_encoder = None
    if ranked and plain and parts["normalizer"] is None and len(model["vocab"]) == 256 + len(pairs):
        ranks = {table[at]: at for at in model["vocab"].values()}
        rank_encoder = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(texts: list[str]) -> list[list[int]]:
        slow = [rank_encoder is None or len(t) >= _BLANKS and bool(_LONG_BLANK.search(t)) for t in texts]
        by_model = [t for t, is_slow in zip(texts, slow) if is_slow]
        encoded = iter(tokenizer.encode_batch_fast(by_model, add_special_tokens=False) if by_model else [])
        return [next(encoded).ids if is_slow else rank_encoder.encode_ordinary(t) for t, is_slow in zip(texts, slow)]

    return encode, table


@lru_cache(maxsize=2)
def _pieces(path: str):
    """The piece tokenizer and the bytes of each id."""
    import sentencepiece

    tokenizer = sentencepiece.SentencePieceProcessor(model_file=path)
    table = []
    for at in range(tokenizer.get_piece_size()):
        piece = tokenizer.id_to_piece(at)
        as_byte = tokenizer.is_byte(at)
        table.append(bytes([int(piece[1:-1], 16)]) if as_byte else piece.replace("▁", " ").encode())
    return tokenizer, table


def _texts_of_ids(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of each id as bytes, and how many there are."""
    width = len(str(size))
    digits = np.array([str(i).ljust(width) for i in range(size)], dtype=f"S{width}")
    return digits.view(np.uint8).reshape(size, width), np.array([len(str(i)) for i in range(size)])


class _Aligner:
    """Encodes chunks of texts and aligns them; one per task."""

    def __init__(self, folder: str, piece: int):
        self.piece = piece
        self.a, self.a_bytes = _byte_level(os.path.join(folder, BYTE_VOCABULARY))
        self.b, self.b_bytes = _pieces(os.path.join(folder, PIECE_MODEL))
        self.a_size = np.array([len(t) for t in self.a_bytes], dtype=np.int64)
        self.b_size = np.array([len(t) for t in self.b_bytes], dtype=np.int64)
        self.digits, self.n_digits = _texts_of_ids(max(len(self.a_bytes), len(self.b_bytes)))

    def _encoded(self, texts: list[str | None]):
        """Ids of both tokenizers per text; none where joined bytes are not those of the text."""
        some = [k for k, text in enumerate(texts) if text]
        full = [" " + texts[k] for k in some]
        ids_a = self.a(full)
        ids_b = self.b.encode([texts[k] for k in some], num_threads=1)
        a, b = [[]] * len(texts), [[]] * len(texts)
        for k, text, row_a, row_b in zip(some, full, ids_a, ids_b):
            raw = text.encode()
            same = b"".join(map(self.a_bytes.__getitem__, row_a)) == raw
            if same and b"".join(map(self.b_bytes.__getitem__, row_b)) == raw:
                a[k], b[k] = row_a, row_b
        return a, b

    def align(self, texts: list[str | None]) -> list[tuple]:
        """Per text: n_a, n_b, n_groups, sha256 of the groups, keys of linked pairs, times."""
        rows_a, rows_b = self._encoded(texts)
        n_a = np.array([len(r) for r in rows_a], dtype=np.int64)
        n_b = np.array([len(r) for r in rows_b], dtype=np.int64)
        ids_a = np.fromiter(chain.from_iterable(rows_a), dtype=np.int64, count=n_a.sum())
        ids_b = np.fromiter(chain.from_iterable(rows_b), dtype=np.int64, count=n_b.sum())
        # Texts follow one another, and both tokenizers cover the same bytes of each, so one
        # merge of all ends is that of every text, and no group reaches into the next text.
        at_a, at_b = common_values(np.cumsum(self.a_size[ids_a]), np.cumsum(self.b_size[ids_b]), self.piece)
        text_of_group = np.searchsorted(np.cumsum(n_b), at_b, side="right")
        n_groups = np.bincount(text_of_group, minlength=len(texts))
        hashes = self._hashes(ids_a, ids_b, at_a, at_b, text_of_group, n_groups)
        keys = ids_a[at_a] * _B + ids_b[at_b]
        order = np.lexsort((keys, text_of_group))
        keys, owner = keys[order], text_of_group[order]
        first = np.ones(len(keys), dtype=bool)
        first[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
        place = np.flatnonzero(first)
        times = np.diff(np.append(place, len(keys)))
        cuts = np.searchsorted(owner[place], np.arange(len(texts) + 1))
        return [
            (n_a[k], n_b[k], n_groups[k], hashes[k], keys[place[s:e]], times[s:e])
            for k, (s, e) in enumerate(zip(cuts[:-1], cuts[1:]))
        ]

    def _hashes(self, ids_a, ids_b, at_a, at_b, text_of_group, n_groups) -> list[str]:
        """sha256 of ``a1,a2|b1;a3|b2,b3`` per text; an empty string where there are no tokens."""
        size_a = np.diff(at_a, prepend=-1)  # tokens of each group
        size_b = np.diff(at_b, prepend=-1)
        end = np.cumsum(size_a + size_b)  # of each group among all tokens, a group's A before its B
        ids = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
        group_a, group_b = np.repeat(np.arange(len(at_a)), size_a), np.repeat(np.arange(len(at_b)), size_b)
        ids[np.arange(len(ids_a)) + (np.cumsum(size_b) - size_b)[group_a]] = ids_a
        ids[np.arange(len(ids_b)) + np.cumsum(size_a)[group_b]] = ids_b
        mark = np.full(len(ids), ord(","), dtype=np.uint8)
        mark[end - 1] = ord(";")
        mark[end - size_b - 1] = ord("|")
        width = self.digits.shape[1]
        chars = np.empty((len(ids), width + 1), dtype=np.uint8)
        chars[:, :width] = self.digits[ids]
        long = self.n_digits[ids]
        chars[np.arange(len(ids)), long] = mark
        flat = chars[np.arange(width + 1) <= long[:, None]].tobytes()
        # A text's part ends with the mark of its last group, which is left out.
        token_end = np.concatenate(([0], np.cumsum(long + 1)))
        last_group = np.cumsum(n_groups)
        stops = token_end[np.concatenate(([0], end))[last_group]]
        starts = np.concatenate(([0], stops[:-1]))
        return [hashlib.sha256(flat[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(starts, stops)]


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for k, text in enumerate(texts):
        more = 4 * len(text or "")
        if size and size + more > 4 * CHUNK_BYTES:
            yield start, k
            start, size = k, 0
        size += more
    if start < len(texts):
        yield start, len(texts)


def align_tokens(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = TOKENIZERS, piece: int = PIECE
) -> DataFrame:
    """One stored row per row of ``docs``: ``_row``, ``_id``, n_a, n_b, n_groups, n_links,
    groups_sha256, and the linked id pairs ``_keys`` (A id * 2^32 + B id) with their ``_times``.

    A is the byte-level tokenizer over a space and the text, B the piece tokenizer over the text,
    to which it adds the space. Tokens have one byte or more, so ends ascend strictly, and a
    group, the stretch up to an end that both have, holds one link. A null or empty text, or one
    whose bytes either tokenizer does not give back, has no tokens: zeros and an empty string.
    Null and repeated ids keep their rows; other columns are not looked at; an empty table gives
    no rows. A text is encoded whole, as one value; nothing is shuffled.
    """
    schema = T.StructType(
        [
            T.StructField("_row", T.LongType()),
            T.StructField("_id", docs.schema[id_col].dataType),
            *[T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")],
            T.StructField("groups_sha256", T.StringType()),
            T.StructField("_keys", T.ArrayType(T.LongType())),
            T.StructField("_times", T.ArrayType(T.LongType())),
        ]
    )

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for batch in batches:
            aligner = aligner or _Aligner(folder, piece)
            texts = batch.column(2).to_pylist()
            for start, stop in _chunks(texts):
                rows = aligner.align(texts[start:stop])
                n_a, n_b, n_groups, hashes, keys, times = zip(*rows)
                ends = pa.array(np.cumsum([0, *map(len, keys)]), pa.int32())
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1),
                        *[pa.array(np.array(c, dtype=np.int64)) for c in (n_a, n_b, n_groups, n_groups)],
                        pa.array(hashes, pa.string()),
                        *[pa.ListArray.from_arrays(ends, pa.array(np.concatenate(c))) for c in (keys, times)],
                    ],
                    names=schema.names,
                )

    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text")
    )
    return stored(rows.mapInArrow(aligned, schema), "aligned")


def link_counts(aligned: DataFrame) -> DataFrame:
    """Per linked pair of ids: ``_key``, ``_count`` over all texts, ``_best`` where no other pair
    with its B id has more. Counts are combined before the shuffle."""
    counts = _pairs(aligned).groupBy("_key").agg(F.sum("_n").alias("_count"))
    b = F.pmod(F.col("_key"), F.lit(_B)).alias("_b")
    counts = stored(counts.select("_key", "_count", b), "link_counts")
    most = counts.groupBy("_b").agg(F.max("_count").alias("_most"))  # one row per B id of the vocabulary
    best = (F.col("_count") == F.col("_most")).alias("_best")
    return stored(counts.join(F.broadcast(most), "_b").select("_key", "_count", best), "best_links")


def _pairs(aligned: DataFrame) -> DataFrame:
    each = aligned.select("_row", F.explode(F.arrays_zip("_keys", "_times")).alias("_p"))
    return each.select("_row", F.col("_p._keys").alias("_key"), F.col("_p._times").alias("_n"))


def link_sums(aligned: DataFrame, counts: DataFrame, max_pairs: int = MAX_BROADCAST_PAIRS) -> DataFrame:
    """Per ``_row``: n_best and count_sum over its links.

    The frequent pairs, those with at least the least power of two that leaves ``max_pairs`` of
    them, go to every executor. What is left of the texts' pairs is joined by a shuffle, in which
    no key is hot: a pair below that count is in fewer texts than it.
    """
    level = F.floor(F.log2("_count")).cast("int")
    sizes = dict(counts.groupBy(level.alias("_level")).count().collect())  # at most 64 rows
    least, taken = max(sizes, default=0) + 1, 0
    while least > 0 and taken + sizes.get(least - 1, 0) <= max_pairs:
        least -= 1
        taken += sizes.get(least, 0)
    frequent = counts.where(F.col("_count") >= 2**least)
    found = _pairs(aligned).join(F.broadcast(frequent), "_key", "left")
    sums = [
        F.sum(F.when(F.col("_best"), F.col("_n")).otherwise(0)).alias("n_best"),
        F.sum(F.col("_n") * F.col("_count")).alias("count_sum"),
    ]
    parts = found.where(F.col("_count").isNotNull()).groupBy("_row").agg(*sums)
    if least:
        rare = found.where(F.col("_count").isNull()).select("_row", "_key", "_n")
        rare = rare.join(counts.where(F.col("_count") < 2**least).hint("merge"), "_key")
        parts = parts.unionByName(rare.groupBy("_row").agg(*sums))
        parts = parts.groupBy("_row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return parts


def linked_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    folder: str = TOKENIZERS,
    piece: int = PIECE,
    max_pairs: int = MAX_BROADCAST_PAIRS,
) -> DataFrame:
    """Per row of ``docs``: the id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Cases are those of :func:`align_tokens`; a text without tokens has zeros in all counts.
    """
    aligned = align_tokens(docs, id_col, text_col, folder, piece)
    sums = link_sums(aligned, link_counts(aligned), max_pairs)
    return aligned.drop("_keys", "_times").join(sums, "_row", "left").select(
        F.col("_id").alias(id_col), "n_a", "n_b", "n_groups", "n_links",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")],
        "groups_sha256",
    )


def op13_token_alignment(spark, sf_dir: str) -> DataFrame:
    return linked_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
