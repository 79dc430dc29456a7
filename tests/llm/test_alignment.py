"""Token alignment against a walk over both token lists, and the merge against sets."""

import hashlib
import os
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from helpers import frame
from pairtables.llm.merge_path import common_values, split_points
from pairtables.llm.token_alignment import BYTE_VOCABULARY, TOKENIZERS, _byte_level, align_tokens, link_counts, link_sums, linked_tokens

values = st.lists(st.integers(0, 60), unique=True).map(sorted)


@settings(max_examples=200, deadline=None)
@given(values, values, st.integers(1, 9))
def test_common_values(a, b, piece):
    at_a, at_b = common_values(np.array(a, dtype=np.int64), np.array(b, dtype=np.int64), piece)
    assert [a[i] for i in at_a] == [b[j] for j in at_b] == sorted(set(a) & set(b))


@settings(max_examples=100, deadline=None)
@given(values, values)
def test_split_points(a, b):
    merged = sorted([(v, 0) for v in a] + [(v, 1) for v in b])
    wanted = [sum(1 for _, side in merged[:d] if side == 0) for d in range(len(merged) + 1)]
    got = split_points(np.array(a, dtype=np.int64), np.array(b, dtype=np.int64), np.arange(len(merged) + 1))
    assert got.tolist() == wanted


def plain(rows):
    """{doc_id: row} by walking byte by byte."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_tok = Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=f"{TOKENIZERS}/piece_bpe_32k.model")
    links, out = {}, {}
    for i, text in rows:
        out[i], links[i] = [0, 0, 0, 0, 0, 0, ""], []
        if not text:
            continue
        full = (" " + text).encode()
        a = a_tok.encode(" " + text, add_special_tokens=False).ids
        b = b_tok.encode(text)
        ends_a = [len(a_tok.decode(a[: k + 1], skip_special_tokens=False).encode()) for k in range(len(a))]
        sizes_b = [
            1 if b_tok.is_byte(t) else len(b_tok.id_to_piece(t).replace("▁", " ").encode()) for t in b
        ]
        raw_b = b"".join(
            bytes([int(b_tok.id_to_piece(t)[3:5], 16)]) if b_tok.is_byte(t)
            else b_tok.id_to_piece(t).replace("▁", " ").encode()
            for t in b
        )
        if raw_b != full:
            continue
        if not text.isascii():  # a decoded prefix may end inside a character: take sizes of the entries
            vocab = {v: k for k, v in a_tok.get_vocab().items()}
            ends_a = np.cumsum([len(vocab[t]) for t in a]).tolist()
        ends_b = np.cumsum(sizes_b).tolist()
        cuts = sorted(set(ends_a) & set(ends_b))
        groups, low = [], 0
        for cut in cuts:
            left = [str(t) for t, e in zip(a, ends_a) if low < e <= cut]
            right = [str(t) for t, e in zip(b, ends_b) if low < e <= cut]
            groups.append(",".join(left) + "|" + ",".join(right))
            links[i].append((a[ends_a.index(cut)], b[ends_b.index(cut)]))
            low = cut
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out[i] = [len(a), len(b), len(groups), len(links[i]), 0, 0, sha]
    counts = Counter(p for each in links.values() for p in each)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    for i, each in links.items():
        out[i][4] = sum(counts[p] == most[p[1]] for p in each)
        out[i][5] = sum(counts[p] for p in each)
    return {i: tuple(v) for i, v in out.items()}


ROWS = [
    (1, "The quick brown fox jumps over the lazy dog."),
    (2, None),
    (3, ""),
    (4, " "),
    (5, "ein Straßenfest, naïve café — 東京 🙂 \u0000 ́"),
    (6, "has ▁ in it"),
    (7, "<|endoftext|> and <s> </s> <0x41> are plain"),
    (8, "The quick brown fox jumps over the lazy dog."),
    (9, "a\n\n\tb   c \r\n d"),
    (10, "x" * 3000),
    (12, " " * 6000 + "b" + "\n" * 7000 + "\u2003" * 100),
    (11, "the dog and the fox, the end " * 700),
]


@pytest.mark.parametrize("piece, max_pairs", [(512, 500_000), (7, 20), (64, 0)])
def test_linked_tokens(spark, piece, max_pairs):
    docs = frame(spark, [(i, t, "s") for i, t in ROWS])
    rows = linked_tokens(docs, piece=piece, max_pairs=max_pairs).collect()
    assert {r[0]: tuple(r[1:]) for r in rows} == plain(ROWS)


def test_repeated_and_null_ids(spark):
    docs = frame(spark, [(None, "one two", "s"), (None, "one", "s"), (3, "one two", "s"), (3, "one two", "s")])
    rows = sorted(tuple(r) for r in linked_tokens(docs).select("n_a", "n_best", "count_sum").collect())
    assert rows == [(1, 1, 4), (2, 2, 7), (2, 2, 7), (2, 2, 7)]


def test_empty_table(spark):
    assert linked_tokens(frame(spark, [])).count() == 0


def test_plan_has_no_shuffle_of_frequent_pairs(spark):
    aligned = align_tokens(frame(spark, [(i, t, "s") for i, t in ROWS]))
    plan = link_sums(aligned, link_counts(aligned))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_rank_encoder_gives_the_ids_of_the_model(sf_check):
    import pandas as pd
    from tokenizers import Tokenizer

    path = os.path.join(TOKENIZERS, BYTE_VOCABULARY)
    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b {c}1{c} {c}{c}  {c}.\n{c}" for c in points[:0x3400] + points[0x3400::7]]
    texts += pd.read_parquet(f"{sf_check}/documents.parquet")["text"].tolist()
    wanted = [e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)]
    assert _byte_level(path)[0](texts) == wanted
