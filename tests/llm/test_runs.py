"""Runs against a search of all starts and periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from helpers import WORD, frame
from pairtables.llm.periodic_runs import periodic_runs
from pairtables.llm.repeats import _names, _Wavelet, runs


def plain_runs(words):
    """Maximal stretches with their smallest period, by comparing words q apart."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)  # smaller periods come first
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    collapsed = " ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    return (
        len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed.encode()).hexdigest(),
    )


def from_symbols(values):
    start, end, period = runs(np.array([*values, -1], dtype=np.int64), 6, 4)
    return list(zip(start.tolist(), (end - start).tolist(), period.tolist()))


pieces = st.lists(
    st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 9)), max_size=5
).map(lambda parts: [x for part, n in parts for x in part * n])


@settings(max_examples=400, deadline=None)
@given(pieces)
def test_runs(values):
    assert from_symbols(values) == plain_runs(values)


def test_nested_runs():
    rng = random.Random(5)
    for _ in range(300):
        inner = [rng.randint(0, 1) for _ in range(rng.randint(1, 3))] * rng.randint(1, 9)
        inner += [rng.randint(0, 2) for _ in range(rng.randint(0, 4))]
        values = inner * rng.randint(1, 6) + [rng.randint(0, 1) for _ in range(rng.randint(0, 9))]
        cut = rng.randint(0, 5)
        assert from_symbols(values[cut:]) == plain_runs(values[cut:])
    for word in ("a" * 100, "ab" * 64, "aab" * 33, "a" * 31 + "b" + "a" * 31 + "b" + "a" * 31 + "b" + "a" * 31 + "b"):
        assert from_symbols([ord(c) for c in word]) == plain_runs(word)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60), st.data())
def test_suffix_array_and_wavelet(values, data):
    symbols = np.array([*values, -1], dtype=np.int64)
    order = _names(symbols)[2]
    assert order.tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:].tolist())
    low = data.draw(st.integers(0, len(symbols) - 1))
    high = data.draw(st.integers(low + 1, len(symbols)))
    limit = data.draw(st.integers(0, len(symbols) + 70))
    part = sorted(order[low:high].tolist())
    wavelet, one = _Wavelet(order), lambda *x: [np.array([v]) for v in x]
    assert wavelet.below(*one(low, high, limit))[0] == sum(v < limit for v in part)
    assert [wavelet.kth(*one(low, high, k))[0] for k in range(high - low)] == part


def rows():
    rng = random.Random(3)
    out = [(1, None), (2, ""), (3, " \t"), (4, "one"), (5, "a a a a a a"), (None, "b b b b b b b")]
    out += [(5, "a a a a a a"), (6, "x x x x x x x x x x x x"), (7, "a b " * 3000 + "c")]
    for i in range(100, 260):
        text = " ".join(rng.choice("abcd") for _ in range(rng.randint(1, 60)))
        out.append((i, text + " " + text[: rng.randint(0, 8)] * rng.randint(0, 7)))
    return out


def test_documents(spark):
    docs = frame(spark, [(i, t, "s") for i, t in rows()]).repartition(3)
    got = sorted([tuple(r) for r in periodic_runs(docs, repeat_some=True).collect()], key=str)
    assert got == sorted([(i, *plain(i, t)) for i, t in rows()], key=str)


def test_real_documents(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    got = {r[0]: tuple(r[1:]) for r in periodic_runs(docs, repeat_some=True).collect()}
    assert sum(r[0] > 0 for r in got.values()) > 10
    short = [r for r in docs.collect() if len(r["text"]) < 6_000]
    assert len(short) > 100
    for r in short:
        assert got[r["doc_id"]] == plain(r["doc_id"], r["text"])


def test_long_text(spark):
    words = [str(i % 997) for i in range(300_000)] + ["end"]
    docs = frame(spark, [(1, " ".join(words), "s")])
    row = periodic_runs(docs).first()
    assert tuple(row)[1:6] == (1, 0, 300_000, 997, 1000 * 300_000 // 997)


@pytest.mark.parametrize("repeat_some", [True, False])
def test_empty_table(spark, repeat_some):
    assert periodic_runs(frame(spark, []), repeat_some=repeat_some).count() == 0
