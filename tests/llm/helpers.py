"""Small documents and plain versions of the corpus operators."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, _row long"


def frame(spark, rows):
    """Documents from (doc_id, text, source), with columns whose names clash with inner ones."""
    full = [(i, t, "en", s, None if t is None else len(t), "x", 7) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def shingles(text, n):
    words = WORD.findall((text or "").translate(_LOWER))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}


def groups(rows, n, part, whole):
    """{doc_id: (size, least id of its component)}."""
    sets = {i: shingles(t, n) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            same = len(sets[a] & sets[b])
            if a < b and sets[a] and whole * same >= part * (len(sets[a]) + len(sets[b]) - same):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}
