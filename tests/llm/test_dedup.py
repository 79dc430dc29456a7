"""Exact dedup, line dedup, n-gram join."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import helpers
from pairtables.llm import exact_dedup as exact
from pairtables.llm.components import components
from pairtables.llm.exact_dedup import exact_dedup
from pairtables.llm.line_dedup import remove_shared_lines
from pairtables.llm import ngram_join as near
from pairtables.llm.ngram_join import _keys, ngram_groups, one_per_group
from pairtables.llm.trie import links


def test_exact_dedup_ties_nulls_and_rounds(spark):
    rows = [(1, "a", "s"), (5, "a", None), (5, "a", "s"), (None, "a", "s"), (2, None, "s"), (3, "", "s"), (None, "b", "s")]
    rows += [(100 + i, f"text {i}", "s") for i in range(500)]
    docs = helpers.frame(spark, rows)
    for settings in ({}, {"max_frequent": 0}, {"bits_per_row": 1, "max_frequent": 1}, {"max_filter_bits": 32_768, "bits_per_row": 400}):
        got = exact_dedup(docs, **settings).collect()
        assert len(got) == len(rows)
        assert [(r.keep_id, r.group_size) for r in got if r.doc_id == 1] == [(5, 4)]
        assert sorted(r.kept for r in got if r.doc_id == 5) == [False, True]
        assert {r.doc_id: r.kept for r in got if r.doc_id in (2, 3)} == {2: False, 3: True}
        assert sum(r.kept for r in got) == 503
    assert exact_dedup(docs.limit(0)).count() == 0


def test_exact_dedup_of_many_rounds_reads_its_own_share(spark, monkeypatch):
    rows = [(i, f"text {i % 900}", "s") for i in range(1000)] + [(5000, "long " * 300_000, "s"), (5001, "long " * 300_000, "s")]
    shares, share = [], exact._share

    def seen(rows, blocks):
        shares.append(rows)
        return share(rows, blocks)

    monkeypatch.setattr(exact, "_share", seen)
    got = exact_dedup(helpers.frame(spark, rows), max_filter_bits=32_768, bits_per_row=32 * 64)
    assert len(shares) == 63
    assert {r.doc_id: (r.keep_id, r.group_size) for r in got.collect()} == {
        i: (i % 900 + 900 * (i % 900 < 100), 1 + (i % 900 < 100)) for i in range(1000)
    } | {5000: (5001, 2), 5001: (5001, 2)}
    plan = shares[7]._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(_deal), GreaterThanOrEqual(_deal," in plan and "Exchange" not in plan
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_exact_dedup_passes_single_rows_by(spark):
    from pairtables.llm.exact_dedup import _share

    docs = helpers.frame(spark, [(i, f"text {i}", "s") for i in range(2000)] + [(9000, "text 5", "s")])
    rows = docs.select(F.col("doc_id").alias("_id"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("_sha"))
    single, maybe = _share(rows, 4)
    assert {5, 9000} <= {r[0] for r in maybe.select("_id").collect()}
    assert single.count() > 1900
    assert "Exchange hashpartitioning(_sha" not in single._jdf.queryExecution().executedPlan().toString()


def test_line_dedup(spark):
    shared = "this line is shared"
    docs = [(i, f"own line number {i}\n {shared}\t\n\nOf.", f"s{i}") for i in range(6)]
    docs += [(20, shared, "s0"), (21, None, "s1"), (22, "", None), (None, f"{shared}\nrest of the null one", None)]
    docs += [(30, "only in three sites\nOf.", f"s{i}") for i in (1, 2, 3)]
    got = remove_shared_lines(helpers.frame(spark, docs), min_words=3).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(docs) and by[0]._id == "x"
    assert by[0].text == docs[0][1] and by[0]._lines.n_removed == 0
    assert by[3].text == "own line number 3\n\nOf." and by[3]._lines == (4, 1)
    assert by[20].text == "" and by[21].text is None and by[22].text == ""
    assert by[None].text == "rest of the null one"
    assert by[30].text == "only in three sites\nOf."
    assert remove_shared_lines(helpers.frame(spark, [])).count() == 0


def test_line_dedup_of_short_and_spaceless_lines(spark):
    notice = "本网站使用饼干以改善您的体验"
    docs = [(i, f"own words of {i}\nRead more\n{notice if i < 4 else '短'}\n\nRare{i % 11}", f"s{i}") for i in range(13)]
    got = {r.doc_id: r.text for r in remove_shared_lines(helpers.frame(spark, docs), min_words=3, short_sites=12).collect()}
    assert got[0] == docs[0][1] and got[2] == "own words of 2\n\nRare2"
    assert got[12] == "own words of 12\n短\n\nRare1"
    plain = {r.doc_id: r.text for r in remove_shared_lines(helpers.frame(spark, docs), min_words=3).collect()}
    assert plain == {i: t for i, t, _ in docs}


def test_line_dedup_looks_at_every_line(spark):
    docs = [(i, f"Privacy policy\nown words of {i}\n \n本网站", f"s{i}") for i in range(8)]
    docs += [(20 + i, "Three sites", f"s{i}") for i in range(3)]
    got = {r.doc_id: r.text for r in remove_shared_lines(helpers.frame(spark, docs)).collect()}
    assert got[0] == docs[0][1] and got[20] == got[22] == "Three sites"
    assert all(got[i] == f"own words of {i}\n " for i in range(1, 8))


@pytest.mark.parametrize("max_frequent", [0, 3, 100])
def test_line_dedup_by_broadcast_and_by_shuffle(spark, max_frequent):
    docs = [(i, "\n".join([f"own {i}", *(f"line {k} of all" for k in range(12) if i < 5 * (k + 1))]), f"s{i % 9}") for i in range(60)]
    got = {r.doc_id: r.text for r in remove_shared_lines(helpers.frame(spark, docs), max_frequent=max_frequent).collect()}
    assert got[0] == docs[0][1]
    assert all(got[i] == f"own {i}" for i in range(1, 60))


def test_line_dedup_of_very_long_texts_and_clashing_columns(spark):
    long = "\n".join(["shared by all", *(f"line {i}" for i in range(30_000)), "w " * 100_000])
    docs = helpers.frame(spark, [(i, f"{long}\n{i}" if i else "shared by all", f"s{i}") for i in range(4)])
    docs = docs.withColumn("_lines", F.lit(5)).withColumn("_keeper", F.lit(1)).withColumn("_h1", F.lit(2))
    got = remove_shared_lines(docs, stats=None).collect()
    assert {r.doc_id: len(r.text.split("\n")) for r in got} == {0: 1, 1: 30_003, 2: 2, 3: 2} or {
        r.doc_id: r._lines for r in got
    } == {i: 5 for i in range(4)}
    assert remove_shared_lines(docs).first()._lines.n_lines > 0


def test_line_dedup_many_sites_need_no_exact_count(spark):
    docs = [(i, f"a line of forty sites\nown words of {i}", f"s{i}") for i in range(40)]
    got = remove_shared_lines(helpers.frame(spark, docs)).collect()
    assert sum("forty" in r.text for r in got) == 1


def _family(seed, documents=60):
    rnd = random.Random(seed)
    out, vocabulary = [], [f"w{i}" for i in range(300)]
    for i in range(documents):
        if out and rnd.random() < 0.7:
            words = rnd.choice(out)[:]
            for _ in range(rnd.randint(0, 3)):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            if rnd.random() < 0.3:
                words = words + [rnd.choice(vocabulary) for _ in range(rnd.randint(1, 12))]
        else:
            words = [rnd.choice(vocabulary) for _ in range(rnd.randint(1, 120))]
        out.append(words)
    return [(i, " ".join(w).upper() if i % 5 == 0 else "  ".join(w)) for i, w in enumerate(out)]


@pytest.mark.parametrize("n, part, seed, task", [(3, 90, 1, 500_000), (5, 80, 2, 500_000), (3, 70, 3, 400), (2, 50, 4, 300)])
def test_ngram_groups_are_those_of_all_pairs(spark, n, part, seed, task):
    rows = _family(seed) + [(900, None), (901, ""), (902, " \t"), (903, "one two"), (904, "ONE two"), (905, "one")]
    got = ngram_groups(helpers.frame(spark, [(i, t, "s") for i, t in rows]), n=n, part=part, task_members=task)
    assert {r._id: (r.n_shingles, r.component_id) for r in got.collect()} == helpers.groups(rows, n, part, 100)


def test_ngram_groups_of_repeated_rows_and_null_ids(spark):
    text = "the same text is here more than once"
    docs = helpers.frame(spark, [(4, text, "s"), (4, text, "t"), (None, text, "s"), (None, "", "s"), (6, "other", None)])
    got = ngram_groups(docs).select("_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(4, 6, 4), (4, 6, 4), (None, 6, 4), (None, 0, None), (6, 1, 6)], key=repr)
    kept = one_per_group(docs).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == [(0, ""), (4, text), (6, "other")]
    assert kept[0]._row == 7
    assert one_per_group(docs.limit(0)).count() == 0


def test_one_per_group_keeps_a_document_of_each_component(spark):
    """Unlike documents with null or equal ids stay; copies of each go, with whatever id."""
    null, twice = ["first text without an id", "second one of these unlike texts"], ["alpha beta gamma delta", "some other words here now"]
    rows = [(None, null[0], "s"), (None, null[1], "s"), (None, null[1], "t"), (7, twice[0], "s"), (7, twice[1], "s")]
    rows += [(8, twice[0], "s"), (9, twice[1].upper(), "s"), (None, twice[1], "t"), (None, "", "s"), (7, "", "s")]
    kept = one_per_group(helpers.frame(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(0, ""), (7, ""), *((0, t) for t in null), *((7, t) for t in twice)])


def test_prefix_tree_links_are_all_links():
    rnd = random.Random(5)
    for _ in range(20):
        sets = []
        for _ in range(60):
            base = set(rnd.choice(sets).tolist()) if sets and rnd.random() < 0.6 else set()
            base |= {rnd.randrange(400) for _ in range(rnd.randint(0, 4) if base else rnd.randint(1, 40))}
            sets.append(np.array(sorted(base), dtype=np.uint64))
        for part in (60, 80, 90):
            def classes(edges):
                parent = list(range(60))
                def find(x):
                    while parent[x] != x:
                        x = parent[x]
                    return x
                for a, b in edges:
                    parent[find(a)] = find(b)
                return {frozenset(i for i in range(60) if find(i) == r) for r in {find(i) for i in range(60)}}

            every = [
                (a, b) for a in range(60) for b in range(a)
                if 100 * len(x := np.intersect1d(sets[a], sets[b])) >= part * (len(sets[a]) + len(sets[b]) - len(x))
            ]
            assert classes(links(sets, part, 100)) == classes(every)


@pytest.mark.parametrize("part", [50, 60, 66, 67, 80])
def test_linked_sets_share_a_key(part):
    from itertools import combinations

    sets = [np.array(c, dtype=np.uint64) for k in range(1, 8) for c in combinations(range(1, 8), k)]
    keys = [set(_keys(s, part, 100).tolist()) for s in sets]
    for (a, ka), (b, kb) in combinations(zip(sets, keys), 2):
        same = len(np.intersect1d(a, b))
        assert 100 * same < part * (len(a) + len(b) - same) or ka & kb, (a, b)


def test_unlike_texts_with_common_passages_share_no_key():
    """However many such texts there are, those without a like one are not moved."""
    rnd, words = random.Random(3), [f"w{i}" for i in range(2000)]
    passages = [" ".join(rnd.choices(words, k=12)) for _ in range(200)]
    texts = [" ".join(f"{rnd.choice(passages)} {' '.join(rnd.choices(words, k=6))}" for _ in range(12)) for _ in range(400)]
    shingles, none, seen = near.Shingler(3), np.zeros(0, dtype=np.uint64), {}
    for i, t in enumerate(texts):
        for k in _keys(near._ordered(shingles(t), none, none), 90, 100).tolist():
            seen.setdefault(k, set()).add(i)
    met = set().union(*(x for x in seen.values() if len(x) > 1))
    assert len(met) < 20


@pytest.mark.parametrize("loose", [0, 12])
def test_texts_of_a_large_block_are_sent_a_few_times(spark, monkeypatch, loose):
    """A group of like texts in 20 cuts, alone or in one block with texts that are not linked."""
    rnd, words, sent, put = random.Random(9), [f"w{i}" for i in range(900)], [], near.stored

    def stored(df, name):
        out = put(df, name)
        if name == "tasks":
            sent.append(out.count())
        return out

    monkeypatch.setattr(near, "stored", stored)
    monkeypatch.setattr(near, "_keys", lambda ordered, part, whole: np.ones(1, dtype=np.uint64))
    base, rows = rnd.choices(words, k=100), []
    for i in range(80):
        text = base[:]
        text[rnd.choice([0, 99])] = f"own{i}"
        rows.append((i, " ".join(text)))
    for i in range(loose):
        text = rnd.choices(words, k=100)
        rows += [(200 + 2 * i + k, " ".join([*text, *("more" for _ in range(k))])) for k in (0, 1)]
    got = ngram_groups(helpers.frame(spark, [(i, t, "s") for i, t in rows]), task_members=98 * len(rows) // 20 + 1)
    assert {r._id: (r.n_shingles, r.component_id) for r in got.collect()} == helpers.groups(rows, 3, 90, 100)
    assert sum(sent) <= (3 if not loose else 12) * len(rows)


@pytest.mark.parametrize("n, part, seed, task", [(3, 90, 11, 150), (5, 80, 12, 250), (1, 67, 13, 150), (3, 100, 14, 200)])
def test_ngram_groups_in_many_cuts_are_those_of_all_pairs(spark, n, part, seed, task):
    rows = _family(seed)
    got = ngram_groups(helpers.frame(spark, [(i, t, "s") for i, t in rows]), n=n, part=part, task_members=task)
    assert {r._id: (r.n_shingles, r.component_id) for r in got.collect()} == helpers.groups(rows, n, part, 100)


def test_components_that_do_not_end_are_an_error(spark, monkeypatch):
    from pairtables.llm import components as module

    monkeypatch.setattr(module, "MAX_ROUNDS", 1)
    with pytest.raises(RuntimeError):
        components(spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long"))


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 200), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 200: 100}
    assert components(edges.limit(0)).count() == 0


def test_ngram_groups_of_very_long_texts(spark):
    rnd = random.Random(8)
    long = [rnd.choice("abcdefghij") + str(rnd.randrange(5000)) for _ in range(150_000)]
    near, far = long[:], [w if k % 20 else "other" for k, w in enumerate(long)]
    for k in range(0, 150_000, 3000):
        near[k] = "changed"
    docs = helpers.frame(spark, [(3, " ".join(near), "s"), (1, " ".join(long), "s"), (2, " ".join(far), "s"), (4, "x" * 900_000, "s")])
    got = {r._id: (r.n_shingles, r.component_id) for r in ngram_groups(docs).collect()}
    sizes = {i: len(helpers.shingles(t, 3)) for i, t in ((1, " ".join(long)), (2, " ".join(far)), (3, " ".join(near)))}
    assert got == {1: (sizes[1], 1), 3: (sizes[3], 1), 2: (sizes[2], 2), 4: (1, 4)}
