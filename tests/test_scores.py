import itertools
import math
import random
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pairtables import fixed_values as fixed
from pairtables.functions.overlap import lcs_length, ngram_overlaps
from pairtables.operators import judge as ju, lexical as lx, metric_state as ms, report as rp
from pairtables.plans import evaluation as ev

SCHEMA = "record_id long, source string, targets string, outputs string"


def shared_ngrams(a, b, n):
    """Between other rows, so that rows must not be mixed up."""
    table = ngram_overlaps([b, a, a], [a, b, []], n)
    assert table[0].tolist() == table[1].tolist() and not table[2].any()
    return table[1, n - 1]


def slow_lcs(a, b):
    row = [0] * (len(a) + 1)
    for y in b:
        previous = 0
        for i, x in enumerate(a, 1):
            previous, row[i] = row[i], previous + 1 if x == y else max(row[i], row[i - 1])
    return row[-1]


words = st.lists(st.sampled_from("abcde"), max_size=40)


@settings(max_examples=300, deadline=None)
@given(words, words)
def test_lcs_against_the_table_method(a, b):
    assert lcs_length(a, b) == slow_lcs(a, b)


def test_lcs_of_long_texts():
    rng = random.Random(1)
    a = [str(rng.randrange(60)) for _ in range(900)]
    b = [w for w in a if rng.random() < 0.7] + [str(rng.randrange(60)) for _ in range(200)]
    assert lcs_length(a, b) == slow_lcs(a, b)


@settings(max_examples=200, deadline=None)
@given(words, words, st.integers(1, 4))
def test_shared_ngrams_against_removal_one_by_one(a, b, n):
    left = [tuple(a[i : i + n]) for i in range(len(a) - n + 1)]
    hits = 0
    for gram in (tuple(b[i : i + n]) for i in range(len(b) - n + 1)):
        if gram in left:
            left.remove(gram)
            hits += 1
    assert shared_ngrams(a, b, n) == hits


def frame(spark, rows):
    return spark.createDataFrame([(i, s, t, o) for i, (s, t, o) in enumerate(rows)], SCHEMA)


def test_rouge_by_hand(spark):
    df = frame(spark, [
        ("a", "the cat sat on the mat", "the the the cat"),
        ("a", "same words", "same words"),
        ("a", "one", "two"),
        ("a", "", "x"),
        ("a", "x", ""),
        ("a", None, "x"),
        ("a", "x", None),
    ])
    rows = lx.rouge_l(lx.rouge_n(df, 1, 2)).orderBy("record_id").collect()
    first = rows[0]
    assert first["rouge1_precision"] == pytest.approx(3 / 4) and first["rouge1_recall"] == pytest.approx(3 / 6)
    assert first["rouge1"] == pytest.approx(0.6)
    assert first["rouge2_precision"] == pytest.approx(1 / 3) and first["rouge2_recall"] == pytest.approx(1 / 5)
    assert first["rougeL_precision"] == pytest.approx(2 / 4) and first["rougeL_recall"] == pytest.approx(2 / 6)
    assert [rows[1][m] for m in ("rouge1", "rouge2", "rougeL")] == [1.0, 1.0, 1.0]
    for row in rows[2:5]:
        assert [row[m] for m in ("rouge1", "rouge2", "rougeL")] == [0.0, 0.0, 0.0]
    for row in rows[5:]:
        assert [row[m] for m in ("rouge1", "rouge2", "rougeL")] == [None, None, None]


def slow_bleu(pairs):
    hit, whole = Counter(), Counter()
    r = c = 0
    for target, output in pairs:
        t, o = target.split(), output.split()
        r, c = r + len(t), c + len(o)
        for n in range(1, 5):
            hit[n] += shared_ngrams(t, o, n)
            whole[n] += max(0, len(o) - n + 1)
    if not all(hit[n] for n in range(1, 5)):
        return 0.0
    brevity = 1.0 if c > r else math.exp(1 - r / c)
    return 100 * brevity * math.exp(sum(math.log(hit[n] / whole[n]) for n in range(1, 5)) / 4)


def test_bleu(spark):
    rng = random.Random(2)
    text = lambda k: " ".join(rng.choice("abc") for _ in range(k))
    rows = [("noisy", text(20), text(15 + i)) for i in range(8)]
    rows += [("same", x, x) for x in ("a b c d e", "f g h i j k")]
    rows += [("apart", "a b c d e", "v w x y z"), ("none", "a", None), ("short", "a b c d e f", "a b c d")]
    found = {r["source"]: r for r in lx.corpus_bleu(frame(spark, rows), ["source"]).collect()}
    for source in ("noisy", "same", "apart", "short"):
        pairs = [(t, o) for s, t, o in rows if s == source]
        assert found[source]["bleu"] == pytest.approx(slow_bleu(pairs))
    assert found["same"]["bleu"] == pytest.approx(100)
    assert (found["none"]["bleu"], found["none"]["n"]) == (None, 0)
    assert lx.corpus_bleu(frame(spark, rows)).count() == 1


def test_lexical_scores_agree_with_the_single_ones(spark):
    df = frame(spark, [("a", "a b c a b", "b a c b"), ("b", "x y", "y x y"), ("b", "q", None)])
    joint = lx.lexical_scores(df).orderBy("record_id").collect()
    single = lx.token_count(lx.rouge_l(lx.rouge_n(df, 1, 2))).orderBy("record_id").collect()
    for name in ("rouge1", "rouge2", "rougeL", "token_count"):
        assert [r[name] for r in joint] == [r[name] for r in single]


def test_parse_score(spark):
    cases = {"4": 4.0, " Score: 5/5": 5.0, "10": 1.0, "0/5": 5.0, "none": 3.0, "": 3.0, None: 3.0, "6 7 2": 2.0}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert [r[0] for r in df.select(ju.parse_score(F.col("t"))).collect()] == list(cases.values())


def test_judge_scores(spark):
    rows = spark.createDataFrame([(1,), (2,)], "record_id long")
    answers = spark.createDataFrame(
        [(1, "answer_correctness", "4"), (1, "answer_relevance", "no"), (1, "faithfulness", None)],
        "record_id long, metric string, response string",
    )
    found = [tuple(r) for r in ju.judge_scores(rows, answers).orderBy("record_id").collect()]
    assert found == [(1, 4.0, 3.0, 3.0, 2), (2, 3.0, 3.0, 3.0, 3)]


def test_repeated_judge_answers_need_an_order(spark):
    rows = spark.createDataFrame([(1,)], "record_id long")
    answers = spark.createDataFrame(
        [(1, "faithfulness", "5", 1), (1, "faithfulness", "2", 2)], "record_id long, metric string, response string, at int"
    )
    assert ju.judge_scores(rows, answers, order="at").first()["faithfulness"] == 2.0
    with pytest.raises(Exception, match="repeated answer"):
        ju.judge_scores(rows, answers).collect()


def test_an_empty_gate_stays_empty(spark):
    metrics = spark.createDataFrame([("s", "bleu", 1.0)], "source string, metric string, value double")
    assert rp.check_thresholds(metrics, {}).count() == 0


def test_judge_prompts(spark):
    df = spark.createDataFrame([(1, "q", "t", "o")], "record_id long, inputs string, targets string, outputs string")
    found = {r["metric"]: r["prompt"] for r in ju.judge_prompts(df).collect()}
    assert found == {m: fixed.PROMPTS[m].format(inputs="q", targets="t", outputs="o") for m in fixed.JUDGE_METRICS}


def test_gate(spark):
    metrics = spark.createDataFrame(
        [
            ("good", "rougeL", 0.35, 1), ("good", "bleu", 15.0, 1), ("good", "answer_correctness/v1/mean", 3.5, 1),
            ("good", "answer_relevance/v1/mean", 5.0, 1), ("good", "faithfulness/v1/mean", 4.0, 1),
            ("bad", "rougeL", 0.349, 1), ("bad", "bleu", 99.0, 1),
            ("none", "rouge1", 0.1, 1),
        ],
        "source string, metric string, value double, n int",
    )
    gate = rp.check_thresholds(metrics)
    status = {(r["source"], r["threshold_name"]): r["status"] for r in gate.collect()}
    assert {v for (s, _), v in status.items() if s == "good"} == {"PASS"}
    assert status["bad", "rougeL/v1/f1_score"] == "FAIL" and status["bad", "bleu_score/v1/scores"] == "PASS"
    assert status["bad", "faithfulness/v1/mean"] == "N/A"
    flags = {(r["source"], r["all_pass"], r["n_missing"]) for r in gate.collect()}
    assert flags == {("good", True, 0), ("bad", False, 3), ("none", True, 5)}
    summary = {r["source"]: r["summary"] for r in rp.source_summary(gate).collect()}
    assert summary == {"good": "ALL PASSED", "bad": "SOME FAILED", "none": "ALL PASSED"}


def test_evaluate_writes_scores_once(spark, tmp_path):
    df = frame(spark, [("a", "a b c d", "a b c d"), ("b", "a b c d", "d c b a")]).withColumn("inputs", F.lit("q"))
    answers = spark.createDataFrame([(0, "faithfulness", "5")], "record_id long, metric string, response string")
    metrics, gate, wide = ev.evaluate(df, answers, str(tmp_path / "scores"))
    assert metrics.count() == 16 and gate.count() == 10
    row = {r["source"]: r.asDict() for r in wide.collect()}
    assert row["a"]["bleu"] == pytest.approx(100) and row["b"]["bleu"] == 0
    assert row["a"]["faithfulness/v1/mean"] == 5.0 and row["b"]["rougeL"] == pytest.approx(0.25)
    again = ev.evaluate(df, answers)[0]
    key = ["source", "metric"]
    assert again.orderBy(key).collect() == metrics.orderBy(key).collect()


def test_sums_of_increments_equal_one_go(spark, tmp_path):
    texts = [("a", "a b c d e", "a b c d f"), ("a", "x y z u v w", "x y z u v"), ("b", "a b c d", "a b c d"), ("b", None, "q"), ("c", None, None)]
    df = frame(spark, texts * 3).withColumn("inputs", F.lit("q"))
    answers = spark.createDataFrame([(0, "faithfulness", "5"), (7, "relevance", "1")], "record_id long, metric string, response string")
    scored = ev.score_rows(df, answers)
    for part in ("record_id < 4", "record_id between 4 and 8", "record_id > 8", "record_id > 8"):
        got = ev.add_scores(scored.where(part), str(tmp_path / "sums"), part.replace(" ", ""))
    want = {(r["source"], r["metric"]): (r["value"], r["n"]) for r in ev.metrics_of(scored, ["source"]).collect()}
    found = {(r["source"], r["metric"]): (r["value"], r["n"]) for r in got.collect()}
    assert found.keys() == want.keys() and len(want) == 24
    for k, (value, n) in want.items():
        assert found[k] == (value if value is None else pytest.approx(value), n), k
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "bleu_stats" not in plan  # old rows are not read again


def test_a_state_without_groups_and_without_rows(spark, tmp_path):
    df = spark.createDataFrame([(1.0,), (None,), (4.0,)], "x double")
    state = lambda rows: ms.metric_state(rows, {"x": "x"})
    both = state(df).unionByName(state(df.limit(0))).unionByName(state(df.where("x = 4")))
    assert [tuple(r) for r in ms.means_of_state(both).collect()] == [("x", 3.0, 3)]
    assert [tuple(r) for r in ms.means_of_state(state(df.limit(0))).collect()] == [("x", None, 0)]


def test_metric_log_of_maps_and_json(spark):
    maps = spark.createDataFrame([(1, {"step": "5", "loss": "0.5", "note": "x", "none": None})], "run int, entry map<string,string>")
    assert [tuple(r) for r in rp.metrics_long(maps, "entry").collect()] == [(1, 5, "loss", 0.5)]
    texts = spark.createDataFrame(
        [(1, '{"step":5,"loss":0.5,"n":2,"big":1e3,"ok":true,"quoted":"7","none":null,"list":[1]}'), (2, '{"loss":1}'), (3, "bad")],
        "run int, entry string",
    )
    found = {tuple(r) for r in rp.metrics_long(texts, "entry").collect()}
    assert found == {(1, 5, "loss", 0.5), (1, 5, "n", 2.0), (1, 5, "big", 1000.0), (1, 5, "ok", 1.0), (2, None, "loss", 1.0)}


def test_custom_scorers(spark):
    import pandas as pd

    @F.pandas_udf("double")
    def longer(a: pd.Series, b: pd.Series) -> pd.Series:
        return (a.str.len() > b.str.len()).astype("float64")

    df = frame(spark, [("a", "ab", "abc"), ("a", "x", "x")])
    scored = rp.score(df, {"longer": longer("outputs", "targets"), "same": F.col("outputs") == F.col("targets")})
    assert [(r["longer"], r["same"]) for r in scored.orderBy("record_id").collect()] == [(1.0, False), (0.0, True)]


def test_sample_rows(spark):
    df = spark.range(100).withColumnRenamed("id", "record_id").repartition(7)
    assert [r[0] for r in rp.sample_rows(df).collect()] == [0, 1, 2]
    assert list(itertools.chain(*rp.sample_rows(df, 2).collect())) == [0, 1]


def test_words_of_a_whole_batch_are_not_held_at_once():
    import tracemalloc

    import pyarrow as pa

    from pairtables.functions.overlap import batch_counts

    def peak(n_rows):
        texts = pa.array([" ".join(f"w{i}" for i in range(300))] * n_rows)
        tracemalloc.start()
        counts = batch_counts(texts, texts, 2, True)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert counts.tolist() == [[300, 300, 300, 299, 300]] * n_rows
        return most

    assert peak(2000) < 2 * peak(100)


def test_pieces_of_a_batch():
    from pairtables.functions.overlap import _BYTES, _ROWS, pieces

    assert list(pieces([])) == []
    assert list(pieces([1] * (_ROWS + 1))) == [(0, _ROWS), (_ROWS, _ROWS + 1)]
    assert list(pieces([1, 2 * _BYTES, _BYTES, 1])) == [(0, 1), (1, 2), (2, 3), (3, 4)]


@settings(max_examples=300, deadline=None)
@given(words, words, st.integers(1, 9))
def test_lcs_in_strips_against_the_table_method(a, b, bits):
    assert lcs_length(a, b, bits) == slow_lcs(a, b)


def test_lcs_memory_does_not_grow_with_the_square_of_a_text():
    import tracemalloc

    a = [f"w{i}" for i in range(60000)]
    b = a[30000:] + a[:30000]
    tracemalloc.start()
    length = lcs_length(a, b)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert length == 30000
    assert most < 64 << 20
