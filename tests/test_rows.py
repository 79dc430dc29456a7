import hashlib
import math
import os
import random
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import Window, functions as F, types as T

from pairtables import schemas
from pairtables.operators import encode as en, generation as ge, infer, pairs as pa, position as po
from pairtables.operators import prefilter, progress as pr, split as sp, versions as ve
from pairtables.operators.lookup import lookup_join
from pairtables.plans.answers import fill_answers
from pairtables.plans.instructions import accepted_records, key_of, planned_requests
from pairtables.plans.training import training_rows
from pairtables.session import stored
from pairtables.sources import records, shard_index, tables
from pairtables.sources.upsert import consolidate_shards

# The executors cannot import this file.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def ids(df, column="record_id"):
    return sorted(r[column] for r in df.select(column).collect())


def numbered(spark, n, parts=5):
    return spark.range(n).select(F.col("id").alias("record_id")).repartition(parts)


# Split


def test_split_is_disjoint_complete_and_stable(spark):
    few, many = numbered(spark, 500), numbered(spark, 800, 3)
    train, test = sp.train_test_split(few)
    assert sorted(ids(train) + ids(test)) == list(range(500))
    assert ids(test) == [i for i in ids(sp.train_test_split(many)[1]) if i < 500]
    assert ids(test) == [i for i in range(500) if hashlib.md5(f"{i}:42".encode()).hexdigest() < "33333333"]
    assert ids(sp.train_test_split(few, seed=7)[1]) != ids(test)
    assert ids(sp.train_test_split(few, test_size=1.0)[1]) == list(range(500))
    assert ids(sp.train_test_split(few, test_size=0.0)[1]) == []


@pytest.mark.parametrize("n,size", [(1, 0.2), (7, 0.2), (503, 0.2), (503, 0.0), (503, 1.0), (64, 0.33)])
def test_exact_split(spark, n, size):
    hashes = sorted((hashlib.md5(f"{i}:42".encode()).hexdigest(), i) for i in range(n))
    wanted = sorted(i for _, i in hashes[: math.ceil(size * n)])
    train, test = sp.train_test_split(numbered(spark, n), test_size=size, exact=True)
    assert ids(test) == wanted and len(ids(train)) == n - len(wanted)


def test_split_by_text_keeps_copies_together(spark):
    df = numbered(spark, 300).withColumn("instruction", F.when(F.col("record_id") % 3 == 0, "hot").otherwise(F.col("record_id").cast("string")))
    for exact in (False, True):
        train, test = sp.train_test_split(df, key="instruction", exact=exact)
        assert {r[0] for r in train.select("instruction").collect()}.isdisjoint(r[0] for r in test.select("instruction").collect())
        assert train.count() + test.count() == 300
    nulls = numbered(spark, 10).withColumn("k", F.lit(None).cast("string"))
    train, test = sp.train_test_split(nulls, key="k")
    assert train.count() + test.count() == 10


# Position


@pytest.mark.parametrize("rows_per_bucket", [1, 3, 50, 10_000])
def test_positions_do_not_depend_on_ranges(spark, rows_per_bucket):
    rng = random.Random(3)
    keys = sorted(rng.sample(range(-(10**12), 10**12), 400) + list(range(1000, 1200)))
    df = spark.createDataFrame([(k,) for k in keys], "record_id long").repartition(7)
    batches = po.with_batches(df, batch_size=7, rows_per_bucket=rows_per_bucket).orderBy("record_id").collect()
    assert [r["record_id"] for r in batches] == keys
    assert [r["position"] for r in batches] == list(range(600))
    assert [(r["batch"], r["batch_start"], r["batch_end"]) for r in batches] == [
        (i // 7, i // 7 * 7, min(i // 7 * 7 + 7, 600)) for i in range(600)
    ]


def test_positions_of_text_keys_and_empty_tables(spark):
    keys = sorted({f"k{i * 7919 % 1000}" for i in range(400)})
    df = spark.createDataFrame([(k,) for k in keys], "record_id string").repartition(4)
    found, n = po.with_positions(df, rows_per_bucket=5)
    assert [r["record_id"] for r in found.orderBy("position").collect()] == keys and n == len(keys)
    empty = df.where("false")
    assert po.with_batches(empty).count() == 0


def test_many_ranges_use_two_steps(spark):
    df = numbered(spark, 3000)
    bounds = list(range(5, 3000, 10))
    key = F.col("record_id")
    found = df.select(key, po._bucket(key, bounds, T.LongType()).alias("b")).collect()
    assert len({r["b"] for r in found}) == len(bounds) + 1
    ordered = [r["b"] for r in sorted(found)]
    assert ordered == sorted(ordered)
    assert all(len({r["b"] for r in found if lo <= r[0] < lo + 10}) == 1 for lo in bounds[:20])


@pytest.mark.parametrize("most", [1, 2, 5])
def test_positions_of_more_rows_than_the_ranges_are_meant_for(spark, monkeypatch, most):
    monkeypatch.setattr(po, "MAX_BUCKETS", most)
    df = numbered(spark, 700).withColumn("record_id", F.col("record_id") * 3 - 50)
    found, n = po.with_positions(df, rows_per_bucket=10)
    assert n == 700 and sorted((r["record_id"], r["position"]) for r in found.collect()) == [(3 * i - 50, i) for i in range(700)]


def test_slice_rows(spark):
    df = spark.range(0, 200, 2).withColumnRenamed("id", "record_id").repartition(6)
    assert ids(po.slice_rows(df, 10, 13, rows_per_bucket=9)) == [20, 22, 24]
    assert ids(po.slice_rows(df, 98, 500)) == [196, 198]


def test_slices_with_a_null_key_and_empty_ones(spark):
    df = spark.createDataFrame([(i if i else None, "t" * i) for i in range(40)], "record_id long, text string").repartition(3)
    for start, end in ((0, 3), (0, 1), (5, 5), (38, 90), (40, 50)):
        got = sorted((r["position"], len(r["text"])) for r in po.slice_rows(df, start, end, rows_per_bucket=7).collect())
        assert got == [(i, i) for i in range(start, min(end, 40))]


def test_ranges_are_even_in_bytes(spark):
    """Long texts lie together at one end of the keys; no range gets more than twice its share."""
    wide = "w " * 20_000
    df = spark.range(4000).select(
        F.col("id").alias("record_id"), F.when(F.col("id") < 200, F.lit(wide)).otherwise("w").alias("text")
    )
    weighted = df.select("record_id", po._row_bytes(df).alias("_weight"))
    total = weighted.agg(F.sum("_weight")).first()[0]
    bounds = po._bounds(weighted, "record_id", total, 20)
    bucket = po._bucket(F.col("record_id"), bounds, T.LongType())
    sizes = [r[1] for r in weighted.groupBy(bucket.alias("b")).agg(F.sum("_weight")).collect()]
    assert len(sizes) >= 15 and max(sizes) < 2 * total / 20
    found, n = po.with_positions(df, bytes_per_bucket=total // 20, rows_per_bucket=3000)
    assert n == 4000 and found.where("position <> record_id").count() == 0


# Lookup joins, hot keys


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot_rows", [0, 50, 10**6])
def test_lookup_join_past_the_bound_gives_the_same_rows(spark, how, hot_rows):
    left = numbered(spark, 600).withColumn("k", F.when(F.col("record_id") % 3 == 0, 0).otherwise(F.col("record_id") % 50))
    left = left.withColumn("k", F.when(F.col("record_id") == 7, None).otherwise(F.col("k")))
    right = spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    small = lookup_join(left, right, ["k"], "record_id", how)
    large = lookup_join(left, right, ["k"], "record_id", how, max_rows=0, hot_rows=hot_rows)
    assert "Broadcast" in small._jdf.queryExecution().toString()
    assert sorted(map(repr, small.collect())) == sorted(map(repr, large.select(small.columns).collect()))


def test_hot_keys_are_spread_over_tasks(spark):
    left = numbered(spark, 3000).withColumn("k", F.when(F.col("record_id") < 1000, "hot").otherwise(F.col("record_id").cast("string")))
    right = left.select("k").distinct().withColumn("v", F.lit(1))
    joined = lookup_join(left, right, ["k"], "record_id", max_rows=0, hot_rows=100)
    assert joined.count() == 3000 and joined.where("v is null").count() == 0
    plain = left.repartition(16, "k").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    salted = left.withColumn("s", F.when(F.col("k") == "hot", F.pmod(F.xxhash64("record_id"), F.lit(16))).otherwise(0))
    spread = salted.repartition(16, "k", "s").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert plain >= 1000 and spread < 600


# Pairs


def dual(spark):
    return spark.createDataFrame(
        [(1, "q1", None, "g"), (2, "q2", "  ", ""), (3, "q3", "keep", "keep"), (4, " ", None, None), (5, None, None, "x")],
        "record_id long, instruction string, gpt_output string, gemini_output string",
    )


def test_select_source_names_the_columns_it_has(spark):
    assert pa.select_source(dual(spark), "gpt_output").columns == ["record_id", "instruction", "output"]
    with pytest.raises(ValueError, match="no column 'other'.*gemini_output"):
        pa.select_source(dual(spark), "other")


def test_blank_rows_pass_through(spark):
    full, blank = pa.split_blank(dual(spark))
    assert ids(full) == [1, 2, 3] and ids(blank) == [4, 5]


def test_repeated_answers_need_an_order(spark):
    answers = spark.createDataFrame(
        [(1, "gpt_output", "b", 1), (1, "gpt_output", "a", 2)], "record_id long, provider string, response string, at int"
    )
    filled = pa.fill_missing(dual(spark), answers, order="at").where("record_id = 1").first()
    assert filled["gpt_output"] == "a"
    with pytest.raises(Exception, match="repeated answer"):
        pa.fill_missing(dual(spark), answers).collect()


def test_pending_and_fill(spark):
    pending = pa.pending_outputs(dual(spark))
    found = sorted((r["record_id"], r["provider"]) for r in pending.collect())
    assert found == [(1, "gpt_output"), (2, "gemini_output"), (2, "gpt_output")]
    answers = spark.createDataFrame(
        [(1, "gpt_output", "new"), (2, "gpt_output", None), (2, "gemini_output", "new"), (3, "gpt_output", "no"), (4, "gpt_output", "no")],
        "record_id long, provider string, response string",
    )
    filled = pa.fill_missing(dual(spark), answers)
    assert filled.columns == dual(spark).columns
    assert [tuple(r)[2:] for r in filled.orderBy("record_id").collect()] == [
        ("new", "g"), ("  ", "new"), ("keep", "keep"), (None, None), (None, "x"),
    ]


def test_long_conversations_come_in_parts(spark):
    turns = spark.createDataFrame([(1, t, "user", f"m{t}") for t in range(25)] + [(2, 0, "user", "z")], schemas.CONVERSATIONS)
    rows = pa.assemble_messages(turns.repartition(5), turns_per_row=10).orderBy("conv_id", "part").collect()
    assert [(r["conv_id"], r["part"], r["n_parts"], [m["content"] for m in r["messages"]]) for r in rows] == [
        (1, 0, 3, [f"m{t}" for t in range(10)]), (1, 1, 3, [f"m{t}" for t in range(10, 20)]),
        (1, 2, 3, [f"m{t}" for t in range(20, 25)]), (2, 0, 1, ["z"]),
    ]


def test_turns_are_ordered_without_gaps_at_any_length(spark):
    turns = [(1, 3 * t + 5, "user", f"m{t}") for t in range(40)] + [(None, 9, "user", "y"), (None, 2, "user", "x")]
    df = spark.createDataFrame(turns, schemas.CONVERSATIONS).repartition(5)
    for block in (1, 7, 1000):
        rows = pa.ordered_turns(df, turns_per_block=block).collect()
        assert sorted((r["position"], r["content"]) for r in rows if r["conv_id"] == 1) == [(t, f"m{t}") for t in range(40)]
        assert sorted((r["position"], r["content"]) for r in rows if r["conv_id"] is None) == [(0, "x"), (1, "y")]


def test_concat_of_nothing_and_of_different_columns(spark):
    assert pa.concat_all([], schemas.METRICS).schema == schemas.METRICS
    both = pa.concat_all([numbered(spark, 2), numbered(spark, 2).withColumn("x", F.lit(1))])
    assert both.count() == 4 and both.where("x is null").count() == 2


def test_progress_counts_white_space_as_an_answer(spark):
    row = pr.batch_progress(dual(spark).withColumn("batch", F.lit(0))).first()
    assert tuple(row) == (0, 2, 3, 5)


# Calls


def flaky(prompts):
    if "bad" in prompts:
        raise RuntimeError("no")
    return [p.upper() for p in prompts]


def test_a_failure_stays_with_its_row(spark):
    texts = [f"p{i}" for i in range(24)] + ["bad"]
    df = spark.createDataFrame(list(enumerate(texts)), "record_id long, prompt string").repartition(3)
    found = {r["record_id"]: (r["response"], r["error"]) for r in infer.batch_infer(df, flaky, batch_size=4).collect()}
    assert found.pop(24) == (None, "RuntimeError: no")
    assert found == {i: (f"P{i}", None) for i in range(24)}


def test_calls_hold_at_most_a_batch_and_must_answer_all(spark):
    df = numbered(spark, 50, 1).withColumn("prompt", F.lit("x"))
    sizes = infer.batch_infer(df, lambda ps: [str(len(ps))] * len(ps), batch_size=8)
    assert {r["response"] for r in sizes.collect()} == {"8", "2"}
    short = infer.batch_infer(df, lambda ps: [], batch_size=8)
    assert all(r["error"].startswith("ValueError") for r in short.collect())


def test_calls_in_flight_give_the_same_answers(spark):
    df = numbered(spark, 60, 2).withColumn("prompt", F.concat(F.lit("p"), F.col("record_id").cast("string")))
    df = df.unionByName(spark.createDataFrame([(60, "bad")], df.schema))
    one, five = [infer.batch_infer(df, flaky, batch_size=4, in_flight=n, wait=0.01, tries=2).collect() for n in (1, 5)]
    assert sorted(one) == sorted(five) and len(one) == 61


def test_a_hanging_call_is_an_error_of_its_row(spark):
    def hangs(prompts):
        if "p7" in prompts:
            time.sleep(600)
        return prompts

    df = numbered(spark, 20, 2).withColumn("prompt", F.concat(F.lit("p"), F.col("record_id").cast("string")))
    began = time.monotonic()
    found = {r[0]: (r[1], r[2]) for r in infer.batch_infer(df, hangs, in_flight=3, seconds=0.5, tries=1).collect()}
    assert time.monotonic() - began < 60
    assert found.pop(7) == (None, "TimeoutError: no answer in 0.5 s")
    assert found == {i: (f"p{i}", None) for i in range(20) if i != 7}


def test_calls_are_made_again_after_a_pause(tmp_path, spark):
    log = str(tmp_path / "log")

    def busy(prompts):
        with open(log, "a") as f:
            f.write("x")
        if os.path.getsize(log) < 3:
            raise ConnectionError("busy")
        return prompts

    df = spark.createDataFrame([(1, "a")], "record_id long, prompt string")
    assert infer.batch_infer(df, busy, tries=3, wait=0.01).first()["response"] == "a"


def test_stored_answers_are_not_asked_for_again(spark, tmp_path):
    log, path = tmp_path / "log", str(tmp_path / "answers")

    def logged(prompts):
        with open(log, "a") as f:
            f.write("".join(f"{p}\n" for p in prompts))
        return flaky(prompts)

    df = numbered(spark, 40, 2).withColumn("prompt", F.concat(F.lit("p"), F.col("record_id").cast("string")))
    odd = [(50, "bad"), (None, "null key"), (60, "twice b"), (60, "twice a"), (70, None)]
    df = df.unionByName(spark.createDataFrame(odd, "record_id long, prompt string")).withColumn("_0", F.lit("x"))
    run = lambda rows: infer.infer_by_chunk(rows, logged, path, rows_per_chunk=9, rows_per_task=4, batch_size=1, in_flight=3)
    run(df.where("record_id < 20"))
    found = {r[0]: (r[1], r[2]) for r in run(df).collect()}
    assert found == {i: (f"P{i}", None) for i in range(40)} | {
        50: (None, "RuntimeError: no"), None: ("NULL KEY", None), 60: ("TWICE A", None)
    }
    assert sorted(log.read_text().split("\n")[:-1]) == sorted([f"p{i}" for i in range(40)] + ["bad", "null key", "twice a"])
    log.write_text("")
    assert run(df.where("record_id < 10")).count() == 10 and run(df).count() == 43
    assert log.read_text() == "bad\n"  # errors are tried again, answers are not
    assert run(df.limit(0)).count() == 0


def test_map_batches(spark):
    found = infer.map_batches(numbered(spark, 5), lambda pdf: pdf.assign(twice=pdf["record_id"] * 2), "record_id long, twice long")
    assert sorted(map(tuple, found.collect())) == [(i, 2 * i) for i in range(5)]


def test_fill_answers_end_to_end(spark, tmp_path):
    models = {"gpt_output": lambda ps: [f" {p}! " for p in ps], "gemini_output": flaky}
    df = dual(spark).unionByName(spark.createDataFrame([(6, "bad", "x", None)], dual(spark).schema))
    done = spark.createDataFrame([(3,)], "record_id long")
    out = fill_answers(df, models, str(tmp_path / "answers"), done)
    found = {r["record_id"]: tuple(r)[2:] for r in out.collect()}
    assert found == {
        1: ("instruction:q1!", "g", 0.2, 400), 2: ("instruction:q2!", "INSTRUCTION: Q2", 0.2, 400),
        4: (None, None, 0.2, 400), 5: (None, "x", 0.2, 400), 6: ("x", "INSTRUCTION: BAD", 0.2, 400),
    }


def test_filling_goes_on_where_it_stopped(spark, tmp_path):
    log = str(tmp_path / "log")

    def logged(prompts):
        with open(log, "a") as f:
            f.write("".join(f"{p}\n" for p in prompts))
        return flaky(prompts)

    models, path = {"gpt_output": logged, "gemini_output": logged}, str(tmp_path / "answers")
    df = dual(spark).unionByName(spark.createDataFrame([(6, "bad", "x", None)], dual(spark).schema))
    fill_answers(df.where("record_id < 2"), models, path, in_flight=5, seconds=30.0)
    first = len(open(log).read().splitlines())
    rows = sorted(map(repr, fill_answers(df, models, path, in_flight=5, seconds=30.0).collect()))
    asked = open(log).read().splitlines()
    assert first and len(asked) > first and len(set(asked)) == len(asked)
    assert rows == sorted(map(repr, fill_answers(df, models, str(tmp_path / "again")).collect()))


# Records


GOOD = '{"model":"m","topic":"t","instruction":"i","temperature":0.2}'


def test_validate_records(spark):
    bad = [
        '{"model":1,"topic":"t","instruction":"i","temperature":0.2}', '{"model":"m","instruction":"i","temperature":0.2}',
        '{"model":"m","topic":"t","instruction":null,"temperature":0.2}', '{"model":"m","topic":"t","instruction":"i","temperature":"hot"}',
        '{"model":"m","topic":"t","instruction":"i"}', "null",
    ]
    texts = [f'{{"records":[{GOOD},{GOOD.replace("0.2", "1")}]}}', f'{{"records":[{",".join([GOOD, *bad])}]}}', '{"records":[]}', "{}", "oops", None,
             f'{{"records":[{GOOD.replace("0.2", chr(34) + "0.5" + chr(34))}]}}']
    df = spark.createDataFrame(list(enumerate(texts)), "record_id long, response string")
    rows = records.validate_records(df, "response", whole_response=False)
    valid, rejected = records.valid_records(rows), records.rejects(rows)
    assert set(rejected.columns) == {"record_id", "pos", "rejected", "reason"}
    assert sorted((r["record_id"], r["pos"], r["temperature"]) for r in valid.collect()) == [(0, 0, 0.2), (0, 1, 1.0), (1, 0, 0.2), (6, 0, 0.5)]
    reasons = sorted((r["record_id"], -1 if r["pos"] is None else r["pos"], r["reason"]) for r in rejected.collect())
    assert reasons == [
        (1, 1, "model is not text"), (1, 2, "topic is not text"), (1, 3, "instruction is not text"),
        (1, 4, "temperature is not a number"), (1, 5, "temperature is not a number"), (1, 6, "not an object"),
        (3, -1, "no list of records"), (4, -1, "no list of records"), (5, -1, "no list of records"),
    ]
    rows = records.validate_records(df, "response")
    valid, rejected = records.valid_records(rows), records.rejects(rows)
    assert ids(valid) == [0, 0, 6] and ids(rejected) == [1, 3, 4, 5]
    accepted, _ = accepted_records(df)
    assert accepted.count() == 1 and set(accepted.columns) >= {"record_id", "topic", "temperature"}


# Generation


def test_plan_covers_the_shortfall(spark):
    made = spark.createDataFrame([("a",)] * 30 + [("b",)] * 60, "topic string")
    targets = spark.createDataFrame([("a", 51), ("b", 50), ("c", 1)], "topic string, target int")
    cover = {r["topic"]: tuple(r)[1:] for r in ge.topic_coverage(made, targets).collect()}
    assert cover == {"a": (30, 51, 21), "b": (60, 50, 0), "c": (0, 1, 1)}
    plan = ge.generation_plan(ge.topic_coverage(made, targets), ["p", "q"], 10)
    assert sorted((r["topic"], r["round"], r["model"]) for r in plan.collect()) == [
        ("a", 1, "p"), ("a", 1, "q"), ("a", 2, "p"), ("a", 2, "q"), ("c", 1, "p"), ("c", 1, "q"),
    ]
    asked = planned_requests(made, targets, ["p"], 10).where("topic = 'c'").first()
    assert asked["prompt"] == "batch_size:10 , topic:c, model:p, max_tokens:400, temperature:0.2"
    again = planned_requests(made, targets, ["p"], 10, planning=2).where("topic = 'c'").first()
    assert again["record_id"] != asked["record_id"] and len(asked["record_id"]) == 32
    topics = spark.createDataFrame([("x y, z",)], "topics string")
    assert [r[0] for r in ge.split_topics(topics).collect()] == ["x y", "z"]


def test_plan_of_a_shortfall_beyond_32_bits(spark, monkeypatch):
    monkeypatch.setattr(ge, "_ROUNDS_PER_ROW", 7)
    topics = spark.createDataFrame([("a", 10**11), ("b", 95)], "topic string, shortfall long")
    plan = ge.generation_plan(topics.where("topic = 'b'"), ["p"], 10).collect()
    assert sorted(r["round"] for r in plan) == list(range(1, 11))
    blocks = ge.generation_plan(topics, ["p"], 10**9)
    assert blocks.where("topic = 'a'").count() == 100


def test_keys_tell_fields_apart(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "c"), ("-", "c"), ("", "c")], "x string, y string")
    assert df.select(key_of("x", "y").alias("k")).distinct().count() == 5


def test_cap_of_rows_without_a_topic_and_of_nothing(spark):
    df = numbered(spark, 90).withColumn("topic", F.when(F.col("record_id") % 3 > 0, "t"))
    capped = ge.cap_per_topic(df, 4)
    rank = F.row_number().over(Window.partitionBy("topic").orderBy(F.md5(F.col("record_id").cast("string"))))
    assert ids(capped) == ids(df.withColumn("r", rank).where("r <= 4"))
    assert capped.where("topic is null").count() == 4
    assert ge.cap_per_topic(df, 0).count() == 0 and ge.cap_per_topic(df, 0).columns == df.columns


@pytest.mark.parametrize("rows_per_range", [4, 16, 65_536])
@pytest.mark.parametrize("target", [1, 17, 300, 5000])
def test_cap_per_topic_of_a_hot_topic(spark, monkeypatch, rows_per_range, target):
    monkeypatch.setattr(ge, "_ROWS_PER_RANGE", rows_per_range)
    df = numbered(spark, 900).withColumn("topic", F.when(F.col("record_id") % 3 == 0, "hot").otherwise((F.col("record_id") % 29).cast("string")))
    groups = {}
    for i in range(900):
        groups.setdefault("hot" if i % 3 == 0 else str(i % 29), []).append((hashlib.md5(str(i).encode()).hexdigest(), i))
    wanted = sorted(i for rows in groups.values() for _, i in sorted(rows)[:target])
    assert ids(ge.cap_per_topic(df, target)) == wanted


# Versions


def test_latest_and_retention(spark):
    rows = [("a", str(v), "Production") for v in (9, 10, 2, 100)] + [("b", "1", "None"), ("c", "x", "None"), ("c", "3", "None")]
    rows += [("hot", str(v), "None") for v in range(500)]
    df = spark.createDataFrame(rows, "name string, version string, stage string").repartition(5)
    latest = {r["name"]: r["latest"] for r in ve.latest_version(df).collect()}
    assert latest == {"a": 100, "b": 1, "c": 3, "hot": 499}
    kept = ve.retain_versions(df, 2)
    live = sorted((r["name"], r["version"]) for r in kept.where("stage <> 'Archived'").collect())
    assert live == [("a", "10"), ("a", "100"), ("b", "1"), ("c", "3"), ("c", "x"), ("hot", "498"), ("hot", "499")]
    assert kept.count() == df.count()
    many = ve.retain_versions(df, 400).where("stage = 'Archived'")
    assert sorted(int(r["version"]) for r in many.collect()) == list(range(100))


def test_retention_of_large_equal_and_nameless_versions(spark):
    rows = [("big", v, "P") for v in ("3000000000", "5", "4", "3")] + [("tie", v, "P") for v in ("2", "x", "y", "z")]
    rows += [(None, v, "P") for v in ("1", "2", "3")] + [("same", "7", "P"), ("same", "07", "P"), ("same", "007", "P")]
    df = spark.createDataFrame(rows, "name string, version string, stage string").repartition(3)
    number = F.coalesce(F.col("version").try_cast("bigint"), F.lit(-1))
    rank = F.row_number().over(Window.partitionBy("name").orderBy(number.desc(), F.desc("version")))
    for keep in (1, 2, 3):
        want = df.withColumn("r", rank).where(F.col("r") <= keep).select("name", "version").collect()
        live = ve.retain_versions(df, keep).where("stage = 'P'").select("name", "version").collect()
        assert sorted(map(repr, live)) == sorted(map(repr, want))
    assert {r["name"]: r["latest"] for r in ve.latest_version(df).collect()}["big"] == 3_000_000_000


def test_resolve_endpoint(spark):
    served = spark.createDataFrame(
        [("e1", "a", "1"), ("e2", "a", "3"), ("e3", "a", "latest"), ("e0", "a", "3"), ("e5", "b", None)],
        "endpoint string, entity_name string, entity_version string",
    )
    asked = spark.createDataFrame([(1, "a", 1), (2, "a", 3), (3, "a", 2), (4, "b", 9), (5, "c", 1)], "request_id int, name string, version int")
    found = {r["request_id"]: (r["endpoint"], r["error"]) for r in ve.resolve_endpoint(asked, served).collect()}
    assert found == {1: ("e1", None), 2: ("e0", None), 3: ("e0", None), 4: ("e5", None), 5: (None, "no endpoint serves c")}


# Encoding


def test_encode_pads_cuts_and_keeps_order(spark):
    df = spark.createDataFrame([(1, "b a b c"), (2, ""), (3, None), (4, "a " * 9), (5, "zz b")], "record_id long, text string")
    vocab = en.build_vocab(df.where("record_id < 5"), 2)
    assert [(r["token"], r["id"]) for r in vocab.orderBy("id").collect()] == [("a", 2), ("b", 3)]
    rows = {r["record_id"]: r for r in en.encode(df, vocab, max_len=6).collect()}
    assert rows[1]["input_ids"] == [3, 2, 3, 1, 0, 0] and rows[1]["attention_mask"] == [1, 1, 1, 1, 0, 0]
    assert rows[2]["input_ids"] == rows[3]["input_ids"] == [0] * 6
    assert rows[4]["input_ids"] == [2] * 6 and rows[4]["truncated"] and not rows[1]["truncated"]
    assert all(r["labels"] == r["input_ids"] for r in rows.values()) and rows[5]["input_ids"][:2] == [1, 3]


@pytest.mark.parametrize("hot_rows", [2, 10**6])
def test_encoding_with_a_large_vocabulary_gives_the_same_rows(spark, monkeypatch, hot_rows):
    df = spark.createDataFrame([(i, " ".join(f"w{(i * k) % 11}" for k in range(i % 9))) for i in range(60)] + [(99, None)], "record_id long, text string")
    vocab = en.build_vocab(df, 6)
    joined = en._joined_ids
    monkeypatch.setattr(en, "_joined_ids", lambda cut, vocab: joined(cut, vocab, hot_rows))
    for bound in ({"max_words": 2}, {"max_bytes": 3}):
        assert sorted(map(repr, en.encode(df, vocab, max_len=5, **bound).collect())) == sorted(map(repr, en.encode(df, vocab, max_len=5).collect()))
    empty = en.encode(df, vocab.where("false"), max_len=5).where("record_id = 8").first()
    assert empty["input_ids"] == [1] * 5


def test_training_rows(spark):
    df = dual(spark).where("record_id < 4").withColumn("record_id", F.col("record_id") * 11)
    train, test = training_rows(df, "gpt_output", 50, max_len=12, exact=True)
    assert train.count() + test.count() == 2 and test.count() == 1
    assert train.columns == ["record_id", "input_ids", "attention_mask", "labels", "truncated"]


# Tables


def test_resume_after_any_shards_gives_the_same_table(spark, tmp_path):
    df = dual(spark).unionByName(dual(spark).withColumn("record_id", F.col("record_id") + 10))
    finished = df.withColumn("gpt_output", F.lit("done"))
    tables.write_shards(finished, str(tmp_path / "all"), batch_size=3, rows_per_bucket=2)
    schema = T.StructType(df.schema.fields)
    names = sorted({r["shard"] for r in tables.read_shards(spark, str(tmp_path / "all"), schema).select("shard").collect()})
    assert names == ["batch-0000000-0000003", "batch-0000003-0000006", "batch-0000006-0000009", "batch-0000009-0000010"]
    for i, kept in enumerate([[], names[1:2], names[::2], names]):
        done = tables.read_shards(spark, str(tmp_path / "all"), schema).where(F.col("shard").isin(kept)).drop("shard")
        new = pa.pending_rows(finished, done)
        table = tables.consolidate(done, new, str(tmp_path / f"train{i}"))
        assert sorted(map(repr, table.select(df.columns).collect())) == sorted(map(repr, finished.collect()))


def test_shards_of_several_runs_are_those_of_one(spark, tmp_path):
    df = dual(spark).unionByName(dual(spark).withColumn("record_id", F.col("record_id") + 10))
    read = lambda root: tables.read_shards(spark, root, T.StructType(df.schema.fields))
    one, several = str(tmp_path / "one"), str(tmp_path / "several")
    tables.write_shards(df, one, 3, rows_per_bucket=2)
    tables.write_shards(df, several, 3, rows_per_bucket=2, only=F.col("shard").endswith("6"))
    first = {f for f in (tmp_path / "several").rglob("part-*")}
    assert ids(read(several)) == [4, 5, 11]
    tables.write_shards(df, several, 3, rows_per_bucket=2)
    tables.write_shards(df, several, 3, rows_per_bucket=2)
    assert sorted(map(repr, read(one).collect())) == sorted(map(repr, read(several).collect()))
    assert first <= {f for f in (tmp_path / "several").rglob("part-*")}


def test_resumed_run_writes_scattered_shards(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "MAX_RANGES", 2)
    df = numbered(spark, 200).withColumn("text", F.concat(F.lit("t"), F.col("record_id").cast("string")))
    df = df.unionByName(df.limit(1).withColumn("record_id", F.lit(None).cast("long")))
    root = str(tmp_path / "t")
    tables.write_shards(df, root, 7, rows_per_bucket=20, only=F.xxhash64("shard") % 3 == 0)
    part = tables.read_shards(spark, root, T.StructType(df.schema.fields)).count()
    assert 0 < part < 201
    tables.write_shards(df, root, 7, rows_per_bucket=20)
    got = tables.read_shards(spark, root, T.StructType(df.schema.fields))
    assert sorted(map(repr, got.select(df.columns).collect())) == sorted(map(repr, df.collect()))
    wanted = tables.with_shards(df, 7, rows_per_bucket=20)
    assert got.select("record_id", "shard").exceptAll(wanted.select("record_id", "shard")).isEmpty()


def test_shard_index(spark, tmp_path):
    df = numbered(spark, 60).withColumn("text", F.lit("t"))
    root, schema = str(tmp_path / "t"), T.StructType(df.schema.fields)
    key = schema["record_id"]
    tables.write_shards(df, root, 10, only=F.col("shard") < "batch-0000030")
    assert shard_index.index_shards(spark, root, key).count() == 3
    tables.write_shards(df, root, 10)
    for _ in range(2):
        index = shard_index.index_shards(spark, root, key).orderBy("start").collect()
        assert [tuple(r) for r in index] == [
            (f"batch-{i:07d}-{i + 10:07d}", i, i + 9, 10, i) for i in range(0, 60, 10)
        ]
    for start, end in ((0, 60), (12, 18), (9, 11), (55, 99), (60, 70)):
        rows = shard_index.read_slice(spark, root, schema, start, end)
        assert sorted((r["record_id"], r["position"]) for r in rows.collect()) == [(i, i) for i in range(start, min(end, 60))]
    assert ids(shard_index.read_keys(spark, root, schema, 18, 21)) == [18, 19, 20, 21]
    assert "PartitionFilters" in str(one := shard_index.read_slice(spark, root, schema, 12, 18)._jdf.queryExecution().executedPlan())
    assert "batch-0000010-0000020" in str(one).split("PartitionFilters: ")[1].split("PushedFilters")[0]
    df.where("record_id = 15").write.parquet(f"{root}/shard=batch-9-0")
    shard_index.index_shards(spark, root, key)
    with pytest.raises(ValueError, match="share a range"):
        shard_index.read_slice(spark, root, schema, 0, 60)


def test_a_slice_opens_only_its_shards(spark, tmp_path):
    df = numbered(spark, 60).withColumn("text", F.lit("t"))
    root, schema = tmp_path / "t", T.StructType(df.schema.fields)
    tables.write_shards(df, str(root), 10)
    shard_index.index_shards(spark, str(root), schema["record_id"])
    for file in root.glob("shard=*/part-*.parquet"):  # other shards cannot be read any more
        if "batch-0000010" not in str(file):
            file.write_bytes(b"no parquet")
            (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    assert ids(shard_index.read_slice(spark, str(root), schema, 12, 18)) == list(range(12, 18))
    assert ids(shard_index.read_keys(spark, str(root), schema, 12, 18)) == list(range(12, 19))


def test_consolidate_prefers_new_rows_and_never_overwrites(spark, tmp_path):
    old = dual(spark)
    new = old.where("record_id = 1").withColumn("gpt_output", F.lit("new"))
    copies = new.unionByName(new).unionByName(new)
    table = tables.consolidate(old.unionByName(old), copies, str(tmp_path / "t"))
    assert ids(table) == [1, 2, 3, 4, 5] and table.where("record_id = 1").first()["gpt_output"] == "new"
    with pytest.raises(Exception, match="(?i)exist"):
        tables.consolidate(old, new, str(tmp_path / "t"))


def files_of(root):
    return {str(f) for f in root.rglob("part-*.parquet") if "_index" not in str(f)}


def test_consolidation_in_place_keeps_unchanged_files(spark, tmp_path):
    df = numbered(spark, 100).withColumn("text", F.lit("old"))
    root, schema = tmp_path / "t", T.StructType(df.schema.fields)
    tables.write_shards(df, str(root), 10)
    before = files_of(root)
    new = spark.createDataFrame([(15, "new"), (18, "new"), (15, "new"), (71, "new"), (None, "null key")] + [
        (i, "late") for i in range(200, 213)], "record_id long, text string")
    want = sorted(map(repr, tables.merged(df, new).collect()))
    for _ in range(2):  # a second run changes nothing
        table = consolidate_shards(new, str(root), schema)
        assert sorted(map(repr, table.collect())) == want
    after = files_of(root)
    kept = {f for f in before if "0000010-" not in f and "0000070-" not in f}
    assert kept <= after and not (before - kept) & after
    names = ids(tables.read_shards(spark, str(root), schema).where("record_id > 99 or record_id is null"), "shard")
    assert names == ["batch-0000100-0000110"] * 10 + ["batch-0000110-0000114"] * 4


def test_consolidation_in_place_of_repeated_keys_and_nothing(spark, tmp_path):
    df = numbered(spark, 30).withColumn("text", F.lit("old"))
    root, schema = tmp_path / "t", T.StructType(df.schema.fields)
    empty = df.limit(0)
    assert consolidate_shards(empty.unionByName(df.where("record_id < 20")), str(root), schema).count() == 20
    df.where("record_id between 4 and 6").withColumn("text", F.lit("b")).write.parquet(f"{root}/shard=batch-0000020-0000023")
    shard_index.index_shards(spark, str(root), schema["record_id"])
    done = tables.read_shards(spark, str(root), schema).drop("shard")
    want = sorted(map(repr, tables.merged(stored(done, "done"), empty).collect()))
    table = consolidate_shards(empty, str(root), schema)
    assert sorted(map(repr, table.collect())) == want and len(want) == 20
    assert not (root / "shard=batch-0000020-0000023").exists()
    index = shard_index.index_shards(spark, str(root), schema["record_id"])
    assert sorted(r["n_rows"] for r in index.collect()) == [10, 10]
    more = df.withColumn("shade", F.lit("x")).where("record_id in (3, 25)")
    table = consolidate_shards(more, str(root), schema)
    assert table.columns == ["record_id", "text", "shade"] and table.count() == 21
    assert ids(table.where("shade = 'x'")) == [3, 25]


def test_consolidation_goes_on_after_a_partial_write(spark, tmp_path):
    """A run that ends between two directories: one of its new shards is there, the other is not."""
    df = numbered(spark, 20).withColumn("text", F.lit("old"))
    root, schema = tmp_path / "t", T.StructType(df.schema.fields)
    tables.write_shards(df, str(root), 10)
    new = spark.range(100, 125).select(F.col("id").alias("record_id"), F.lit("new").alias("text"))
    new.where("record_id between 110 and 119").write.parquet(f"{root}/shard=batch-0000030-0000040")
    table = consolidate_shards(new, str(root), schema)
    assert sorted(map(repr, table.collect())) == sorted(map(repr, tables.merged(df, new).collect()))


def test_append_keeps_what_is_there(spark, tmp_path):
    for _ in range(3):
        tables.append_dataset(numbered(spark, 4), str(tmp_path / "t"))
    assert tables.read_dataset(spark, str(tmp_path / "t"), T.StructType([T.StructField("record_id", T.LongType())])).count() == 12


@pytest.mark.parametrize("settings", [{}, {"max_bits": 1}, {"max_bits": 40}, {"bits_per_key": 2}])
def test_filtered_anti_join(spark, settings):
    rows = spark.createDataFrame([(i if i % 50 else None, i) for i in range(600)], "record_id long, _block long").repartition(5)
    for keys in (range(0, 900, 3), [], [7]):
        done = spark.createDataFrame([(k,) for k in keys] + [(None,)], "record_id long")
        got = prefilter.filtered_anti_join(rows, done, "record_id", **settings).collect()
        want = rows.join(done, "record_id", "left_anti").collect()
        assert sorted(map(repr, got)) == sorted(map(repr, want))
    maybe, clear = prefilter.split_by_keys(rows, spark.range(5).withColumnRenamed("id", "record_id"), "record_id")
    assert maybe.count() < 50 and clear.count() > 550


def test_rows_of_unchanged_keys_are_not_shuffled(spark):
    old = numbered(spark, 500).withColumn("text", F.lit("old"))
    new = old.where("record_id < 3").withColumn("text", F.lit("new")).withColumn("more", F.lit(1))
    _, clear = prefilter.split_by_keys(old, new, "record_id")
    assert "Exchange hashpartitioning" not in clear._jdf.queryExecution().executedPlan().toString()
    table = tables.merged(old.unionByName(old.where("record_id = 9")), new)
    assert table.columns == ["record_id", "text", "more"] and table.count() == 500
    assert sorted(r[0] for r in table.where("text = 'new' and more = 1").collect()) == [0, 1, 2]
