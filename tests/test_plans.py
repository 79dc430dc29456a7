"""What the plans must look like to hold at scale."""

import pytest
from pyspark.sql import Window, functions as F

from pairtables import queries, schemas, views
from pairtables.operators import encode as en, lexical as lx, lookup, pairs as pa, position as po, report as rp, split as sp, versions as ve
from pairtables.plans import evaluation as ev
from pairtables.sources import records, tables
from pairtables.streaming import shards


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def pairs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pairs"))
    df = spark.range(200).select(
        F.col("id").alias("record_id"), F.lit("a").alias("source"), F.lit("q").alias("inputs"),
        F.lit("x y z").alias("targets"), F.lit("x z").alias("outputs"), F.lit("n").alias("unused"),
    )
    df.write.mode("overwrite").parquet(path)
    return tables.read_dataset(spark, path, df.schema)


def test_row_scores_need_no_shuffle(pairs):
    text = plan(lx.lexical_scores(pairs))
    assert "Exchange" not in text and text.count("ArrowEvalPython") == 1


def test_metrics_of_all_sources_score_every_row_once(spark, pairs):
    answers = spark.createDataFrame([(1, "faithfulness", "5")], "record_id long, metric string, response string")
    text = plan(ev.metrics_of(ev.score_rows(pairs, answers), ["source"]))
    assert text.count("ArrowEvalPython") == 1 and text.count("FileScan") == 1
    assert "unused" not in text and "inputs" not in text


def test_split_and_encoding_need_no_shuffle(spark, pairs):
    for side in sp.train_test_split(pairs):
        assert "Exchange" not in plan(side)
    vocab = spark.createDataFrame([("x", 2)], "token string, id int")
    assert "Exchange" not in plan(en.encode(pairs, vocab, "targets"))


def test_unused_columns_are_not_read(pairs):
    text = plan(rp.metric_means(lx.token_count(pairs), {"token_count": "token_count"}, ["source"]))
    assert "ReadSchema: struct<source:string,outputs:string>" in text


def test_a_slice_numbers_keys_and_reads_its_own_rows(pairs):
    text = plan(po.slice_rows(pairs, 20, 30))
    assert "GreaterThanOrEqual(record_id,20)" in text and "LessThanOrEqual(record_id,29)" in text


def test_a_resumed_run_reads_missing_shards_only(spark, pairs):
    there = spark.createDataFrame([(f"batch-{i:07d}-{i + 10:07d}",) for i in range(0, 200, 10) if i != 50], "shard string")
    text = plan(tables._missing_rows(pairs, there, 10, "record_id", 1000))
    assert "GreaterThanOrEqual(record_id,50)" in text and "LessThanOrEqual(record_id,59)" in text


def test_other_shards_are_pruned(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.createDataFrame([(i, "q", "a", None, 0.2, 400) for i in range(9)], schemas.DUAL_SOURCE)
    tables.write_shards(df, root, 3)
    df.write.parquet(f"{root}/shard=draft-0")
    read = tables.read_shards(spark, root, schemas.DUAL_SOURCE)
    assert "StartsWith(shard" in plan(read).split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert read.count() == 9 and spark.read.parquet(root).count() == 18


def test_only_few_rows_per_key_reach_the_shuffle(spark, pairs):
    deduplicated = plan(tables.one_per_key(pairs, "record_id", "outputs"))
    assert "WindowGroupLimit" in deduplicated.split("Exchange")[1]
    ranked = F.row_number().over(Window.partitionBy("source").orderBy(F.desc("record_id")))
    assert "WindowGroupLimit" in plan(pairs.withColumn("r", ranked).where("r <= 3"))


def test_registry_joins_do_not_shuffle_the_rows(spark, pairs):
    registry = spark.createDataFrame([("a",)], "source string")
    assert "Exchange hashpartitioning" not in plan(pa.mark_existing(pairs, registry, "source", "record_id"))
    versions = pairs.select(F.col("source").alias("name"), F.col("record_id").cast("string").alias("version"), F.lit("s").alias("stage"))
    assert "Exchange hashpartitioning" not in plan(ve.retain_versions(versions))


def test_the_salts_of_a_hot_key_grow_with_its_rows(spark):
    """70,000 rows of one key at 100 rows for a task: some 700 salts, and no job while planning."""
    left = spark.range(71_000).select(F.col("id").alias("record_id"), F.when(F.col("id") < 70_000, 0).otherwise(F.col("id")).alias("k"))
    right = left.select("k").distinct().withColumn("v", F.lit(1))
    status = spark.sparkContext.statusTracker()
    before = len(status.getJobIdsForGroup(None))
    joined = lookup.salted_join(left, right, ["k"], "record_id", hot_rows=100)
    assert len(status.getJobIdsForGroup(None)) == before
    assert joined.count() == 71_000 and joined.where("v is null").count() == 0
    keyed = joined._jdf.queryExecution().analyzed().toString()
    assert "_salt" in keyed
    counts = left.groupBy("k").count().where("count > 100").select(F.ceil(F.col("count") / 100)).collect()
    assert [r[0] for r in counts] == [700]
    text = plan(joined)
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_responses_are_parsed_once(pairs):
    rows = records.validate_records(pairs.select("record_id", F.col("targets").alias("response")), "response")
    for part in (rows, records.valid_records(rows), records.rejects(rows)):
        assert plan(part).count("from_json") == 1
    logged = rp.metrics_long(pairs.select("record_id", F.col("targets").alias("entry")), "entry")
    assert plan(logged).count("from_json") == 1


def test_registered_queries_scan_their_table_once(spark, sf_small):
    text = plan(queries.QUERIES["o03_validate_records"](spark, sf_small))
    assert text.count("from_json") == 1 and text.count("FileScan") == 1
    text = plan(queries.QUERIES["o31_existing"](spark, sf_small))
    assert text.count("events.parquet") == 1


def test_tables_of_few_pieces_are_spread_and_others_left_alone(spark, pairs):
    assert "RoundRobinPartitioning" in plan(views.spread(pairs.coalesce(1)))
    many = spark.range(1000).repartition(spark.sparkContext.defaultParallelism)
    assert views.spread(many) is many


def test_pairs_are_joined_on_the_whole_key(spark, sf_small):
    text = plan(views.qa_pairs(spark, sf_small).hint("merge"))
    assert "conv_id" in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_streams_are_bounded_by_files(spark, tmp_path):
    stream = shards.shard_stream(spark, str(tmp_path), schemas.DUAL_SOURCE, max_files=2)
    assert stream.isStreaming


def test_selecting_a_source_reads_three_columns(spark, tmp_path):
    df = spark.createDataFrame([(1, "q", "a", None, 0.2, 400)], schemas.DUAL_SOURCE)
    tables.append_dataset(df, str(tmp_path / "t"))
    read = tables.read_dataset(spark, str(tmp_path / "t"), schemas.DUAL_SOURCE)
    assert "ReadSchema: struct<record_id:bigint,instruction:string,gpt_output:string>" in plan(pa.select_source(read, "gpt_output"))
