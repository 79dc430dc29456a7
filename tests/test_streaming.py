from pyspark.sql import functions as F, types as T

from pairtables import schemas
from pairtables.sources import tables
from pairtables.streaming import shards

WITH_SHARD = T.StructType([*schemas.DUAL_SOURCE.fields, T.StructField("shard", T.StringType())])


def rows(spark, numbers):
    return spark.createDataFrame([(i, f"q{i}", "a" if i % 2 else None, " ", 0.2, 400) for i in numbers], schemas.DUAL_SOURCE)


def stored(spark, sink):
    return sorted(r[0] for r in spark.read.schema(schemas.DUAL_SOURCE).parquet(sink).select("record_id").collect())


def test_ingest_takes_each_row_once_over_restarts(spark, tmp_path):
    src, sink, checkpoint = (str(tmp_path / n) for n in ("src", "sink", "checkpoint"))

    def run():
        stream = shards.shard_stream(spark, src, schemas.DUAL_SOURCE, max_files=1)
        shards.ingest_stream(stream, sink, checkpoint)

    tables.append_dataset(rows(spark, [1, 2, 2, 3]).coalesce(1), src)
    run()
    assert stored(spark, sink) == [1, 2, 3]
    run()
    assert stored(spark, sink) == [1, 2, 3]
    tables.append_dataset(rows(spark, [3, 4]).coalesce(1), src)
    tables.append_dataset(rows(spark, [4, 5]).coalesce(1), src)
    run()
    assert stored(spark, sink) == [1, 2, 3, 4, 5]


def test_ingest_again_without_a_checkpoint_adds_nothing(spark, tmp_path):
    src, sink = str(tmp_path / "src"), str(tmp_path / "sink")
    tables.append_dataset(rows(spark, range(20)), src)
    for run in range(2):
        stream = shards.shard_stream(spark, src, schemas.DUAL_SOURCE)
        shards.ingest_stream(stream, sink, str(tmp_path / f"checkpoint{run}"))
        assert stored(spark, sink) == list(range(20))


def test_progress_runs_on(spark, tmp_path):
    src, sink, checkpoint = (str(tmp_path / n) for n in ("src", "sink", "checkpoint"))

    def run():
        shards.progress_stream(shards.shard_stream(spark, src, schemas.DUAL_SOURCE), sink, checkpoint)
        return tuple(shards.latest_progress(spark, sink).select("gpt_output_done", "gemini_output_done", "n_rows").first())

    tables.append_dataset(rows(spark, range(4)), src)
    assert run() == (2, 4, 4)
    tables.append_dataset(rows(spark, range(4, 10)), src)
    assert run() == (5, 10, 10)


def test_running_counts_equal_counts_at_once(spark, tmp_path):
    src = str(tmp_path / "src")
    df = rows(spark, range(30))
    tables.write_shards(df, src, batch_size=10)
    from pairtables.operators.progress import batch_progress

    stream = shards.shard_stream(spark, src, WITH_SHARD)
    shards.progress_stream(stream, str(tmp_path / "sink"), str(tmp_path / "checkpoint"), ["shard"])
    found = shards.latest_progress(spark, str(tmp_path / "sink"))
    at_once = batch_progress(tables.with_shards(df, 10), by="shard")
    assert sorted(map(tuple, found.select(at_once.columns).collect())) == sorted(map(tuple, at_once.collect()))
    assert found.select(F.sum("n_rows")).first()[0] == 30


def shard_rows(spark, numbers, size=10):
    df = rows(spark, numbers)
    name = F.format_string("batch-%07d-%07d", F.col("record_id") - F.col("record_id") % size, F.col("record_id") - F.col("record_id") % size + size)
    return df.withColumn("shard", name)


def test_state_of_shards(spark, tmp_path):
    src, sink, checkpoint = (str(tmp_path / n) for n in ("src", "sink", "checkpoint"))

    def deliver(numbers):
        shard_rows(spark, numbers).coalesce(1).write.mode("append").partitionBy("shard").parquet(src)
        shards.ingest_shards(shards.shard_stream(spark, src, WITH_SHARD, max_files=1), sink, checkpoint)
        return stored(spark, sink)

    def state(name):
        found = spark.read.format("statestore").option("stateVarName", name).load(checkpoint)
        return found.count()

    assert deliver([*range(10), 3, *range(10, 14)]) == list(range(14))
    assert state("rows") == 2 and state("taken") == 4  # only keys of the shard that is not complete
    assert deliver(range(10, 20)) == list(range(20))
    assert state("rows") == 2 and state("taken") == 0
    assert deliver(range(20)) == list(range(20))  # all a second time, after a restart
    assert deliver(range(30, 50)) == [*range(20), *range(30, 50)]
    assert state("rows") == 4 and state("taken") == 0
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("RocksDBStateStoreProvider")


def test_rows_of_name():
    assert [shards.rows_of_name(n) for n in ("batch-0000010-0000020", "draft-0", None, "x-3-9")] == [10, None, None, 6]


def size_of(path):
    import os

    files = [os.path.join(d, f) for d, _, names in os.walk(path) for f in names]
    return sum(os.path.getsize(f) for f in files if f.endswith(".parquet"))


def test_progress_writes_changed_groups_only(spark, tmp_path):
    src, sink, checkpoint = (str(tmp_path / n) for n in ("src", "sink", "checkpoint"))

    def deliver(numbers, merge_after=100):
        shard_rows(spark, numbers, 2).repartition(1).write.mode("append").parquet(src)
        stream = shards.shard_stream(spark, src, WITH_SHARD)
        shards.progress_stream(stream, sink, checkpoint, ["shard"], merge_after=merge_after)
        return {r["shard"]: r["n_rows"] for r in shards.latest_progress(spark, sink).collect()}

    deliver(range(400))
    assert len(deliver([0])) == 200
    changed = spark.read.parquet(f"{sink}/kind=changes/batch_id=1")
    assert changed.count() == 1 and changed.first()["n_rows"] == 3
    deliver([0], merge_after=1)  # merged now
    assert shards._batches(spark, sink, "merged") == [2]
    found = deliver([2])
    assert len(found) == 200 and found["batch-0000000-0000002"] == 4 and found["batch-0000002-0000004"] == 3
    files = shards.latest_progress(spark, sink).inputFiles()
    assert all("merged/batch_id=2" in f or "changes/batch_id=3" in f for f in files) or "PartitionFilters" in str(
        shards.latest_progress(spark, sink)._jdf.queryExecution().executedPlan()
    )


def test_more_files_make_no_more_micro_batches(spark, tmp_path):
    import os

    src = str(tmp_path / "src")
    tables.write_shards(rows(spark, range(60)), src, batch_size=2)

    def run(name, **limits):
        checkpoint = str(tmp_path / f"checkpoint-{name}")
        stream = shards.shard_stream(spark, src, WITH_SHARD, max_files=4, **limits)
        shards.progress_stream(stream, str(tmp_path / name), checkpoint, ["shard"])
        counts = shards.latest_progress(spark, str(tmp_path / name))
        done = [n for n in os.listdir(f"{checkpoint}/commits") if n.isdigit()]
        return len(done), sorted(map(tuple, counts.collect()))

    many, expected = run("many")
    few, found = run("few", max_batches=3)
    assert (many, few) == (8, 3) and found == expected and len(found) == 30
    assert run("least", max_batches=100)[0] == 8  # micro-batches of few files are not cut smaller


def test_many_shards_are_ingested_in_few_micro_batches(spark, tmp_path):
    import os

    src, sink, checkpoint = (str(tmp_path / n) for n in ("src", "sink", "checkpoint"))
    shard_rows(spark, range(60), 2).coalesce(1).write.partitionBy("shard").parquet(src)
    stream = shards.shard_stream(spark, src, WITH_SHARD, max_files=4, max_batches=2)
    shards.ingest_shards(stream, sink, checkpoint)
    assert len([n for n in os.listdir(f"{checkpoint}/commits") if n.isdigit()]) == 2
    assert stored(spark, sink) == list(range(60))
