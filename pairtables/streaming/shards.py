"""Incremental ingest of new shards, and running completion counts."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from pairtables.operators.pairs import PROVIDERS, pending_rows
from pairtables.operators.progress import completion
from pairtables.sources.tables import read_if_there

#: A shard's name ends with the positions of its first row and of the row after its last one.
_RANGE = re.compile(r"-(\d+)-(\d+)$")
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def shard_stream(
    spark: SparkSession,
    src: str,
    schema: T.StructType,
    files: str | None = None,
    max_files: int | None = None,
    max_batches: int | None = None,
) -> DataFrame:
    """Shards under a path as a stream of files; ``files`` is a pattern of file names.

    A micro-batch costs a round of tasks over all partitions of the state, however few its files
    are. So with ``max_batches`` it takes more files than ``max_files`` where the path holds so many
    that they would make more micro-batches than that: rounds do not grow with the files.
    """
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("pathGlobFilter", files)
    if max_files and max_batches:
        max_files = max(max_files, -(-_n_files(spark, src) // max_batches))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(src)


def _n_files(spark: SparkSession, path: str) -> int:
    """How many files lie below a path, by their names alone."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getFileCount()


def ingest_stream(stream: DataFrame, sink: str, checkpoint: str, key: str = "record_id") -> None:
    """Take in all shards that have not been seen, each row once; return when none is left.

    The keys seen so far are the state of the stream, partitioned by key and kept on disk
    (see ``session.SETTINGS``), so a micro-batch looks up its own keys and does not read the
    sink. A micro-batch replaces its own ``run=…/batch_id=…`` directory, so running it again
    after a failure adds nothing. A run is a checkpoint; only if the sink has rows of other
    runs, which are not in this one's state, their keys are read.
    """
    _drain(stream.dropDuplicates([key]), sink, checkpoint, stream.schema[key])


def _drain(fresh: DataFrame, sink: str, checkpoint: str, key: T.StructField) -> None:
    """Write the rows of a stream until no file is left; leave out keys that other runs wrote."""
    run = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]
    fields = [key, T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())]
    there = read_if_there(fresh.sparkSession, sink, T.StructType(fields))
    others = None if there is None else there.where(F.col("run") != run)
    if others is not None and others.isEmpty():
        others = None

    def write(batch: DataFrame, batch_id: int) -> None:
        new = batch if others is None else pending_rows(batch, others, key.name)
        new.write.mode("overwrite").parquet(f"{sink}/run={run}/batch_id={batch_id}")

    _run(fresh.writeStream.foreachBatch(write), checkpoint)


def _run(writer, checkpoint: str) -> None:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def rows_of_name(shard: str | None) -> int | None:
    """How many rows a shard has by its name, or None where the name gives no range."""
    found = _RANGE.search(shard or "")
    return int(found[2]) - int(found[1]) if found else None


class _TakeOnce(StatefulProcessor):
    """Rows of a shard that have not been taken. What is kept of a shard that is complete is one
    value; its keys are kept only while rows are missing."""

    def __init__(self, key: T.StructField, expire_ms: int | None):
        self.key, self.expire_ms = key, expire_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.taken = handle.getMapState("taken", T.StructType([self.key]), "at long")
        self.rows = handle.getValueState("rows", "n long, complete boolean", self.expire_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        n, complete = self.rows.get() if self.rows.exists() else (0, False)
        expected = rows_of_name(key[0])
        before = n
        for row in rows:
            own = (row[self.key.name],)
            if complete or own[0] is not None and self.taken.containsKey(own):
                continue
            if own[0] is not None:
                self.taken.updateValue(own, (n,))
            n += 1
            yield row
        if complete or n == before and self.rows.exists():
            return
        complete = expected is not None and n >= expected
        if complete:
            self.taken.clear()
        self.rows.update((n, complete))

    def close(self) -> None:
        pass


@contextmanager
def _rocksdb(spark: SparkSession):
    """State by shard needs this store; the setting of the session is put back afterwards."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def ingest_shards(
    stream: DataFrame,
    sink: str,
    checkpoint: str,
    key: str = "record_id",
    shard: str = "shard",
    expire_ms: int | None = None,
) -> None:
    """Take in shards as they arrive, each row once; return when none is left.

    Like :func:`ingest_stream`, but the state is one row per shard: how many of its rows are
    taken, and whether these are all that its name (``batch-{start}-{end}``) says. Keys are kept
    only for a shard of which rows are still missing, since its files may come in several
    micro-batches; a shard that is complete adds nothing when it is delivered again. A shard
    whose name gives no range keeps its keys. A key belongs to one shard; a row without a key is
    taken each time that it comes, until its shard is complete. ``expire_ms`` ends the state of a
    shard that long after its last change, for sources that cannot deliver it again later.
    """
    processor = _TakeOnce(stream.schema[key], expire_ms)
    mode = "ProcessingTime" if expire_ms else "None"
    with _rocksdb(stream.sparkSession):
        fresh = stream.groupBy(shard).transformWithState(processor, stream.schema, "append", mode)
        _drain(fresh, sink, checkpoint, stream.schema[key])


def progress_stream(
    stream: DataFrame,
    sink: str,
    checkpoint: str,
    by: list[str] | None = None,
    providers: tuple[str, ...] = PROVIDERS,
    merge_after: int = 10,
) -> None:
    """Keep running completion counts over all shards seen so far.

    The state is one row per group. A micro-batch writes the counts of the groups that it changed,
    and nothing else, to its own ``batch_id=`` directory. When a run ends with ``merge_after`` such
    directories or more, they are merged into one that holds the newest counts of all groups
    (see :func:`merge_progress`). :func:`latest_progress` reads the counts.
    """
    counts = stream.groupBy(*(by or [])).agg(*completion(providers))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/kind=changes/batch_id={batch_id}")

    _run(counts.writeStream.outputMode("update").foreachBatch(write), checkpoint)
    merge_progress(stream.sparkSession, sink, merge_after)


def _newest(rows: DataFrame) -> DataFrame:
    """The row of the last micro-batch of every group: counts only grow, so it is also the largest."""
    counts = [c for c in rows.columns if c == "n_rows" or c.endswith("_done")]
    by = [c for c in rows.columns if c not in (*counts, "kind", "batch_id")]
    last = F.max_by(F.struct(*counts), "batch_id").alias("_last")
    return rows.groupBy(*by).agg(last).select(*by, *[F.col(f"_last.{c}").alias(c) for c in counts])


def _batches(spark: SparkSession, sink: str, kind: str) -> list[int]:
    """The micro-batches that have a directory of a kind; a merge counts once it is complete."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{sink}/kind={kind}")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    found = [f.getPath() for f in files.listStatus(folder)]
    if kind == "merged":
        found = [p for p in found if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(p.getName().removeprefix("batch_id=")) for p in found if p.getName().startswith("batch_id="))


def _live(spark: SparkSession, sink: str) -> tuple[DataFrame, list[int]]:
    """The rows that the newest merge and later micro-batches wrote, and the numbers of these micro-batches.

    Only directory names are listed for this; directories that a merge has replaced are not opened.
    """
    merged = _batches(spark, sink, "merged")[-1:]
    changes = [b for b in _batches(spark, sink, "changes") if not merged or b > merged[0]]
    live = (F.col("kind") == "merged") & F.col("batch_id").isin(merged)
    live |= (F.col("kind") == "changes") & F.col("batch_id").isin(changes)
    return spark.read.parquet(sink).where(live), changes


def merge_progress(spark: SparkSession, sink: str, merge_after: int = 1) -> None:
    """Write the newest counts of all groups to one directory, if ``merge_after`` micro-batches or more
    have written since the last time. Older directories stay, and are not opened any more."""
    rows, changes = _live(spark, sink)
    if changes and len(changes) >= merge_after:
        _newest(rows).write.mode("overwrite").parquet(f"{sink}/kind=merged/batch_id={changes[-1]}")


def latest_progress(spark: SparkSession, sink: str) -> DataFrame:
    """The counts after the last micro-batch, of all groups."""
    return _newest(_live(spark, sink)[0])
