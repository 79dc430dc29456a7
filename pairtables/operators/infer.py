"""Batched calls of an injected function. The function is the caller's; none is built in."""

from __future__ import annotations

import math
import queue
import threading
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pairtables import fixed_values as fixed
from pairtables.session import shared_path
from pairtables.sources.tables import read_if_there

Model = Callable[[list[str]], list[str]]
#: Prompts of one stored chunk, and of one of its tasks.
ROWS_PER_CHUNK, ROWS_PER_TASK = 1_000_000, 2_000
_WRITERS = 16  # tasks that write the prompts of a chunk


def limited(fn: Model, prompts: list[str], seconds: float | None) -> list[str]:
    """The answers of one call, or TimeoutError. A thread cannot be ended, so a call that hangs is
    left behind in a thread of its own that does not keep the process alive."""
    if seconds is None:
        return list(fn(prompts))
    box: queue.SimpleQueue = queue.SimpleQueue()

    def run() -> None:
        try:
            box.put((list(fn(prompts)), None))
        except Exception as problem:
            box.put((None, problem))

    threading.Thread(target=run, daemon=True).start()
    try:
        answers, problem = box.get(timeout=seconds)
    except queue.Empty:
        raise TimeoutError(f"no answer in {seconds:g} s") from None
    if problem is not None:
        raise problem
    return answers


def batch_infer(
    df: DataFrame,
    fn: Model,
    keys: list[str] | None = None,
    prompt: str = "prompt",
    batch_size: int = fixed.BATCH_SIZE,
    in_flight: int = 1,
    seconds: float | None = None,
    tries: int = 1,
    wait: float = 1.0,
) -> DataFrame:
    """Call ``fn`` on lists of at most ``batch_size`` prompts; give ``response`` or ``error``.

    A task has up to ``in_flight`` calls open, each for at most ``seconds``. A call that fails is
    made ``tries`` times, with pauses of ``wait`` seconds that double each time. If a list still
    fails, its prompts are tried one by one, so that an error stays with its row; a list that
    takes too long is split at once. Tasks may be run twice after a lost executor, so ``fn`` must
    bear repeated prompts; :func:`infer_by_chunk` keeps what was answered before.
    """
    keys = keys or ["record_id"]
    fields = [df.schema[k] for k in keys]
    schema = T.StructType(
        [*fields, T.StructField("response", T.StringType()), T.StructField("error", T.StringType())]
    )

    def called(prompts: list[str]) -> list[str]:
        for left in reversed(range(tries)):
            try:
                answers = limited(fn, prompts, seconds)
                if len(answers) != len(prompts):
                    raise ValueError(f"{len(prompts)} prompts gave {len(answers)} responses")
                return answers
            except Exception as problem:
                if not left or (len(prompts) > 1 and isinstance(problem, TimeoutError)):
                    raise
                time.sleep(wait * 2 ** (tries - 1 - left))
        raise ValueError("tries must be 1 or more")

    def attempt(prompts: list[str]) -> list[tuple[str | None, str | None]]:
        try:
            return [(answer, None) for answer in called(prompts)]
        except Exception as problem:
            if len(prompts) == 1:
                return [(None, f"{type(problem).__name__}: {problem}")]
            return [result for p in prompts for result in attempt([p])]

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(in_flight) as pool:
            for pdf in batches:
                chunks = [pdf.iloc[start : start + batch_size] for start in range(0, len(pdf), batch_size)]
                answered = pool.map(attempt, [chunk[prompt].tolist() for chunk in chunks])
                for chunk, results in zip(chunks, answered):
                    yield chunk[keys].assign(
                        response=[r for r, _ in results], error=[e for _, e in results]
                    )

    return df.select(*keys, prompt).mapInPandas(call, schema)


def infer_by_chunk(
    df: DataFrame,
    fn: Model,
    path: str,
    keys: list[str] | None = None,
    prompt: str = "prompt",
    rows_per_chunk: int = ROWS_PER_CHUNK,
    rows_per_task: int = ROWS_PER_TASK,
    **calls,
) -> DataFrame:
    """One answer per key, stored below ``path`` chunk by chunk, so that answers are asked for once.

    Keys that ``path`` has a response for are not asked again: a run that was interrupted, or whose
    table has grown, asks for the rest, and for keys that ended in an error. The open prompts are
    written once, dealt to chunks by a hash of the key; each chunk is one job whose answers are kept
    whatever happens to later ones, so an interruption costs the calls of one chunk at most. A lost
    executor repeats the tasks that it was running, of some ``rows_per_task`` prompts each; finished
    tasks have written their files. ``calls`` are options of :func:`batch_infer`. Of rows with the
    same key, a null one included, the smallest prompt is asked; rows without a prompt get no answer.
    """
    keys, spark = keys or ["record_id"], df.sparkSession
    rows = df.where(F.col(prompt).isNotNull())
    schema = T.StructType(
        [*[df.schema[k] for k in keys], T.StructField("response", T.StringType()), T.StructField("error", T.StringType())]
    )
    asked = rows.groupBy(*keys).agg(F.min(prompt).alias("_prompt"))
    before = read_if_there(spark, path, schema)
    if before is not None:
        asked = _by_keys(asked, before.where("error is null"), keys, "left_anti")
    n = asked.count()
    chunks = max(1, math.ceil(n / rows_per_chunk))
    spread = max(math.ceil(n / chunks / rows_per_task), min(n, spark.sparkContext.defaultParallelism), 1)
    # Not the hash that shuffles use, so that the keys of a chunk are even over its tasks.
    chunk = F.pmod(F.xxhash64(F.lit("chunk"), *keys), F.lit(chunks)).cast("int")
    dealt = asked.withColumn("_chunk", chunk).repartition("_chunk", F.pmod(F.xxhash64(*keys), F.lit(_WRITERS)))
    folder = shared_path(spark, "asked")
    dealt.write.partitionBy("_chunk").parquet(folder)
    asked = spark.read.schema(dealt.schema).parquet(folder)
    for i in range(chunks):
        part = asked.where(F.col("_chunk") == i).repartition(spread, *keys)
        batch_infer(part, fn, keys, "_prompt", **calls).write.mode("append").parquet(path)
    # A key that failed in one run and was answered in a later one has its answer.
    best = F.min(F.struct(F.col("response").isNull().alias("none"), "response", "error")).alias("_best")
    found = spark.read.schema(schema).parquet(path).groupBy(*keys).agg(best)
    return _by_keys(found, rows, keys, "left_semi").select(*keys, "_best.response", "_best.error")


def _by_keys(df: DataFrame, others: DataFrame, keys: list[str], how: str) -> DataFrame:
    """A join of rows whose keys are the same, nulls included."""
    others = others.select(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)])
    same = [F.col(k).eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(keys)]
    return df.join(others, reduce(Column.__and__, same), how)


def map_batches(
    df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str
) -> DataFrame:
    """Apply a function to every Arrow batch of a table."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield fn(pdf)

    return df.mapInPandas(each, schema)
