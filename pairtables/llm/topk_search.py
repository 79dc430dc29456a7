"""Exact top-k by inner product: branch and bound over blocks of dimensions in columns."""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from pairtables.llm.common import stored

SCALE, TOP, QUERY_EVERY = 256, 5, 50
#: Vectors of one block in columns; a block is one row of a table, some 0.5 MB at 64 dimensions.
BLOCK_ROWS = 4_096
#: Queries that travel together, and dimensions that are added up between two cuts.
QUERY_ROWS, STEP = 512, 8
#: Bytes of columns that one cell of blocks holds at most; smaller tables have a cell per block
#: up to ``CELLS``. Tasks that form blocks: at most ``FORMING``.
CELL_BYTES, CELLS, FORMING = 64 << 20, 1_024, 4_096
#: Quantised components are held within this, so that sums fit 38 digits for 2^13 dimensions.
LARGEST = 2**56
_EXACT = 2.0**53
_MAX_LONG, _MIN_LONG = 2**63 - 1, -(2**63)


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """``_row``, ``_id``, ``_v`` (whole numbers) of the vectors that hold finite numbers only."""
    values = F.col(vector_col).cast("array<double>")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col(vector_col).isNotNull() & ~F.coalesce(bad, F.lit(False))).select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(id_col).cast("long").alias("_id"),
        F.transform(
            values, lambda x: F.greatest(F.least(F.floor(x * scale).cast("long"), F.lit(LARGEST)), F.lit(-LARGEST))
        ).alias("_v"),
    )


_BLOCK = T.StructType(
    [
        T.StructField("_block", T.LongType()),
        T.StructField("_n", T.IntegerType()),
        T.StructField("_dims", T.IntegerType()),
        T.StructField("_width", T.IntegerType()),
        T.StructField("_rows", T.BinaryType()),
        T.StructField("_ids", T.BinaryType()),
        T.StructField("_known", T.BinaryType()),
        T.StructField("_columns", T.BinaryType()),
    ]
)


def _in_columns(rows: int):
    """A function from batches of (_row, _id, _v) to blocks of ``rows`` vectors, dimension by dimension."""

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            while held.num_rows >= rows:
                yield held.slice(0, rows)
                held = held.slice(rows)
        if held is not None and held.num_rows:
            yield held

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in full(batches):
            keys, ids, lists = (part.column(c).combine_chunks() for c in range(3))
            lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            n, dims = len(keys), int(lengths.max())
            matrix = np.zeros((n, dims), dtype=np.int64)  # a shorter vector ends in zeros
            matrix[np.arange(dims) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
            narrow = not dims or -(2**15) <= matrix.min() and matrix.max() < 2**15
            row = {
                "_block": keys[0].as_py(),  # row keys are unique, so this names the block
                "_n": n,
                "_dims": dims,
                "_width": 2 if narrow else 8,
                "_rows": keys.to_numpy().tobytes(),
                "_ids": pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).tobytes(),
                "_known": pc.is_valid(ids).to_numpy(zero_copy_only=False).tobytes(),
                "_columns": np.ascontiguousarray(matrix.T.astype(np.int16 if narrow else np.int64)).tobytes(),
            }
            yield pa.RecordBatch.from_pylist([row], schema=_ARROW)

    return blocks


_ARROW = pa.schema(
    [("_block", pa.int64()), ("_n", pa.int32()), ("_dims", pa.int32()), ("_width", pa.int32())]
    + [(c, pa.binary()) for c in ("_rows", "_ids", "_known", "_columns")]
)
_FOUND = T.StructType(
    [
        T.StructField("_q", T.LongType()),
        T.StructField("_query_id", T.LongType()),
        T.StructField("_row", T.LongType()),
        T.StructField("_id", T.LongType()),
        T.StructField("_score", T.DecimalType(38, 0)),
    ]
)


def in_columns(vectors: DataFrame, rows: int, name: str) -> DataFrame:
    """A stored table of blocks; one row holds up to ``rows`` vectors. Vectors are dealt by row
    key first, so that blocks are full however the table was cut."""
    parts = min(FORMING, max(1, math.ceil(vectors.count() / (0.9 * rows))))
    return stored(vectors.repartition(parts, "_row").mapInArrow(_in_columns(rows), _BLOCK), name)


class _Block:
    def __init__(self, row: dict, step: int):
        kind = np.int16 if row["width"] == 2 else np.int64
        whole = np.frombuffer(row["columns"], dtype=kind).reshape(row["dims"], row["n"])
        self.rows = np.frombuffer(row["rows"], dtype=np.int64)
        self.ids = np.frombuffer(row["ids"], dtype=np.int64)
        self.known = np.frombuffer(row["known"], dtype=bool)
        self.largest = float(np.abs(whole.astype(np.float64)).max()) if whole.size else 0.0
        self.whole = whole
        self.values = whole.astype(np.float64)
        # Length of every vector in every block of dimensions: what it may still add.
        starts = np.arange(0, row["dims"], step)
        squares = np.add.reduceat(self.values**2, starts, axis=0) if len(starts) else np.zeros((0, row["n"]))
        self.mass = np.sqrt(squares)


class _Best:
    """The best rows of one query so far: (score, id is null, id, row) in the order of the result."""

    def __init__(self, top: int):
        self.top, self.rows = top, []

    @property
    def bound(self) -> float | int | None:
        return -self.rows[-1][0] if len(self.rows) == self.top else None

    def add(self, scores, block: _Block, places: np.ndarray) -> None:
        new = [
            (-int(s), not block.known[p], int(block.ids[p]), int(block.rows[p])) for s, p in zip(scores, places)
        ]
        self.rows = sorted(self.rows + new)[: self.top]


def _search(query: np.ndarray, mass: np.ndarray, own: int, block: _Block, best: _Best, step: int) -> None:
    """Add the rows of a block that are among the best of a query.

    Blocks of dimensions are taken in falling order of what the query has in them. After each
    one, every vector's score lies within its sum so far and the bound of its remaining blocks
    (Cauchy and Schwarz, block by block); vectors whose upper end is below the k-th best lower
    end, or below the k-th best row of earlier blocks, are dropped, and the rest moved together.
    """
    dims = min(len(query), len(block.whole))
    alive = np.flatnonzero(block.rows != own)
    if not len(alive):
        return
    n_steps = -(-dims // step)
    mass = mass[:n_steps]
    order = np.argsort(-mass, kind="stable")
    largest = float(np.abs(query[:dims].astype(np.float64)).max(initial=0.0))
    if dims * largest * block.largest >= _EXACT:  # doubles may round: whole numbers of any size
        scores = query[:dims].astype(object) @ block.whole[:dims].astype(object)
        scores = scores[alive]
        keep = _top(scores, best.top)
        best.add(scores[keep], block, alive[keep])
        return
    floats = query.astype(np.float64)
    left = mass[order] @ block.mass[order] if n_steps else np.zeros(len(block.rows))
    left, sums = left[alive], np.zeros(len(alive))
    whole_block = len(alive) == len(block.rows)
    bound = best.bound
    for k, at in enumerate(order):
        low, high = at * step, min(at * step + step, dims)
        columns = block.values[low:high] if whole_block else block.values[low:high, alive]
        sums += floats[low:high] @ columns
        left -= mass[at] * (block.mass[at] if whole_block else block.mass[at, alive])
        slack = 1 + 1e-9 * np.abs(left).max()  # more than the rounding of the bounds
        floor_ = -np.inf if bound is None else bound
        if len(alive) > best.top:
            kth = np.partition(sums - left, len(alive) - best.top)[len(alive) - best.top]
            floor_ = max(floor_, kth)
        live = sums + left >= floor_ - slack
        n_live = np.count_nonzero(live)
        if n_live < 0.8 * len(alive) or k == len(order) - 1:
            alive, sums, left, whole_block = alive[live], sums[live], left[live], False
        if not len(alive):
            return
    keep = _top(sums, best.top)
    best.add(np.rint(sums[keep]), block, alive[keep])


def _top(scores: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` largest scores and of all that equal the last of them."""
    if len(scores) <= top:
        return np.arange(len(scores))
    kth = np.partition(scores, len(scores) - top)[len(scores) - top]
    return np.flatnonzero(scores >= kth)


def _searcher(top: int, step: int):
    """Rows of (block of queries, block of candidates) to the best rows of each query. A block of
    queries is passed on when another one follows; in a cell it meets all blocks one after the other."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, name, bests = None, None, []
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if row["_q_block"] != name:
                    if asked is not None:
                        yield _emit(asked, bests)
                    asked, name = _Block({k[3:]: v for k, v in row.items() if k.startswith("_q_")}, step), row["_q_block"]
                    bests = [_Best(top) for _ in asked.rows]
                block = _Block({k[3:]: v for k, v in row.items() if k.startswith("_c_")}, step)
                for k, best in enumerate(bests):
                    _search(asked.whole[:, k], asked.mass[:, k], asked.rows[k], block, best, step)
        if asked is not None:
            yield _emit(asked, bests)

    return search


def _emit(asked: _Block, bests: list[_Best]) -> pa.RecordBatch:
    found = [
        (int(asked.rows[k]), int(asked.ids[k]), row, None if null else i, Decimal(-score))
        for k, best in enumerate(bests)
        for score, null, i, row in best.rows
    ]
    kinds = [pa.int64()] * 4 + [pa.decimal128(38, 0)]
    columns = list(zip(*found)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=_FOUND.fieldNames())


def top_k(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    is_query: Column | None = None,
    top: int = TOP,
    scale: int = SCALE,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
    step: int = STEP,
    cell_bytes: int = CELL_BYTES,
) -> DataFrame:
    """Per query its ``top`` best other rows: query_id, rank (from 1), vec_id, score (whole inner product).

    ``is_query`` is a condition on ``id_col``; by default the id is divisible by 50. Components
    count as ``floor(scale * x)``, held within +-2^56; scores are compared as they are and held
    within 64 bits in the result. Ties go to the smaller id, null ids last. Of vectors of unequal
    length the shorter one ends in zeros. Vectors that are null or hold null or non-finite
    components take no part. A row is left out only of its own search, so rows that repeat an id
    find each other. Other columns are not looked at; an empty table gives no rows.

    Vectors are stored in blocks of columns, queries in blocks too. Blocks of candidates are dealt
    to cells of at most some ``cell_bytes``, and each block of queries is sent to every cell. A task
    holds one cell and passes on ``top`` rows per query, which are ranked once more per query.
    """
    rows = stored(quantised(vectors, id_col, vector_col, scale), "vectors")
    ids = rows.select(F.col("_id").alias(id_col), "_row", "_id", "_v")
    wanted = is_query if is_query is not None else F.col(id_col) % QUERY_EVERY == 0
    queries = in_columns(ids.where(wanted).select("_row", "_id", "_v"), query_rows, "queries")
    blocks = in_columns(rows, block_rows, "columns")
    size = blocks.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("_n").cast("long") * F.col("_dims") * F.col("_width")).alias("bytes")
    ).first()
    n_cells = max(1, min(size["n"], CELLS), math.ceil((size["bytes"] or 0) / cell_bytes))
    here = blocks.select(
        F.pmod(F.xxhash64("_block"), F.lit(n_cells)).alias("_cell"),
        *[F.col(c).alias("_c" + c) for c in blocks.columns],
    )
    asking = queries.select(
        F.explode(F.expr(f"sequence(0L, {n_cells - 1}L)")).alias("_cell"),
        *[F.col(c).alias("_q" + c) for c in queries.columns],
    )
    # Numbers of partitions are given, as small cells are a lot of work and must not be merged.
    here, asking = here.repartition(n_cells, "_cell"), asking.repartition(n_cells, "_cell")
    found = asking.join(here.hint("shuffle_hash"), "_cell").drop("_cell").mapInArrow(_searcher(top, step), _FOUND)
    order = [F.desc("_score"), F.asc_nulls_last("_id"), F.asc("_row")]
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("_q").orderBy(*order)))
    least, most = (F.lit(v).cast("decimal(38,0)") for v in (_MIN_LONG, _MAX_LONG))
    score = F.least(F.greatest("_score", least), most).cast("long")
    return ranked.where(F.col("rank") <= top).select(
        F.col("_query_id").alias("query_id"), "rank", F.col("_id").alias("vec_id"), score.alias("score")
    )


def op12_topk_search(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE_SQL = """
with v as (
  select vec_id, [cast(floor(cast(x as double) * 256) as bigint) for x in embedding] as e
  from embeddings
  where embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0
),
s as (
  select q.vec_id as query_id, c.vec_id, cast(list_sum(
    [q.e[k] * c.e[k] for k in range(1, least(len(q.e), len(c.e)) + 1)]) as bigint) as score
  from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id
),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as k from s)
select query_id, cast(k as integer) as rank, vec_id, score from r where k <= 5
"""
