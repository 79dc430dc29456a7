"""Toxic texts by a factorization machine over hashed terms."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from pairtables.llm.common import in_fold, sample_by_hash, stored

FOLDS, FOLD = 5, 0
THRESHOLD = 0.5
#: Labelled rows that the machine is fitted to, at most.
MAX_SAMPLE = 12_000
#: Terms of these rows together, at most: 64 MB on the driver.
MAX_TERMS = 16_000_000
BITS, FACTORS = 18, 4
MIN_DOCUMENTS = 4
EPOCHS, BATCH = 4, 128
#: FTRL for the linear weights (McMahan et al. 2013). A term's L1 follows its number of
#: documents: its weight stays 0 unless its gradients add up to ``L1`` standard deviations.
ALPHA, BETA, L1 = 0.3, 1.0, 4.0
#: Terms with a linear weight then get factors (Li et al. 2016), trained with the weights.
PAIR_EPOCHS, RATE, L2, FACTOR_START = 8, 0.05, 1e-4, 0.05

_TERM = re.compile(r"[^\W\d_]+")
#: A word also counts by its starts, so that inflected forms share terms.
STARTS = (4, 5)


def _ids(word: str) -> tuple[int, ...]:
    mask = (1 << BITS) - 1
    starts = (f"{n}:{word[:n]}" for n in STARTS if len(word) >= n)
    return tuple(zlib.crc32(x.encode("utf-8", "surrogatepass")) & mask for x in (word, *starts))


class Terms:
    """Distinct hashed terms of texts; remembers a bounded number of words."""

    def __init__(self, most: int = 100_000):
        self.known: dict[str, tuple[int, ...]] = {}
        self.most = most

    def __call__(self, text: str | None) -> np.ndarray:
        out: set[int] = set()
        for word in set(_TERM.findall((text or "").lower())):
            ids = self.known.get(word)
            if ids is None:
                ids = _ids(word)
                if len(self.known) < self.most:
                    self.known[word] = ids
            out.update(ids)
        return np.fromiter(sorted(out), dtype=np.int32, count=len(out))


def _sums(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs, 0 for an empty run."""
    out = np.zeros((len(sizes), *values.shape[1:]), dtype=np.float64)
    full = sizes > 0
    if full.any():
        out[full] = np.add.reduceat(values, starts[full], axis=0)
    return out


class Machine:
    """bias + sum of w over terms + sum of <v_i, v_j> over pairs of terms."""

    def __init__(self, bias: float, w: np.ndarray, v: np.ndarray):
        self.bias, self.w, self.v = bias, w, v

    def margins(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if len(sizes) else np.zeros(0, np.int64)
        v = self.v[ids]
        summed = _sums(v, starts, sizes)
        pairs = 0.5 * ((summed**2).sum(axis=1) - _sums((v**2).sum(axis=1), starts, sizes))
        return self.bias + _sums(self.w[ids], starts, sizes) + pairs

    def scores(self, lists: list[np.ndarray]) -> np.ndarray:
        sizes = np.array([len(x) for x in lists], dtype=np.int64)
        ids = np.concatenate(lists) if len(lists) else np.zeros(0, np.int32)
        return 1 / (1 + np.exp(-np.clip(self.margins(ids, sizes), -40, 40)))


def _batches(rows: list[np.ndarray], random: np.random.Generator) -> Iterator[tuple]:
    """Per batch: the documents, their terms in one run, starts and lengths, terms and places."""
    order = random.permutation(len(rows))
    for at in range(0, len(rows), BATCH):
        chosen = order[at : at + BATCH]
        parts = [rows[i] for i in chosen]
        length = np.array([len(x) for x in parts], dtype=np.int64)
        flat = np.concatenate(parts)
        terms, place = np.unique(flat, return_inverse=True)
        yield chosen, flat, np.cumsum(length) - length, length, terms, place


def _error(margin: np.ndarray, y: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -40, 40))) - y


def _kept(ids: np.ndarray, sizes: np.ndarray, mask: np.ndarray) -> list[np.ndarray]:
    runs = np.split(ids, np.cumsum(sizes)[:-1])
    return [x[mask[x]] for x in runs]


def fit_machine(ids: np.ndarray, sizes: np.ndarray, y: np.ndarray, seed: int = 1) -> Machine:
    """Fit to documents given as runs of term ids. Terms of fewer than ``MIN_DOCUMENTS``
    documents keep weight 0. With no rows the score is 0.5, with one class nearly that class."""
    n, random, size = len(y), np.random.default_rng(seed), 1 << BITS
    share = (y.sum() + 0.5) / (n + 1.0)
    machine = Machine(float(np.log(share / (1 - share))), np.zeros(size), np.zeros((size, FACTORS)))
    if not len(ids) or y.min() == y.max():
        return machine
    found = np.bincount(ids, minlength=size)
    bound = L1 * EPOCHS * np.sqrt(found * share * (1 - share))
    z, squares, w = np.zeros(size), np.zeros(size), machine.w
    rows = _kept(ids, sizes, found >= MIN_DOCUMENTS)
    for _ in range(EPOCHS):
        for chosen, flat, starts, length, terms, place in _batches(rows, random):
            error = _error(machine.bias + _sums(w[flat], starts, length), y[chosen])
            machine.bias -= ALPHA * error.mean()
            g = np.bincount(place, weights=np.repeat(error, length), minlength=len(terms))
            root = np.sqrt(squares[terms] + g * g)
            z[terms] += g - (root - np.sqrt(squares[terms])) / ALPHA * w[terms]
            squares[terms] += g * g
            w[terms] = -np.sign(z[terms]) * np.maximum(np.abs(z[terms]) - bound[terms], 0) * ALPHA / (BETA + root)
    active = w != 0
    v = machine.v
    v[active] = random.normal(0, FACTOR_START, (int(active.sum()), FACTORS))
    rows, seen = _kept(ids, sizes, active), np.ones((size, 1 + FACTORS))
    for _ in range(PAIR_EPOCHS):
        for chosen, flat, starts, length, terms, place in _batches(rows, random):
            own = v[flat]
            summed = _sums(own, starts, length)
            pairs = 0.5 * ((summed**2).sum(axis=1) - _sums((own**2).sum(axis=1), starts, length))
            error = _error(machine.bias + _sums(w[flat], starts, length) + pairs, y[chosen])
            machine.bias -= RATE * error.sum() / np.sqrt(n)
            each = np.repeat(error, length)[:, None]
            g = np.concatenate([each, each * (np.repeat(summed, length, axis=0) - own)], axis=1)
            total = np.zeros((len(terms), 1 + FACTORS))
            np.add.at(total, place, g)
            total += L2 * np.column_stack([w[terms], v[terms]])
            seen[terms] += total * total
            step = RATE * 4 * total / np.sqrt(seen[terms])
            w[terms] -= step[:, 0]
            v[terms] -= 0.25 * step[:, 1:]
    return machine


def train_toxicity(
    docs: DataFrame, labels: DataFrame, max_sample: int = MAX_SAMPLE, folds: int = FOLDS, fold: int = FOLD,
    max_terms: int = MAX_TERMS,
) -> Machine:
    """Fit to at most ``max_sample`` labelled documents with ``max_terms`` terms in all, none of
    them of the held-out fold; documents are taken in the order of a hash of their ids, whole.
    Of rows that repeat an id the one with the least hash of its text counts. Null labels and
    ids are left out; null texts count as empty; other columns are not looked at."""
    seen = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_y")).where("_id is not null")
    seen = seen.where(~in_fold(F.col("_id"), folds, fold) & F.col("_y").isin(0, 1))
    sample = sample_by_hash(seen.groupBy("_id").agg(F.max("_y").alias("_y")), max_sample)
    texts = docs.select(
        F.col("doc_id").alias("_id"), F.col("text").alias("_text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_h")
    )
    chosen = texts.join(F.broadcast(sample), "_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms = Terms()
        for b in batches:
            yield pd.DataFrame({"id": b["_id"], "y": b["_y"], "h": b["_h"], "x": [terms(t) for t in b["_text"]]})

    rows = chosen.mapInPandas(run, "id long, y int, h long, x array<int>")
    rows = stored(rows.groupBy("id").agg(F.min(F.struct("h", "y", "x")).alias("r")).select("id", "r.y", "r.x"), "sample")
    # One narrow row per document of the sample.
    before = F.sum(F.size("x")).over(Window.orderBy(F.xxhash64("id"), "id"))
    fits = rows.select("id", before.alias("_terms")).where(F.col("_terms") <= max_terms).select("id")
    got = rows.join(F.broadcast(fits), "id").toArrow().sort_by("id").combine_chunks()
    x = got["x"].combine_chunks() if got.num_rows else None
    ids = x.flatten().to_numpy(zero_copy_only=False) if x is not None else np.zeros(0, np.int32)
    sizes = x.value_lengths().to_numpy(zero_copy_only=False) if x is not None else np.zeros(0, np.int64)
    return fit_machine(ids, sizes.astype(np.int64), got["y"].to_numpy().astype(np.float64))


def score_toxicity(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``score`` for each row, from its whole text; null counts as empty. The machine
    (a fixed size) is broadcast once, nothing is shuffled. An empty table gives no rows; rows
    that repeat get a score each."""
    sent = docs.sparkSession.sparkContext.broadcast(
        (machine.bias, machine.w.astype(np.float32), machine.v.astype(np.float32))
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms, model = Terms(), Machine(*sent.value)
        for b in batches:
            scores = [model.scores([terms(t) for t in b["_text"][i : i + 256]]) for i in range(0, len(b), 256)]
            yield pd.DataFrame({"_id": b["_id"], "score": np.concatenate(scores) if scores else np.zeros(0)})

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    schema = T.StructType([rows.schema["_id"], T.StructField("score", T.DoubleType())])
    return rows.mapInPandas(run, schema).withColumnRenamed("_id", id_col)


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score_toxicity(docs, train_toxicity(docs, labels))
    return scored.select(
        "doc_id",
        in_fold(F.col("doc_id"), FOLDS, FOLD).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
