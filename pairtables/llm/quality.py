"""Text quality from trusted positives and unlabelled text: non-negative PU learning."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from pairtables.llm.common import WORD, in_fold, sample_by_hash

FOLDS, FOLD = 4, 2
THRESHOLD = 0.7
#: Rows of the two training samples: trusted positives and unlabelled texts, each at most.
MAX_SAMPLE = 12_000
#: Quantiles that bound a feature's bins, closer at both ends.
CUTS = (0.005, 0.01, 0.02, 0.04, 0.07, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.85, 0.9, 0.93, 0.96, 0.98, 0.99, 0.995)
BINS = len(CUTS) + 1
#: Steps with the logistic loss, then with the sigmoid loss.
STEPS, RATE, DECAY = (250, 500), 0.05, 3e-3

_WORD = re.compile(WORD)
FEATURES = 21
#: Kinds of characters: 0 other, 1 lower case or caseless letter, 2 upper case, 3 digit,
#: 4 common mark, 5 other mark, 6 white space. The table covers Latin; a character beyond
#: it counts as a letter.
_PLAIN = ".,;:!?'\"()-"


def _kind(c: str) -> int:
    if c.isspace():
        return 6
    if c.isalpha():
        return 2 if c.isupper() else 1
    return 3 if c.isdigit() else 4 if c in _PLAIN else 5


_TABLE = np.array([*[_kind(chr(i)) for i in range(0x250)], 1], dtype=np.uint8)


def features(text: str | None) -> list[float]:
    """Numbers on the shape of a whole text; all 0 for an empty one."""
    words = _WORD.findall(text or "")
    if not words:
        return [0.0] * FEATURES
    n, chars = len(words), len(text)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kinds = np.bincount(_TABLE[np.minimum(points, 0x250)], minlength=7)
    letters, upper, digits, plain, odd = int(kinds[1] + kinds[2]), int(kinds[2]), int(kinds[3]), int(kinds[4]), int(kinds[5])
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    fives = set(zip(words, words[1:], words[2:], words[3:], words[4:]))
    lines = [x for x in text.split("\n") if x.strip()]
    return [
        np.log1p(n), np.log1p(chars), float(lengths.mean()), float(lengths.std()), float((lengths <= 3).sum()) / n,
        letters / chars, digits / chars, plain / chars, odd / chars, upper / max(1, letters),
        sum(c for w, c in counts.items() if not w[-1].isalnum() and w[-1] not in _PLAIN) / n,
        sum(c for w, c in counts.items() if w[-1] in ".!?") / n, text.count(",") / n, text.count("|") / n,
        len(counts) / n, len(counts) / n**0.5, counts.most_common(1)[0][1] / n, len(fives) / max(1, n - 4),
        len(set(lines)) / max(1, len(lines)), np.log1p(n / max(1, len(lines))),
        sum(c for w, c in counts.items() if w[0].isupper()) / n,
    ]


class PuModel:
    """An additive model: one weight per feature and quantile bin."""

    def __init__(self, edges: list[np.ndarray], weights: np.ndarray, bias: float):
        self.edges, self.weights, self.bias = edges, weights, bias

    def bins(self, x: np.ndarray) -> np.ndarray:
        """Column of each row's bin, per feature."""
        return np.stack(
            [np.searchsorted(e, x[:, j], side="right") + j * BINS for j, e in enumerate(self.edges)], axis=1
        )

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = self.weights[self.bins(x)].sum(axis=1) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_pu(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> PuModel:
    """Minimise the non-negative unbiased risk (Kiryo et al. 2017):
    prior * R+(positive) + max(0, R-(unlabelled) - prior * R-(positive)). Where the second part
    is below 0, its gradient is followed upwards. The logistic loss leads to the neighbourhood;
    the sigmoid loss, which is bounded, ends there: with it the difference of the two risks
    has little noise. Without either sample the score is the prior.
    """
    bias = float(np.log(prior / (1 - prior)))
    if not len(positive) or not len(unlabelled):
        return PuModel([np.zeros(0)] * FEATURES, np.zeros(FEATURES * BINS), bias)
    both = np.concatenate([positive, unlabelled])
    edges = [np.unique(np.quantile(both[:, j], CUTS)) for j in range(FEATURES)]
    model = PuModel(edges, np.zeros(FEATURES * BINS), bias)
    p, u = model.bins(positive), model.bins(unlabelled)
    theta = np.zeros(FEATURES * BINS + 1)
    theta[-1] = bias
    first, second = np.zeros_like(theta), np.zeros_like(theta)

    def gradient(rows: np.ndarray, slope: np.ndarray) -> np.ndarray:
        g = np.bincount(rows.ravel(), weights=np.repeat(slope, FEATURES), minlength=FEATURES * BINS)
        return np.append(g, slope.sum()) / len(rows)

    for step in range(1, sum(STEPS) + 1):
        zp, zu = theta[p].sum(axis=1) + theta[-1], theta[u].sum(axis=1) + theta[-1]
        sp, su = 1 / (1 + np.exp(-np.clip(zp, -40, 40))), 1 / (1 + np.exp(-np.clip(zu, -40, 40)))
        if step <= STEPS[0]:
            rest = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            up, down, down_u = sp - 1, sp, su
        else:
            rest = su.mean() - prior * sp.mean()
            up, down, down_u = -sp * (1 - sp), sp * (1 - sp), su * (1 - su)
        g = gradient(u, down_u) - prior * gradient(p, down)
        g = prior * gradient(p, up) + g if rest >= 0 else -g
        g[:-1] += DECAY * theta[:-1]
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        theta -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    model.weights, model.bias = theta[:-1], float(theta[-1])
    return model


def _matrix(texts: DataFrame) -> np.ndarray:
    """Features of a bounded sample, computed where its rows are read. Of rows that repeat an id
    the one with the least hash of its text counts, so there are no more rows than ids."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b["_id"], "h": b["_h"], "x": [features(t) for t in b["_text"]]})

    hashed = texts.withColumn("_h", F.xxhash64(F.coalesce("_text", F.lit(""))))
    rows = hashed.mapInPandas(run, "id long, h long, x array<double>")
    rows = rows.groupBy("id").agg(F.min(F.struct("h", "x")).alias("r")).select("id", F.col("r.x").alias("x"))
    found = rows.toArrow().sort_by("id")
    return np.array(found["x"].to_pylist(), dtype=np.float64).reshape(-1, FEATURES)


def train_quality(
    docs: DataFrame, labels: DataFrame, max_sample: int = MAX_SAMPLE, folds: int = FOLDS, fold: int = FOLD
) -> PuModel:
    """Fit on two samples of at most ``max_sample`` rows: documents that are labelled 1, and
    documents whatever their label is, as in case-control PU learning. Rows of the held-out fold
    are in neither. The class prior is the share of label 1 among all labels of the other folds
    (one of a thousand is added to either side). Null labels and ids are left out, of rows that
    repeat an id one counts, null texts count as empty, other columns are not looked at."""
    seen = labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("_y")).where("_id is not null")
    seen = seen.where(~in_fold(F.col("_id"), folds, fold) & F.col("_y").isin(0, 1))
    got = seen.agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("y")).first()
    prior = ((got["y"] or 0) + 0.001 * got["n"] + 1e-6) / (1.002 * got["n"] + 2e-6)
    texts = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    good = sample_by_hash(seen.where("_y = 1").select("_id").distinct(), max_sample)
    free = texts.select("_id").where(F.col("_id").isNotNull() & ~in_fold(F.col("_id"), folds, fold))
    other = sample_by_hash(free.distinct(), max_sample)
    # At most max_sample ids: the documents are scanned, not shuffled.
    samples = [_matrix(texts.join(F.broadcast(s), "_id", "left_semi")) for s in (good, other)]
    return fit_pu(*samples, prior)


def score_quality(docs: DataFrame, model: PuModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``score`` for each row, from its whole text; null counts as empty. Nothing is
    shuffled. An empty table gives no rows; rows that repeat get a score each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = np.array([features(t) for t in b["_text"]], dtype=np.float64).reshape(-1, FEATURES)
            yield pd.DataFrame({"_id": b["_id"], "score": model.scores(x)})

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    schema = T.StructType([rows.schema["_id"], T.StructField("score", T.DoubleType())])
    return rows.mapInPandas(run, schema).withColumnRenamed("_id", id_col)


def keep_good(docs: DataFrame, model: PuModel, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with all their columns under their names.

    Each row is judged by its own text, so ids may be null or repeat; a null text counts as empty.
    An empty table gives no rows.
    """

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        x = np.array([features(t) for t in texts], dtype=np.float64).reshape(-1, FEATURES)
        return pd.Series(model.scores(x))

    return docs.where(score(F.col(text_col)) >= threshold)


def op7_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score_quality(docs, train_quality(docs, labels))
    return scored.select(
        "doc_id",
        in_fold(F.col("doc_id"), FOLDS, FOLD).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
