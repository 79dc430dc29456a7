"""ROUGE, BLEU and token counts over ``targets`` and ``outputs``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pairtables.functions.overlap import overlap_counts
from pairtables.functions.text import tokens

_BLEU_N = 4
#: The counts that corpus BLEU is made of.
BLEU_PARTS = ["target_tokens", "output_tokens"] + [
    f"{kind}{n}" for kind in ("overlap", "grams") for n in range(1, _BLEU_N + 1)
]


def _grams(size: Column, n: int) -> Column:
    return F.greatest(size - (n - 1), F.lit(0))


def _share(part: Column, whole: Column) -> Column:
    return F.when(part.isNull(), F.lit(None)).when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _f1(p: Column, r: Column) -> Column:
    return F.when(p.isNull(), F.lit(None)).when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))


def _with_prf(df: DataFrame, name: str, shared: Column, outputs: Column, targets: Column) -> DataFrame:
    parts = df.withColumns(
        {f"{name}_precision": _share(shared, outputs), f"{name}_recall": _share(shared, targets)}
    )
    return parts.withColumn(name, _f1(F.col(f"{name}_precision"), F.col(f"{name}_recall")))


def with_counts(df: DataFrame, max_n: int = 0, lcs: bool = False) -> DataFrame:
    """Add ``_c``, the counts every score below is made of. One pass, no shuffle."""
    return df.withColumn("_c", overlap_counts(F.col("targets"), F.col("outputs"), max_n, lcs))


def _rouge_n(df: DataFrame, n: int) -> DataFrame:
    return _with_prf(
        df,
        f"rouge{n}",
        F.col(f"_c.overlap{n}"),
        _grams(F.col("_c.output_tokens"), n),
        _grams(F.col("_c.target_tokens"), n),
    )


def _rouge_l(df: DataFrame) -> DataFrame:
    return _with_prf(
        df, "rougeL", F.col("_c.lcs"), F.col("_c.output_tokens"), F.col("_c.target_tokens")
    )


def rouge_n(df: DataFrame, *ns: int) -> DataFrame:
    """Add precision, recall and F1 of shared n-grams, for each ``n``."""
    scored = with_counts(df, max_n=max(ns))
    for n in ns:
        scored = _rouge_n(scored, n)
    return scored.drop("_c")


def rouge_l(df: DataFrame) -> DataFrame:
    """Add precision, recall and F1 of the longest common subsequence."""
    return _rouge_l(with_counts(df, lcs=True)).drop("_c")


def token_count(df: DataFrame, column: str = "outputs") -> DataFrame:
    """Add the number of word tokens."""
    return df.withColumn("token_count", F.size(tokens(F.col(column))).cast("long"))


def lexical_scores(df: DataFrame) -> DataFrame:
    """Add ``rouge1``, ``rouge2``, ``rougeL``, ``token_count`` and ``bleu_stats``, in one pass."""
    scored = with_counts(df, max_n=_BLEU_N, lcs=True)
    scored = _rouge_l(_rouge_n(_rouge_n(scored, 1), 2))
    return scored.withColumns(
        {"token_count": F.col("_c.output_tokens"), "bleu_stats": _bleu_stats()}
    ).select(*df.columns, "rouge1", "rouge2", "rougeL", "token_count", "bleu_stats")


def _bleu_stats() -> Column:
    fields = [F.col("_c.target_tokens"), F.col("_c.output_tokens")]
    fields += [F.col(f"_c.overlap{n}") for n in range(1, _BLEU_N + 1)]
    fields += [_grams(F.col("_c.output_tokens"), n).alias(f"grams{n}") for n in range(1, _BLEU_N + 1)]
    return F.struct(*fields)


def bleu_sums() -> list[Column]:
    """Aggregates over ``bleu_stats``: counts are summed before they are divided."""
    sums = [F.sum(f"bleu_stats.{name}").alias(f"_{name}") for name in BLEU_PARTS]
    return [*sums, F.count("bleu_stats.output_tokens").alias("_bleu_n")]


def bleu_of_sums() -> Column:
    """Corpus BLEU from the columns of :func:`bleu_sums`."""
    ratios = [F.col(f"_overlap{n}") / F.col(f"_grams{n}") for n in range(1, _BLEU_N + 1)]
    logs = sum((F.ln(ratio) for ratio in ratios), F.lit(0.0))
    brevity = F.when(F.col("_output_tokens") > F.col("_target_tokens"), F.lit(1.0)).otherwise(
        F.exp(1 - F.col("_target_tokens") / F.col("_output_tokens"))
    )
    all_hit = F.least(*[F.col(f"_overlap{n}") for n in range(1, _BLEU_N + 1)]) > 0
    value = F.when(all_hit, 100 * brevity * F.exp(logs / _BLEU_N)).otherwise(F.lit(0.0))
    return F.when(F.col("_bleu_n") > 0, value)


def corpus_bleu(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Corpus BLEU, 0 to 100, with n-grams of 1 to 4 words and no smoothing."""
    stats = with_counts(df, max_n=_BLEU_N).withColumn("bleu_stats", _bleu_stats())
    return (
        stats.groupBy(*(by or []))
        .agg(*bleu_sums())
        .select(*(by or []), bleu_of_sums().alias("bleu"), F.col("_bleu_n").alias("n"))
    )
