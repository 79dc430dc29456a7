"""Metric means, the acceptance gate, comparisons and metric logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pairtables import fixed_values as fixed
from pairtables.operators.lexical import bleu_of_sums, bleu_sums, lexical_scores


def score(df: DataFrame, scorers: dict[str, Column]) -> DataFrame:
    """Add one column per scorer over ``inputs``, ``outputs`` and ``targets``, in one step.

    A scorer is a column expression, or a pandas UDF applied to columns.
    """
    return df.withColumns(scorers)


def metric_means(
    df: DataFrame, metrics: dict[str, str], by: list[str] | None = None, bleu: bool = False
) -> DataFrame:
    """Mean and number of scored rows of every metric, as ``(…by, metric, value, n)``.

    ``metrics`` maps a metric's name to its column; ``bleu`` adds corpus BLEU of rows that
    hold ``bleu_stats``. Everything comes from one aggregation, so that scores are computed
    once; its one row per group is turned into one row per metric afterwards.
    """
    by = by or []
    aggregates, found = [], []
    for i, (name, column) in enumerate(metrics.items()):
        aggregates.append(F.avg(F.col(column).cast("double")).alias(f"_v{i}"))
        aggregates.append(F.count(column).alias(f"_n{i}"))
        found.append((name, F.col(f"_v{i}"), F.col(f"_n{i}")))
    if bleu:
        aggregates += bleu_sums()
        found.append(("bleu", bleu_of_sums(), F.col("_bleu_n")))
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("metric"), value.alias("value"), n.alias("n"))
            for name, value, n in found
        ]
    )
    return df.groupBy(*by).agg(*aggregates).select(*by, F.inline(rows))


def check_thresholds(
    metrics: DataFrame, thresholds: dict[str, float] | None = None, by: str = "source"
) -> DataFrame:
    """PASS, FAIL or N/A per source and threshold.

    A metric that is missing does not fail the gate; ``n_missing`` shows how many were.
    The metric table is an aggregate with a few rows per source. One aggregation per source
    looks up every threshold, so no join and no list of sources is needed.
    """
    wanted = list((fixed.THRESHOLDS if thresholds is None else thresholds).items())
    if not wanted:  # no gate, no rows
        return check_thresholds(metrics, fixed.THRESHOLDS, by).where(F.lit(False))
    values = [
        F.max(F.when(F.col("metric") == fixed.METRIC_OF_THRESHOLD.get(name, name), F.col("value")))
        for name, _ in wanted
    ]
    per_source = metrics.groupBy(by).agg(*[v.alias(f"_v{i}") for i, v in enumerate(values)])
    passed = [F.col(f"_v{i}") >= F.lit(float(least)) for i, (_, least) in enumerate(wanted)]
    all_pass, missing = F.lit(True), F.lit(0)
    for i, ok in enumerate(passed):
        all_pass = all_pass & F.coalesce(ok, F.lit(True))
        missing = missing + F.col(f"_v{i}").isNull().cast("int")
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("threshold_name"),
                F.col(f"_v{i}").alias("value"),
                F.lit(float(least)).alias("threshold"),
                F.when(passed[i].isNull(), "N/A").when(passed[i], "PASS").otherwise("FAIL").alias("status"),
            )
            for i, (name, least) in enumerate(wanted)
        ]
    )
    return per_source.select(by, F.inline(rows), all_pass.alias("all_pass"), missing.alias("n_missing"))


def compare_sources(metrics: DataFrame, names: list[str], by: str = "source") -> DataFrame:
    """Sources side by side: one row per source, one column per named metric."""
    return metrics.groupBy(by).pivot("metric", names).agg(F.first("value"))


def source_summary(gate: DataFrame, by: str = "source") -> DataFrame:
    """ALL PASSED or SOME FAILED per source."""
    passed = F.bool_and("all_pass")
    return gate.groupBy(by).agg(
        F.when(passed, "ALL PASSED").otherwise("SOME FAILED").alias("summary")
    )


def eval_results(
    df: DataFrame, judged: DataFrame | None = None, key: str = "record_id"
) -> DataFrame:
    """Per-row table: the row, its prediction and every score."""
    scored = lexical_scores(df)
    return scored if judged is None else scored.join(judged, key, "left")


def sample_rows(df: DataFrame, n: int = 3, order_by: str = "record_id") -> DataFrame:
    """The first ``n`` rows by key."""
    return df.orderBy(order_by).limit(n)


def metrics_long(df: DataFrame, entry: str, step: str = "step") -> DataFrame:
    """Log entries as ``(…, step, key, value)``: numbers only, without the step itself.

    An entry is a map, or JSON text. In JSON a number in quotes is text and is left out, and
    a truth value counts as 1 or 0.
    """
    rest = [c for c in df.columns if c != entry]
    if isinstance(df.schema[entry].dataType, T.MapType):
        pairs = df.select(
            *rest, F.col(entry)[step].try_cast("long").alias("step"), F.explode(entry).alias("key", "_text")
        ).withColumn("value", F.col("_text").try_cast("double"))
    else:
        # With explode_outer the optimizer adds no filter that would parse the entry again.
        parsed = F.from_json(entry, "map<string,variant>")
        exploded = df.select(*rest, parsed.alias("_map")).select(
            *rest,
            F.try_variant_get(F.col("_map")[step], "$", "bigint").alias("step"),
            F.explode_outer("_map").alias("key", "_value"),
        )
        numeric = F.schema_of_variant("_value").rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL|BOOLEAN)")
        pairs = exploded.withColumn(
            "value", F.when(numeric, F.try_variant_get("_value", "$", "double"))
        )
    return pairs.where((F.col("key") != step) & F.col("value").isNotNull()).select(
        *rest, "step", "key", "value"
    )


def params_long(df: DataFrame, params: dict[str, Column]) -> DataFrame:
    """Parameters of each row's run as ``(…, key, value)``, values as text."""
    entries = F.array(
        *[
            F.struct(F.lit(key).alias("key"), value.cast("string").alias("value"))
            for key, value in params.items()
        ]
    )
    return df.select(*df.columns, F.inline(entries))
