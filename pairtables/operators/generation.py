"""Planning of requests, coverage of topics, and the cap per topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from pairtables import fixed_values as fixed
from pairtables.operators.lookup import lookup_join, null_key

_ROWS_PER_RANGE = 65_536
_MAX_DIGITS = 8
_ROUNDS_PER_ROW = 10_000


def split_topics(df: DataFrame, column: str = "topics") -> DataFrame:
    """Comma-separated topics as one trimmed topic per row."""
    return df.select(F.explode(F.split(column, ",")).alias("topic")).select(
        F.trim("topic").alias("topic")
    )


def topic_coverage(df: DataFrame, targets: DataFrame) -> DataFrame:
    """Per topic of ``targets``: rows produced, target and shortfall."""
    produced = df.groupBy("topic").agg(F.count("*").alias("produced"))
    return targets.join(produced, "topic", "left").select(
        "topic",
        F.coalesce("produced", F.lit(0)).alias("produced"),
        "target",
        F.greatest(F.lit(0), F.col("target") - F.coalesce("produced", F.lit(0))).alias("shortfall"),
    )


def generation_plan(
    topics: DataFrame,
    providers: list[str],
    batch_size: int = fixed.BATCH_SIZE,
    shortfall: str = "shortfall",
) -> DataFrame:
    """One request row per topic, round and provider, until the shortfall is covered.

    Every round asks each provider for one batch, and all providers count together.
    """
    per_round = len(providers) * batch_size
    asked = topics.where(F.col(shortfall) > 0).select(
        "topic", F.ceil(F.col(shortfall).cast("bigint") / per_round).cast("bigint").alias("_rounds")
    )
    # Blocks of rounds first, so that no row holds all rounds of a topic.
    first = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_rounds"), F.lit(_ROUNDS_PER_ROW).cast("bigint")))
    blocks = asked.select("topic", "_rounds", first.alias("_first"))
    last = F.least(F.col("_rounds"), F.col("_first") + (_ROUNDS_PER_ROW - 1))
    return (
        blocks.select("topic", F.explode(F.sequence("_first", last)).alias("round"))
        .select("topic", "round", F.explode(F.array(*[F.lit(p) for p in providers])).alias("model"))
        .withColumn("batch_size", F.lit(batch_size))
    )


def cap_per_topic(df: DataFrame, target: int, key: str = "record_id") -> DataFrame:
    """At most ``target`` rows per topic, those with the smallest hash of a unique key.

    Rows without a topic are one topic; a target of 0 or less leaves no rows. No topic is
    sorted as a whole. Topics are cut into hash ranges of some 65,000 rows, the
    ranges are counted, and only the one range per topic that holds the cut is ranked. The
    rest of the rows are kept or left out by comparing their hash with the cut.
    """
    if target <= 0:
        return df.where(F.lit(False))
    hashed = df.withColumn("_t", null_key("topic")).withColumn("_h", F.md5(F.col(key).cast("string")))
    totals = hashed.groupBy("_t").count()
    # log2 is exact at powers of two, so the digits grow by one at every factor of 16.
    over = totals.where(F.col("count") > target).select(
        "_t",
        F.least(
            F.lit(_MAX_DIGITS),
            F.greatest(F.lit(0), F.ceil(F.log2(F.col("count") / _ROWS_PER_RANGE) / 4)),
        )
        .cast("int")
        .alias("_digits"),
    )
    slim = lookup_join(hashed.select("_t", key, "_h"), over, ["_t"], key, "inner")
    ranges = slim.withColumn("_range", F.expr("substring(_h, 1, _digits)"))
    so_far = Window.partitionBy("_t").orderBy("_range")
    cut_range = (
        ranges.groupBy("_t", "_range")
        .count()
        .withColumn("_upto", F.sum("count").over(so_far))
        .where((F.col("_upto") >= target) & (F.col("_upto") - F.col("count") < target))
        .select("_t", "_range", (target - F.col("_upto") + F.col("count")).alias("_wanted"))
    )
    inside = lookup_join(ranges, cut_range, ["_t", "_range"], key, "inner")
    rank = F.row_number().over(Window.partitionBy("_t", "_range").orderBy("_h"))
    cut = (
        inside.withColumn("_rank", rank)
        .where(F.col("_rank") == F.col("_wanted"))
        .select("_t", F.col("_h").alias("_cut"))
    )
    marked = lookup_join(hashed, cut, ["_t"], key, "left")
    return marked.where(F.col("_cut").isNull() | (F.col("_h") <= F.col("_cut"))).select(*df.columns)
