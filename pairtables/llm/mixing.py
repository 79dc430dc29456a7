"""Mix sources to target shares of words by entropy balancing, rounded into whole copies."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from pairtables.llm.common import n_words, stored, text_key
from pairtables.operators.position import with_positions

WEIGHTS = (5, 2, 1)
#: No source and no document is taken more often than this.
MOST = 3
TOLERANCE = 1e-9
MAX_STEPS = 200
#: Cells of one level when the rounding looks for a source's cut.
CELLS = 1024
#: Single documents that are taken once more or less at the end, per source.
POLISH = 2
_ROUNDED = ("_id", "_row", "source", "size", "source_size", "target", "copies")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """``source``, ``source_size``, ``target`` from rows of ``source`` and ``size``.

    Sources in code point order, null last, weigh ``weights`` in turn and share the sum of
    all sizes. A target stops at ``most`` times its source's size; what is above goes to the
    other sources by weight, until none is above. The level (target per weight) only rises
    from round to round, so each round needs two sums over the sources and no list of them.
    """
    totals = stored(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "totals")
    named, n = with_positions(totals.where(F.col("source").isNotNull()), "source")
    ranked = named.unionByName(totals.where(F.col("source").isNull()).withColumn("position", F.lit(n)))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("position") % len(weights) + 1).cast("int"))
    ranked = stored(ranked.withColumn("_weight", weight.cast("double")).drop("position"), "sources")
    top = F.col("source_size") * F.lit(float(most))
    whole, level = ranked.agg(F.sum("source_size")).first()[0] or 0, 0.0
    while True:
        below = top < F.col("_weight") * F.lit(level)
        got = ranked.agg(
            F.sum(F.when(below, top)).alias("full"), F.sum(F.when(~below, F.col("_weight"))).alias("weight")
        ).first()
        if not got["weight"]:
            break
        new = (whole - (got["full"] or 0.0)) / got["weight"]
        if new <= level:
            break
        level = new
    return ranked.select("source", "source_size", F.least(top, F.col("_weight") * F.lit(level)).alias("target"))


def _rate(tilt: Column, x: Column, most: float) -> Column:
    return F.exp(F.least(F.lit(math.log(most)), tilt * x))


def tilts(counts: DataFrame, targets: DataFrame, most: float = MOST) -> DataFrame:
    """``source``, ``tilt``, ``fixed``: the rates of a source's documents are
    ``min(most, exp(tilt * size / mean size))``, or ``fixed`` where that is set.

    These rates change the documents least (in relative entropy, at most ``most`` each) among
    all that give the source's target. ``counts`` has ``source``, ``size``, ``n`` (documents),
    so an iteration of Newton's method on the dual, kept inside a bracket, is one aggregation
    of a table that is much smaller than the documents. The state is one stored row per source.
    """
    mean = counts.groupBy("source").agg(
        (F.sum(F.col("size") * F.col("n")) / F.sum(F.when(F.col("size") > 0, F.col("n")))).alias("mean")
    )
    known = targets.join(
        mean.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left"
    ).drop("_s")
    full = F.col("target") >= F.col("source_size") * F.lit(most * (1 - 1e-12))
    state = known.select(
        "source", "target", "mean",
        F.when(full | F.col("mean").isNull(), F.lit(float(most))).alias("fixed"),
        F.lit(0.0).alias("tilt"), F.lit(-math.inf).alias("low"), F.lit(math.inf).alias("high"),
        F.lit(math.inf).alias("gap"),
    )
    state = stored(state, "tilts")
    rows = counts.where("size > 0").withColumnRenamed("source", "_s")
    for _ in range(MAX_STEPS):
        open_ = state.where(F.col("fixed").isNull() & (F.abs("gap") > TOLERANCE))
        if open_.isEmpty():
            break
        joined = rows.join(open_, F.col("_s").eqNullSafe(F.col("source")))
        x = F.col("size") / F.col("mean")
        mass = F.col("n") * F.col("size") * _rate(F.col("tilt"), x, most)
        inside = F.col("tilt") * x < math.log(most)
        sums = joined.groupBy("source", "target", "mean", "fixed", "tilt", "low", "high").agg(
            F.sum(mass).alias("_mass"), F.sum(F.when(inside, mass * x)).alias("_slope")
        )
        over = F.col("_mass") > F.col("target")
        low, high = F.when(over, F.col("low")).otherwise(F.col("tilt")), F.when(over, F.col("tilt")).otherwise(F.col("high"))
        sums = sums.withColumns({"low": low, "high": high, "gap": F.col("_mass") / F.col("target") - 1})
        newton = F.col("tilt") - (F.col("_mass") - F.col("target")) / F.col("_slope")
        apart = F.greatest(F.lit(1.0), F.abs("tilt"))
        middle = (
            F.when(F.col("low") == -math.inf, F.col("high") - apart)
            .when(F.col("high") == math.inf, F.col("low") + apart)
            .otherwise((F.col("low") + F.col("high")) / 2)
        )
        good = F.col("_slope").isNotNull() & (newton > F.col("low")) & (newton < F.col("high"))
        moved = F.when(F.abs("gap") <= TOLERANCE, F.col("tilt")).when(good, newton).otherwise(middle)
        # A bracket without a number inside is as near as doubles come.
        stuck = F.when((moved <= F.col("low")) | (moved >= F.col("high")), F.lit(0.0)).otherwise(F.col("gap"))
        done = sums.withColumn("_moved", moved).withColumn("gap", stuck).withColumn("tilt", F.col("_moved"))
        rest = state.where(F.col("fixed").isNotNull() | (F.abs("gap") <= TOLERANCE))
        state = stored(rest.unionByName(done.select(*state.columns)), "tilts")
    else:
        if not state.where(F.col("fixed").isNull() & (F.abs("gap") > TOLERANCE)).isEmpty():
            raise RuntimeError(f"tilts have not converged after {MAX_STEPS} steps")
    return state.select("source", "mean", "tilt", "fixed")


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, id_col: str = "doc_id",
    text_col: str = "text", source_col: str = "source", row: Column | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken, copies.

    ``size`` is the number of words (null text: 0). Rates from :func:`tilts` are rounded to
    whole copies: the whole part, and one more for the documents of a source with the
    smallest ``random number - rest``, as many as bring the source nearest to its target; then
    ``POLISH`` single documents make up for what is missing. The random number comes from id and text, so
    reruns agree; rows that repeat both count one by one. Null sources are one source; a
    document without words has one copy and takes nothing. An empty table gives no rows. A column ``row`` that numbers the
    rows is returned as ``_row``.
    """
    u = F.pmod(F.xxhash64(F.lit(11), F.col(id_col), *text_key(F.col(text_col))), F.lit(2**53)) / F.lit(float(2**53))
    sizes = stored(
        docs.select(
            F.col(id_col).alias("_id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"),
            u.alias("_u"), (F.monotonically_increasing_id() if row is None else row).alias("_row"),
        ),
        "sizes",
    )
    counts = stored(sizes.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "counts")
    targets = stored(source_targets(counts.select("source", (F.col("size") * F.col("n")).alias("size")), weights, most), "targets")
    tilted = tilts(counts, targets, most)
    known = targets.join(
        tilted.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))
    ).drop("_s").withColumnRenamed("source", "_source")
    rate = F.coalesce("fixed", _rate(F.col("tilt"), F.col("size") / F.col("mean"), most))
    rated = sizes.join(known, F.col("source").eqNullSafe(F.col("_source"))).withColumn("_rate", rate)
    whole = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.floor(F.col("_rate") + 1e-9)).cast("long")
    rest = F.greatest(F.lit(0.0), F.col("_rate") - F.col("_whole"))
    rated = rated.withColumn("_whole", whole).withColumn("_k", (F.col("_u") - rest + 1) / 2)
    rated = stored(
        rated.select("_id", "_row", "source", "size", "source_size", "target", "_whole", "_k"), "rates"
    )
    rounded = _rounded(rated, most)
    for _ in range(POLISH):
        rounded = _polished(stored(rounded.select(*_ROUNDED), "copies"), most)
    return rounded.select(
        F.col("_id").alias(id_col), "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"), "copies", *([] if row is None else ["_row"]),
    )


def _rounded(rated: DataFrame, most: int) -> DataFrame:
    """Add ``copies``. The cut between documents that get one more copy and those that don't
    is found per source by two levels of cell sums; only the documents of the last cell,
    about two in ``CELLS`` squared, are put in order."""
    may = (F.col("size") > 0) & (F.col("_whole") < most)
    cell = F.least(F.floor(F.col("_k") * CELLS * CELLS), F.lit(CELLS * CELLS - 1)).cast("int")
    rated = rated.withColumn("_cell", F.when(may, cell))
    need = rated.groupBy("source").agg((F.first("target") - F.sum(F.col("size") * F.col("_whole"))).alias("_need"))
    fine = rated.where("_cell is not null").groupBy("source", "_cell").agg(F.sum("size").alias("_sum"))
    fine = stored(fine, "cells")
    coarse = fine.groupBy("source", F.floor(F.col("_cell") / CELLS).cast("int").alias("_at")).agg(F.sum("_sum").alias("_sum"))
    first = _crossing(coarse, need.withColumn("_before", F.lit(0)))
    inner = fine.join(
        first.select(F.col("source").alias("_s"), F.col("_at").alias("_c")),
        F.col("source").eqNullSafe(F.col("_s")) & (F.floor(F.col("_cell") / CELLS) == F.col("_c")),
    ).select("source", F.col("_cell").alias("_at"), "_sum")
    second = _crossing(inner, first.drop("_at"))
    cuts = stored(
        need.select("source").alias("n").join(second.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left")
        .select(F.col("source").alias("_s"), F.col("_at").alias("_cut"), F.col("_need").alias("_left"), "_before"),
        "cuts",
    )
    split = rated.join(cuts, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    # Without a cut the need is not above 0, or every document is taken once more.
    wanting = need.withColumnRenamed("source", "_s").withColumnRenamed("_need", "_want")
    split = split.join(wanting, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    at_cut = F.col("_cell").isNotNull() & F.col("_cut").isNotNull() & (F.col("_cell") == F.col("_cut"))
    more = F.col("_cell").isNotNull() & F.when(
        F.col("_cut").isNull(), F.col("_want") > 0
    ).otherwise(F.col("_cell") < F.col("_cut"))
    order = Window.partitionBy("source").orderBy("_k", F.col("_id").asc_nulls_last(), "_row")
    run = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    # One more as long as that brings the sum nearer to what is needed.
    nearer = F.col("_before") + F.col("_run") - F.col("size") / 2 <= F.col("_left")
    last = split.where(at_cut).withColumn("_run", run).withColumn("copies", F.col("_whole") + nearer.cast("long")).drop("_run")
    others = split.where(~at_cut).withColumn("copies", F.col("_whole") + more.cast("long"))
    return others.unionByName(last)


def _polished(rounded: DataFrame, most: int) -> DataFrame:
    """Take one document of each source once more or once less, if that brings the source
    nearer to its target: the one whose size is nearest to what the source misses."""
    missing = rounded.groupBy("source").agg((F.first("target") - F.sum(F.col("size") * F.col("copies"))).alias("_miss"))
    missing = missing.withColumnRenamed("source", "_s")
    rows = rounded.join(missing, F.col("source").eqNullSafe(F.col("_s")))
    up = F.col("_miss") > 0
    may = F.when(up, F.col("copies") < most).otherwise(F.col("copies") > 0)
    left = F.abs(F.abs("_miss") - F.col("size"))
    best = F.min(F.struct(left.alias("left"), F.col("_row").alias("row"), up.alias("up"))).alias("_b")
    steps = rows.where(may & (left < F.abs("_miss"))).groupBy("source").agg(best)
    steps = steps.select(F.col("_b.row").alias("_r"), F.when(F.col("_b.up"), 1).otherwise(-1).alias("_step"))
    out = rounded.join(steps, F.col("_row") == F.col("_r"), "left")
    return out.withColumn("copies", F.col("copies") + F.coalesce("_step", F.lit(0)))


def _crossing(cells: DataFrame, need: DataFrame) -> DataFrame:
    """Per source the first cell at which the running sum reaches what is needed; at most
    ``CELLS`` cells of a source are put in order."""
    order = Window.partitionBy("source").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    need = need.withColumnRenamed("source", "_s")
    summed = cells.withColumn("_run", F.sum("_sum").over(order)).join(need, F.col("source").eqNullSafe(F.col("_s")))
    total = F.col("_before") + F.col("_run")
    crossed = summed.where((F.col("_need") > 0) & (total >= F.col("_need")))
    least = crossed.groupBy("source").agg(F.min(F.struct("_at", "_run", "_sum", "_before", "_need")).alias("_m"))
    return least.select(
        "source", F.col("_m._at").alias("_at"),
        (F.col("_m._before") + F.col("_m._run") - F.col("_m._sum")).alias("_before"), F.col("_m._need").alias("_need"),
    )


TAKEN = ("size", "source_size", "target", "taken", "copies")


def take_mix(docs: DataFrame, **settings) -> DataFrame:
    """The documents of the mix: the columns of ``docs``, then size, source_size, target, taken,
    copies. Documents with 0 copies are not in it.

    A column of ``docs`` that has one of these names gives way; others may be called anything.
    Null and empty texts have size 0 and one copy; null ids and sources, repeated rows and empty
    tables are treated as :func:`mix_sources` says.
    """
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    numbered = stored(docs.select(doc, F.monotonically_increasing_id().alias("_at")), "numbered")
    flat = numbered.select("_doc.doc_id", "_doc.text", "_doc.source", "_at")
    mix = mix_sources(flat, row=F.col("_at"), **settings).where("copies > 0").select("_row", F.struct(*TAKEN).alias("_mix"))
    own = [F.col("_doc").getField(c).alias(c) for c in docs.columns if c not in TAKEN]
    return numbered.join(mix, F.col("_at") == F.col("_row")).select(*own, "_mix.*")


def op6_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet"))
