"""Benchmark passages in training texts, found by spaced seeds and checked word by word."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pairtables.llm.common import stored, text_key

#: Words at a 1 are hashed, words at a 0 may differ. Any 13 aligned words of which 2 differ
#: and any 15 of which 3 differ hold one of these masks intact. All start with a pair, which
#: lets most positions be passed over at the price of one hash.
MASKS = ("11011", "11101", "1101101")
#: Shorter benchmark items have no masks; all their words in a row are their one seed.
MIN_WORDS = 8
#: Words on either side of a seed that are compared.
AROUND = 16
#: An overlap is a hit from this many words on, counted as matches less mismatches, or from
#: this share of a shorter item.
MIN_SCORE, MIN_SHARE = 12, 0.7
#: Up to these numbers pairs go to the tasks as a set and seeds as a broadcast table (24 bytes
#: each); a larger benchmark is joined by a shuffle of all positions.
MAX_PAIRS, MAX_SEEDS = 200_000, 1_000_000


#: Scripts that put no spaces between words: each character is a token.
_SPACELESS = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}"
_TOKEN = rf"[{_SPACELESS}&&[\p{{L}}\p{{N}}]]|[\p{{L}}\p{{N}}&&[^{_SPACELESS}]]+"


_PLAIN = r"[\p{L}\p{N}]+"
#: All of those scripts lie beyond this block; other texts are cut by the plain pattern.
_FAR = r"[^\x{0}-\x{DFF}]"


def _tokens(text: Column) -> Column:
    text = F.lower(F.coalesce(text, F.lit("")))
    plain = F.regexp_extract_all(text, F.lit(_PLAIN), F.lit(0))
    return F.when(F.rlike(text, F.lit(_FAR)), F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))).otherwise(plain)


def _pair(words: Column, at: Column) -> Column:
    return F.xxhash64(F.get(words, at), F.get(words, at + 1))


def _seeds(words: Column, at: Column, lengths: tuple[int, ...] | list[int] = ()) -> Column:
    """Hashes of the masks that fit at a position, then of runs of the given lengths; null for
    those that do not fit."""
    found = []
    for number, mask in enumerate([*MASKS, *("1" * n for n in lengths)]):
        number = number if number < len(MASKS) else -len(mask)
        picked = [F.get(words, at + i) for i, bit in enumerate(mask) if bit == "1"]
        found.append(F.when(at + len(mask) <= F.size(words), F.xxhash64(F.lit(number), *picked)))
    return F.array(*found)


def _overlap(doc_words: Column, item_words: Column, offset: Column) -> Column:
    """Best sum over a run of aligned words, +1 for equal and -1 for different words."""
    equal = F.transform(doc_words, lambda w, i: F.coalesce(w == F.get(item_words, i + offset), F.lit(False)))
    return F.aggregate(
        equal,
        F.struct(F.lit(0).alias("run"), F.lit(0).alias("best")),
        lambda acc, same: F.struct(
            F.greatest(F.lit(0), acc["run"] + F.when(same, 1).otherwise(-1)).alias("run"),
            F.greatest(acc["best"], acc["run"] + F.when(same, 1).otherwise(-1)).alias("best"),
        ),
        lambda acc: acc["best"],
    )


def _whole_lines(docs: DataFrame, items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Documents (``_i``, ``_e1``, ``_e2``) and short items (``_r``) that are all words of one of
    their lines, or of the text."""
    keys = [F.col(id_col).alias("_i"), *[k.alias(n) for k, n in zip(text_key(F.col(text_col)), ("_e1", "_e2"))]]
    parts = F.concat(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1), F.array(F.col(text_col)))
    lines = docs.select(*keys, F.explode(F.array_distinct(parts)).alias("_line"))
    lines = lines.select("_i", "_e1", "_e2", _tokens(F.col("_line")).alias("_own"))
    lines = lines.where((F.size("_own") > 0) & (F.size("_own") < MIN_WORDS)).withColumn("_run", F.xxhash64("_own"))
    short = items.where(F.size("_item") < MIN_WORDS).select(F.col("_row").alias("_r"), "_item")
    short = short.withColumn("_run", F.xxhash64("_item"))
    joined = lines.join(F.broadcast(short) if short.count() <= MAX_SEEDS else short, "_run")
    return joined.where("_own = _item").select("_i", "_e1", "_e2", "_r").distinct()


def _hits(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, short_items: bool) -> DataFrame:
    """``_id``, ``_d1``, ``_d2`` (the document's text), ``item_id``, ``score``, ``item_words``, ``removes``.

    Documents are read and cut into words once; long and short items are seeds of one table.
    """
    numbered = benchmark.select(
        F.monotonically_increasing_id().alias("_row"), F.col("item_id"), _tokens(F.col("text")).alias("_item")
    )
    items = stored(numbered.where(F.size("_item") >= (1 if short_items else MIN_WORDS)), "items")
    long, short = items.where(F.size("_item") >= MIN_WORDS), items.where(F.size("_item") < MIN_WORDS)
    lengths = sorted(r[0] for r in short.select(F.size("_item")).distinct().collect())
    places = long.select("_row", F.posexplode("_item").alias("_at", "_w"), "_item")
    seeds = places.select("_row", "_at", F.explode(_seeds(F.col("_item"), F.col("_at"))).alias("_seed"))
    if lengths:
        runs = F.array_compact(F.slice(_seeds(F.col("_item"), F.lit(0), lengths), len(MASKS) + 1, len(lengths)))
        own = short.select("_row", F.lit(0).alias("_at"), F.element_at(runs, -1).alias("_seed"))
        seeds = seeds.unionByName(own)
    seeds = stored(seeds.where("_seed is not null").distinct(), "seeds")
    pairs = places.where(F.col("_at") + 1 < F.size("_item")).select(_pair(F.col("_item"), F.col("_at")).alias("_p"))
    some = [r[0] for r in pairs.distinct().limit(MAX_PAIRS + 1).collect()]
    heads = short.select(F.xxhash64(F.get("_item", F.lit(0)))).distinct().limit(MAX_PAIRS + 1).collect()
    words = docs.select(
        F.col(id_col).alias("_id"), *[k.alias(n) for k, n in zip(text_key(F.col(text_col)), ("_d1", "_d2"))],
        _tokens(F.col(text_col)).alias("_words"),
    )
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("_words") - 1))
    if len(some) <= MAX_PAIRS and len(heads) <= MAX_PAIRS:
        first = [r[0] for r in heads]

        def wanted(i: Column) -> Column:
            known = _pair(F.col("_words"), i).isin(some)
            return known | F.xxhash64(F.get("_words", i)).isin(first) if first else known

        starts = F.filter(starts, wanted)
    # The outer form keeps the optimizer from evaluating the array twice.
    found = words.select("_id", "_d1", "_d2", "_words", F.explode_outer(starts).alias("_pos")).where("_pos is not null")
    first = F.greatest(F.lit(0), F.col("_pos") - AROUND)
    around = F.slice("_words", first + 1, 2 * AROUND + max(map(len, MASKS)))
    found = found.select(
        "_id", "_d1", "_d2", (F.col("_pos") - first).alias("_lead"), around.alias("_near"),
        F.explode(_seeds(F.col("_words"), F.col("_pos"), lengths)).alias("_seed"),
    ).where("_seed is not null")
    joined = found.join(F.broadcast(seeds) if seeds.count() <= MAX_SEEDS else seeds, "_seed").drop("_seed")
    n = F.size("_item")
    overlap = _overlap(F.col("_near"), F.col("_item"), F.col("_at") - F.col("_lead"))
    exact = F.when(F.slice("_near", F.col("_lead") + 1, n) == F.col("_item"), n).otherwise(0)
    checked = joined.join(items, "_row").select(
        "_id", "_d1", "_d2", "_row", "item_id", n.alias("item_words"),
        F.when(n < MIN_WORDS, exact).otherwise(overlap).alias("score"),
    )
    best = checked.groupBy("_id", "_d1", "_d2", "_row").agg(
        F.max("score").cast("long").alias("score"), F.first("item_words").cast("long").alias("item_words"),
        F.first("item_id").alias("item_id"),
    )
    is_long = F.col("item_words") >= MIN_WORDS
    enough = F.least(F.lit(MIN_SCORE), F.ceil(F.col("item_words") * F.when(is_long, MIN_SHARE).otherwise(1.0)))
    best = best.where(F.col("score") >= enough)
    if not lengths:
        return best.withColumn("removes", F.lit(True))
    same = F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_d1") == F.col("_e1")) & (F.col("_d2") == F.col("_e2"))
    whole = _whole_lines(docs, items, id_col, text_col)
    best = best.join(whole, same & (F.col("_row") == F.col("_r")), "left")
    return best.withColumn("removes", is_long | F.col("_r").isNotNull()).drop("_i", "_e1", "_e2", "_r")


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", short_items: bool = False
) -> DataFrame:
    """One row per document and benchmark item that it holds: doc_id, item_id, score, item_words, removes.

    Words are runs of letters and digits in lower case; in scripts without spaces each character
    is one. A seed is a mask laid over consecutive words; where a seed of a document is one of an
    item, the words around it are compared. The pair is reported if some run of aligned words there
    has a score (matches less mismatches) of 12, or of 0.7 of the item's words where that is less.
    Items below eight words match with ``short_items`` only, where a document holds all their words
    in a row; such a hit ``removes`` the document only if the item is all of one of its lines, or
    of its text, as a common word or phrase is no leak. Null and empty texts match nothing; items
    with null or repeated ids count one by one, and null ids are reported as null; rows that
    repeat count once. Empty tables give no rows. Other columns are ignored.
    """
    return _hits(docs, benchmark, id_col, text_col, short_items).select(
        F.col("_id").alias(id_col), "item_id", "score", "item_words", "removes"
    ).distinct()


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", short_items: bool = False
) -> DataFrame:
    """The rows of ``docs`` without a hit of :func:`contaminated` that removes, with all their columns.

    Rows with null or empty texts stay, as do all rows where the benchmark is empty; rows that
    repeat stay or go together, with null ids too. Columns keep their names, whatever they are.
    """
    hits = _hits(docs, benchmark, id_col, text_col, short_items).where("removes").select("_id", "_d1", "_d2").distinct()
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(id_col).alias("_i"),
        *[k.alias(n) for k, n in zip(text_key(F.col(text_col)), ("_e1", "_e2"))],
    )
    same = F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_e1") == F.col("_d1")) & (F.col("_e2") == F.col("_d2"))
    return packed.join(hits, same, "left_anti").select("_doc.*")


def op4_decontaminate(spark, sf_dir: str) -> DataFrame:
    return contaminated(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
        short_items=True,
    )
