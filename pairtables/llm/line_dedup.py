"""Remove lines that many sites share, by HyperLogLog sketches of the sites of each line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pairtables.llm.common import MAX_FREQUENT, frequency_join, n_words, stored, text_key

MIN_SITES = 4
#: Lines of fewer words are passed by; with 1 every line that is not empty is looked at.
MIN_WORDS = 1
#: With a threshold of their own for short lines: so many characters of scripts without spaces
#: make a line long.
MIN_SPACELESS = 8
_SPACELESS = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}]"
#: 2^12 registers: the estimate of a count near ``MIN_SITES`` is off by far less than half.
LOG_REGISTERS = 12
_BLANK = " \t\r"


def _line(raw: Column) -> Column:
    return F.btrim(raw, F.lit(_BLANK))


def _lines(docs: DataFrame, min_words: int, short: bool) -> DataFrame:
    """One row per line that may be boilerplate; ``_d1``, ``_d2`` stand for the document's text.
    With ``short`` these are all lines with a word, and ``_short`` tells those of few words."""
    raw = docs.select("_id", "_site", "_d1", "_d2", F.posexplode(F.split("_text", "\n", -1)).alias("_pos", "_raw"))
    line = raw.withColumn("_line", _line(F.col("_raw"))).where(n_words(F.col("_line")) >= (1 if short else min_words))
    few = (n_words(F.col("_line")) < min_words) & (F.regexp_count("_line", F.lit(_SPACELESS)) < MIN_SPACELESS)
    return line.select(
        "_id", "_site", "_d1", "_d2", "_pos", *[k.alias(n) for k, n in zip(text_key(F.col("_line")), ("_h1", "_h2"))],
        *([few.alias("_short")] if short else []),
    )


def shared_lines(
    lines: DataFrame, min_sites: int, log_registers: int = LOG_REGISTERS, short_sites: int | None = None,
    max_frequent: int = MAX_FREQUENT,
) -> DataFrame:
    """Hashes of the lines of ``min_sites`` sites or more (lines marked ``_short``: of
    ``short_sites``), with the place that keeps the line and ``_n``, how often the line occurs.

    One sketch of sites per line hash, merged by the aggregation on both sides of its
    shuffle, so a line that a third of all rows hold reaches its task as one row per map
    task. An estimate below half or above twice the threshold decides; between them the
    distinct (line, site) pairs are counted exactly.
    """
    first = F.min(F.struct(F.col("_id").isNull(), "_id", "_d1", "_d2", "_pos")).alias("_keeper")
    site = F.coalesce("_site", F.lit("\x00"))
    sketch = F.hll_sketch_agg(site, log_registers)
    need = F.lit(min_sites) if short_sites is None else F.when(F.max("_short"), short_sites).otherwise(min_sites)
    spread = lines.groupBy("_h1", "_h2").agg(
        F.hll_sketch_estimate(sketch).alias("_sites"), first, need.alias("_need"), F.count(F.lit(1)).alias("_n")
    )
    # Single lines, nearly all of them, end here.
    spread = stored(spread.where(F.col("_sites") * 2 >= F.col("_need")), "spread")
    near = spread.where(F.col("_sites") < 2 * F.col("_need"))
    pairs = lines.select("_h1", "_h2", site.alias("_site"))
    pairs = frequency_join(pairs, near.select("_h1", "_h2", "_n"), ["_h1", "_h2"], "_n", max_frequent)
    exact = pairs.distinct().groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_exact"))
    counted = near.join(exact, ["_h1", "_h2"]).where(F.col("_exact") >= F.col("_need"))
    sure = spread.where(F.col("_sites") >= 2 * F.col("_need"))
    kept = ["_h1", "_h2", "_keeper", "_n"]
    return stored(sure.select(*kept).unionByName(counted.select(*kept)), "shared")


def remove_shared_lines(
    docs: DataFrame, min_sites: int = MIN_SITES, min_words: int = MIN_WORDS, id_col: str = "doc_id",
    text_col: str = "text", site_col: str = "source", short_sites: int | None = None, stats: str | None = "_lines",
    max_frequent: int = MAX_FREQUENT,
) -> DataFrame:
    """The rows of ``docs`` with ``text`` less its boilerplate lines; all columns stay, and
    ``n_lines``, ``n_removed`` are added under the struct ``stats`` (in place of a column of
    that name; with None nothing is added).

    Lines end at ``\\n`` and are compared without blanks, tabs and carriage returns at their
    ends. A line of ``min_words`` words or more that is in documents of ``min_sites`` sites or
    more goes everywhere but at one place: its first in the document with the smallest id
    (null last). With ``short_sites``, so does a shorter line of that many sites, and one of
    ``MIN_SPACELESS`` characters of scripts without spaces counts as long.
    Null sites are one site. A document keeps its row even if no line is left; a null text stays
    null. Rows with the same id and text keep the same lines. An empty table gives no rows.
    """
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(id_col).alias("_id"),
        F.col(site_col).cast("string").alias("_site"), F.col(text_col).alias("_text"),
        *[k.alias(n) for k, n in zip(text_key(F.col(text_col)), ("_d1", "_d2"))],
    )
    lines = _lines(packed, min_words, short_sites is not None)
    shared = shared_lines(lines, min_sites, short_sites=short_sites, max_frequent=max_frequent)
    here = F.struct(F.col("_id").isNull(), "_id", "_d1", "_d2", "_pos")
    gone = (
        frequency_join(lines.drop("_site", "_short"), shared, ["_h1", "_h2"], "_n", max_frequent)
        .where(~here.eqNullSafe(F.col("_keeper")))
        .groupBy(F.col("_id").alias("_i"), F.col("_d1").alias("_e1"), F.col("_d2").alias("_e2"))
        .agg(F.collect_set("_pos").alias("_gone"))
    )
    same = F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_d1") == F.col("_e1")) & (F.col("_d2") == F.col("_e2"))
    # A column of its own: inside the transform below it would be split anew for every line.
    found = packed.join(gone, same, "left").withColumn("_split", F.split("_text", "\n", -1))
    split = F.col("_split")
    kept = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.coalesce("_gone", F.array().cast("array<int>")))
    rest = F.array_join(F.transform(kept, lambda i: F.get(split, i)), "\n")
    text = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(rest)
    counts = F.struct(
        F.coalesce(F.size(split), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
    )
    counts = F.when(F.col("_text").isNotNull(), counts).otherwise(
        F.struct(F.lit(0).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_removed"))
    )
    columns = [
        text.alias(c) if c == text_col else F.col("_doc").getField(c).alias(c) for c in docs.columns if c != stats
    ]
    return found.select(*columns, *([counts.alias(stats)] if stats else []))


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    cleaned = remove_shared_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return cleaned.select("doc_id", F.col("_lines.n_lines").alias("n_lines"), F.col("_lines.n_removed").alias("n_removed"), "text")


def oracle_sql(docs: str = "documents", min_sites: int = MIN_SITES, min_words: int = MIN_WORDS) -> str:
    """Rows with all columns of ``docs``, ``n_lines`` and ``n_removed``."""
    return rf"""
select d.* replace (case when r.n_removed > 0 then r.rest else d.text end as text), r.n_lines, r.n_removed
from {docs} d join (
  with raw as (select doc_id, source, pos, lines[pos] as raw, trim(lines[pos], ' ' || chr(9) || chr(13)) as line
    from (select doc_id, source, lines, unnest(range(1, len(lines) + 1)) as pos
      from (select doc_id, source, string_split(text, chr(10)) as lines from {docs}))),
  ok as (select line, doc_id, pos, coalesce(source, chr(1)) as source from raw
    where len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= {min_words}),
  s as (select line, arg_min(struct_pack(d := doc_id, p := pos), [doc_id, pos]) as k from ok
    group by 1 having count(distinct source) >= {min_sites}),
  gone as (select ok.doc_id, ok.pos from ok join s using (line) where not (k.d = ok.doc_id and k.p = ok.pos))
  select raw.doc_id, count(*) as n_lines, count(gone.pos) as n_removed,
    coalesce(string_agg(raw.raw, chr(10) order by raw.pos) filter (gone.pos is null), '') as rest
  from raw left join gone on gone.doc_id = raw.doc_id and gone.pos = raw.pos group by 1
) r on r.doc_id = d.doc_id
"""


ORACLE_SQL = f"select doc_id, n_lines, n_removed, text from ({oracle_sql()})"
