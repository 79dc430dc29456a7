"""Main text of pages by wrappers: union-free expressions inferred from the pages of a host."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from pairtables.llm.common import stored
from pairtables.llm.html_tree import align_all, constants, expression, main_paths, main_text
from pairtables.llm.url_rules import split_url

#: Expressions that one task aligns at a time.
FAN_IN = 200


def _expressions(pages: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"host": b["host"], "expression": [expression(h) for h in b["html"]]})

    return pages.select("host", "html").mapInPandas(run, "host string, expression string")


def infer_wrappers(pages: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """``host``, ``paths``: the places of the main text in the host's wrapper, and ``fixed``: its
    constant texts, of pages that name no main element.

    Each page gives one expression, its repeats folded; equal ones of a host are one row, so a
    host with a third of all pages has few. Expressions of a host are aligned, ``fan_in`` at a
    time, until one is left: what some pages lack becomes optional, what follows itself a
    repeat, texts that differ between distinct pages are slots.
    """
    level = stored(_expressions(pages).distinct(), "expressions")

    def align(group: pd.DataFrame) -> pd.DataFrame:
        wrapper = align_all(group["expression"].tolist())
        return pd.DataFrame({"host": group["host"].iloc[:1], "expression": [wrapper]})

    while True:
        count = level.groupBy("host").agg(F.count(F.lit(1)).alias("_n"))
        most = count.agg(F.max("_n")).first()[0] or 0
        salted = level.join(count, "host").withColumn(
            "_salt", F.pmod(F.xxhash64("expression"), F.ceil(F.col("_n") / fan_in))
        )
        level = stored(
            salted.groupBy("host", "_salt").applyInPandas(align, "host string, expression string").distinct(), "wrappers"
        )
        if most <= fan_in:
            break

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            paths, fixed = ([f(w) for w in b["expression"]] for f in (main_paths, constants))
            yield pd.DataFrame({"host": b["host"], "paths": paths, "fixed": fixed})

    return level.mapInPandas(place, "host string, paths array<string>, fixed array<string>")


def extract_main_text(pages: DataFrame) -> DataFrame:
    """One row per page: ``page_id``, ``url``, ``text``, ``n_chars``.

    The main text are the blocks of the elements at the wrapper's places, less navigation,
    headers, footers, sidebars, notices, adverts, forms, comments, scripts and styles inside;
    on a page without such elements, of the whole page less those, and less the texts that are
    equal at a place on all distinct pages of the host that have the place and no such elements
    (two or more). Character references are decoded; white space of any kind in a block is one space;
    blocks are joined by two ``\\n``. Null html gives an empty text; null urls are one host
    without a name. Cut pages count as closed at their end. Pages that repeat give a row each,
    an empty table none; other columns are ignored.
    """
    rows = pages.select("page_id", "url", "html", split_url(F.col("url"))[0].alias("host"))
    wrappers = stored(infer_wrappers(rows), "places").withColumnRenamed("host", "_host")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            places = zip(b["html"], b["paths"], b["fixed"])
            texts = [main_text(h, [] if p is None else list(p), () if f is None else list(f)) for h, p, f in places]
            yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "text": texts})

    joined = rows.join(wrappers, F.col("host") == F.col("_host"), "left").select(
        "page_id", "url", "html", "paths", "fixed"
    )
    id_type = dict(pages.dtypes)["page_id"]
    out = joined.mapInPandas(run, f"page_id {id_type}, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op9_html_text(spark, sf_dir: str) -> DataFrame:
    return extract_main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
