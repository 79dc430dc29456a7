"""From raw documents to a training mix: five stages, each stored before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairtables.llm.common import stored
from pairtables.llm.decontaminate import decontaminate
from pairtables.llm.line_dedup import remove_shared_lines
from pairtables.llm.mixing import take_mix
from pairtables.llm.ngram_join import one_per_group
from pairtables.llm.quality import keep_good, train_quality

#: Near copies in the pipeline: five-word shingles, similarity 0.8 or more.
SHINGLE_WORDS, SIMILAR, OF = 5, 80, 100
#: A line of fewer words than these goes only if this many sources hold it.
LONG_WORDS, SHORT_SITES = 3, 12


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. Every row is judged by its own text, a
    null one as an empty one; ids may be null or repeat, and an empty table stays empty."""
    return keep_good(docs, train_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of many sources go everywhere but in one document; every document stays, a null text
    as null, and ``n_chars`` is counted anew. Null sources are one source, rows that repeat keep
    the same lines, columns of any name are kept."""
    cleaned = remove_shared_lines(docs, min_words=LONG_WORDS, short_sites=SHORT_SITES, stats=None)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast("long"))
    return cleaned


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest id stays, a null id last. Null
    and empty texts, which resemble nothing, stay; of rows that repeat one stays."""
    return one_per_group(docs, n=SHINGLE_WORDS, part=SIMILAR, whole=OF)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go; a short item must be all of a line or text.
    Null and empty texts stay, rows that repeat stay or go together, and with an empty benchmark
    all stay."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), short_items=True)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix with size, source_size, target, taken and copies, which take the place
    of columns of these names. Null sources are one source, null texts have size 0."""
    return take_mix(docs)


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_shared_lines),
    ("near_copies", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("mix", mix),
]

#: A learned classifier is the first stage, so SQL cannot give the rows; the tests compare
#: each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
