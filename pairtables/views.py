"""Instruction-answer tables derived from whole input tables. FIXTURES.md holds them as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pairtables import schemas
from pairtables.sources.tables import read_dataset

TURNS = 2**32
_SCHEMAS = {
    "conversations": schemas.CONVERSATIONS,
    "documents": schemas.DOCUMENTS,
    "events": schemas.EVENTS,
    "labels": schemas.LABELS,
    "pages": T.StructType(
        [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType())]
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table."""
    return read_dataset(spark, f"{sf_dir}/{name}.parquet", _SCHEMAS[name])


def spread(df: DataFrame) -> DataFrame:
    """A sample file is one piece, which one task would read and work on alone. Rows of a table
    in fewer pieces than there are cores are dealt out; a larger table is not shuffled. No job
    runs for this, and rows and results are the same either way."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def qa_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the assistant turn that follows, joined on the unique turn."""
    turns = spread(table(spark, sf_dir, "conversations"))
    asked = turns.where("role = 'user'").select(
        "conv_id", F.col("turn").alias("at"), F.col("text").alias("instruction")
    )
    answered = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("at"), F.col("text").alias("output")
    )
    return asked.join(answered, ["conv_id", "at"]).select(
        (F.col("conv_id") * TURNS + F.col("at")).alias("record_id"), "instruction", "output"
    )


def qa_dual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two answer columns, with missing and blank answers."""
    key = F.col("record_id")
    gpt = F.when(key % 7 == 0, None).when(key % 11 == 0, "  ").otherwise(F.col("output"))
    gemini = F.when(key % 5 != 0, F.concat_ws(" ", "output", "instruction"))
    return qa_pairs(spark, sf_dir).select(
        "record_id", "instruction", gpt.alias("gpt_output"), gemini.alias("gemini_output")
    )


def eval_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as targets, and outputs that overlap with them."""
    skipped = (F.col("n_chars") % 40).cast("int")
    rest = F.col("text").substr(skipped + 1, F.length("text"))
    return spread(table(spark, sf_dir, "documents")).select(
        F.col("doc_id").alias("record_id"),
        F.col("lang").alias("topic"),
        F.concat_ws(" ", F.lit("Write"), "lang", F.lit("text like"), "source").alias("inputs"),
        F.col("text").alias("targets"),
        F.concat_ws(" ", rest, "lang", "source").alias("outputs"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole answers as targets and one prediction per source: the question, and the answer turned round."""
    pairs = qa_pairs(spark, sf_dir)
    half = F.floor(F.length("output") / 2).cast("int")
    turned = F.concat_ws(
        " ", F.col("output").substr(half + 1, F.length("output")), F.col("output").substr(F.lit(1), half)
    )
    both = F.array(
        F.struct(F.lit("gpt_output").alias("source"), F.col("instruction").alias("outputs")),
        F.struct(F.lit("gemini_output").alias("source"), turned.alias("outputs")),
    )
    return pairs.select(
        "record_id",
        F.col("instruction").alias("inputs"),
        F.col("output").alias("targets"),
        F.inline(both),
    )


def judge_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge responses: missing, unreadable, out of range and valid."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("record_id"),
        F.col("event_type").alias("metric"),
        _response(F.col("event_id")).alias("response"),
    )


def judge_responses(rows: DataFrame) -> DataFrame:
    """One recorded response per row and judge metric."""
    metrics = F.array(
        *[
            F.struct(F.lit(m).alias("metric"), F.lit(i).alias("shift"))
            for i, m in enumerate(("answer_correctness", "answer_relevance", "faithfulness"))
        ]
    )
    return rows.select("record_id", F.inline(metrics)).select(
        "record_id", "metric", _response(F.col("record_id") + F.col("shift")).alias("response")
    )


def _response(number):
    graded = F.concat(F.lit("Score: "), (number % 7).cast("string"), F.lit("/5"))
    return F.when(number % 13 == 0, None).when(number % 5 == 0, "no score").otherwise(graded)


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions as text, so that numeric and lexical order differ; some exceed 32 bits, some
    are no numbers, and some have no name."""
    user, number = F.col("user_id") % 50, F.col("event_id")
    version = (
        F.when(number % 19 == 0, F.concat(F.lit("v"), number.cast("string")))
        .when(number % 17 == 0, (number + 3_000_000_000).cast("string"))
        .otherwise(number.cast("string"))
    )
    return table(spark, sf_dir, "events").select(
        F.when(user != 7, F.concat(F.lit("model_"), user.cast("string"))).alias("name"),
        version.alias("version"),
        F.col("event_type").alias("stage"),
    )


def words_only(col: str):
    """Text without characters that JSON would have to escape."""
    return F.regexp_replace(col, r"\W+", " ")


def poly_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answer cells as JSON text: an object, a list and a text."""
    key, answer = F.col("record_id"), words_only("output")
    cell = (
        F.when(key % 3 == 0, F.concat(F.lit('{"text":"'), answer, F.lit('"}')))
        .when(key % 3 == 1, F.concat(F.lit('[{"text":"'), answer, F.lit('"},"'), words_only("instruction"), F.lit('"]')))
        .otherwise(F.concat(F.lit('"'), answer, F.lit('"')))
    )
    return qa_pairs(spark, sf_dir).select("record_id", cell.alias("output"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Serving responses as JSON text, in all shapes they may have."""
    key, answer = F.col("record_id"), words_only("output")
    body = (
        F.when(key % 4 == 0, F.concat(F.lit('{"predictions":[{"generated_text":"'), answer, F.lit('"},"plain"]}')))
        .when(key % 4 == 1, F.concat(F.lit('{"outputs":["'), answer, F.lit('"]}')))
        .when(key % 4 == 2, F.lit('{"other":1}'))
        .otherwise(F.concat(F.lit('[{"generated_text":"'), answer, F.lit('"},5,{"n":1}]')))
    )
    return qa_pairs(spark, sf_dir).select("record_id", body.alias("response"))


def record_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses with two records each; some records, and some responses, are not valid."""
    key = F.col("doc_id")
    heat = F.when(key % 11 == 0, '"hot"').otherwise("0.2")
    topic = F.when(key % 7 == 0, "null").otherwise(F.concat(F.lit('"'), F.col("source"), F.lit('"')))
    body = F.concat(
        F.lit('{"records":[{"model":"m1","topic":"'),
        F.col("lang"),
        F.lit('","instruction":"'),
        words_only("text"),
        F.lit('","temperature":'),
        heat,
        F.lit('},{"model":"m2","topic":'),
        topic,
        F.lit(',"instruction":"Explain","temperature":1}]'),
        F.when(key % 13 == 0, "").otherwise("}"),
    )
    docs = spread(table(spark, sf_dir, "documents"))
    return docs.select(key.alias("record_id"), body.alias("response"))
