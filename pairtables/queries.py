"""One query per operator, over whole input tables. ``oracles.py`` holds the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pairtables import fixed_values as fixed, schemas, views
from pairtables.functions import text as tx
from pairtables.operators import encode as en, generation as ge, judge as ju, lexical as lx
from pairtables.operators import pairs as pa, position as po, progress as pr, report as re_
from pairtables.operators import prefilter, subwords as sw, versions as ve
from pairtables.operators.infer import batch_infer, map_batches
from pairtables.operators.split import is_test_row
from pairtables.plans import answers as an, evaluation as ev, instructions as ins, training as tr
from pairtables.session import shared_path, stored
from pairtables.sources import records, shard_index, tables
from pairtables.sources.upsert import consolidate_shards
from pairtables.streaming import shards

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DUAL_FIELDS = schemas.DUAL_SOURCE.fields[:4]
# Small enough that the sample tables already fall into several key ranges.
ROWS_PER_RANGE = 4096


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _long(*names: str):
    return [F.col(n).cast("long").alias(n) for n in names]


def _round(*names: str):
    return [F.round(n, 6).alias(n) for n in names]


# Sources and sinks


@query
def o01_read_dataset(spark, sf_dir):
    return tables.read_dataset(spark, f"{sf_dir}/conversations.parquet", schemas.CONVERSATIONS)


def _sharded(spark, sf_dir) -> str:
    rows, root = views.qa_dual(spark, sf_dir), shared_path(spark, "shards")
    tables.write_shards(rows, root, rows_per_bucket=ROWS_PER_RANGE // 16)
    return root


def _shard_sizes(spark, root: str) -> DataFrame:
    read = tables.read_shards(spark, root, T.StructType(DUAL_FIELDS))
    return read.groupBy("shard").agg(
        F.count("*").alias("n_rows"), F.min("record_id").alias("first_id"), F.max("record_id").alias("last_id")
    )


@query
def o02_read_shards(spark, sf_dir):
    root = _sharded(spark, sf_dir)
    other = views.qa_dual(spark, sf_dir)
    other.write.parquet(f"{root}/shard=draft-0")
    read = tables.read_shards(spark, root, T.StructType(DUAL_FIELDS))
    return read.select("record_id", "shard", "gpt_output")


@query
def o02_shard_index(spark, sf_dir):
    """The index after a first run has written some shards and a second one the rest."""
    rows, root = views.qa_dual(spark, sf_dir), shared_path(spark, "shards")
    for only in (F.xxhash64("shard") % 2 == 0, None):
        tables.write_shards(rows, root, 100, rows_per_bucket=ROWS_PER_RANGE // 16, only=only)
        index = shard_index.index_shards(spark, root, rows.schema["record_id"])
    return index


@query
def o03_validate_records(spark, sf_dir):
    rows = records.validate_records(views.record_sets(spark, sf_dir), "response", whole_response=False)
    return rows.select(
        "record_id", *_long("pos"), "model", "topic", F.md5("instruction").alias("digest"),
        "temperature", F.coalesce("reason", F.lit("valid")).alias("status"),
    )


@query
def o03_validate_responses(spark, sf_dir):
    rows = records.validate_records(views.record_sets(spark, sf_dir), "response")
    return rows.groupBy("record_id").agg(
        F.count_if(F.col("reason").isNull()).alias("n_records"), F.coalesce(F.max("reason"), F.lit("valid")).alias("status")
    )


@query
def o04_append_dataset(spark, sf_dir):
    docs, path = views.table(spark, sf_dir, "documents"), shared_path(spark, "documents")
    for side in (docs.where(is_test_row(docs, "doc_id")), docs.where(~is_test_row(docs, "doc_id"))):
        tables.append_dataset(side, path)
    return tables.read_dataset(spark, path, schemas.DOCUMENTS)


@query
def o05_write_shards(spark, sf_dir):
    return _shard_sizes(spark, _sharded(spark, sf_dir))


@query
def o05_resume_shards(spark, sf_dir):
    """Half of the shards are written by a run that ends early, the rest by the next one."""
    rows, root = views.qa_dual(spark, sf_dir), shared_path(spark, "shards")
    for only in (F.xxhash64("shard") % 2 == 0, None):
        tables.write_shards(rows, root, rows_per_bucket=ROWS_PER_RANGE // 16, only=only)
    return _shard_sizes(spark, root)


@query
def o06_consolidate(spark, sf_dir):
    dual = views.qa_dual(spark, sf_dir)
    done = dual.where(F.col("gpt_output").isNotNull())
    new = dual.where(tx.is_blank(F.col("gpt_output"))).withColumn("gpt_output", F.col("instruction"))
    return tables.consolidate(done, new, shared_path(spark, "train"))


@query
def o06_consolidate_shards(spark, sf_dir):
    """The same in place: shards without a changed key keep their files."""
    dual, root = views.qa_dual(spark, sf_dir), shared_path(spark, "shards")
    tables.write_shards(dual.where(F.col("gpt_output").isNotNull()), root, 100, rows_per_bucket=ROWS_PER_RANGE // 16)
    new = dual.where(tx.is_blank(F.col("gpt_output"))).withColumn("gpt_output", F.col("instruction"))
    return consolidate_shards(new, root, T.StructType(DUAL_FIELDS), "record_id", 100, ROWS_PER_RANGE // 16)


# Projections and reshaping


@query
def o07_select_source(spark, sf_dir):
    return pa.select_source(views.qa_dual(spark, sf_dir), "gemini_output")


@query
def o08_build_eval_frame(spark, sf_dir):
    return pa.build_eval_frame(views.qa_dual(spark, sf_dir), "gemini_output")


@query
def o08_eval_frames(spark, sf_dir):
    return pa.build_eval_frames(views.qa_dual(spark, sf_dir))


@query
def o09_flatten_text(spark, sf_dir):
    return views.poly_output(spark, sf_dir).select(
        "record_id", tx.flatten_json(F.col("output")).alias("output")
    )


@query
def o09_flatten_maps(spark, sf_dir):
    """Cells that are maps, and lists of maps; some have no text, some are null."""
    key, none = F.col("record_id"), F.lit(None).cast("map<string,string>")
    one = F.when(key % 5 == 0, none).when(key % 3 == 0, F.create_map(F.lit("n"), "output")).otherwise(
        F.create_map(F.lit("text"), "output", F.lit("n"), "instruction")
    )
    rows = views.qa_pairs(spark, sf_dir).select(
        "record_id", one.alias("cell"), F.array(one, F.create_map(F.lit("text"), "instruction")).alias("cells")
    )
    flat = [tx.flatten_text(F.col(c), rows.schema[c].dataType).alias(c) for c in ("cell", "cells")]
    return rows.select("record_id", *flat)


@query
def o10_normalize_content(spark, sf_dir):
    parts = F.array(F.concat(F.lit("\t "), "instruction"), F.concat("output", F.lit(" \n")))
    rows = views.qa_pairs(spark, sf_dir).withColumn("content", parts)
    content = tx.normalize_content(F.col("content"), rows.schema["content"].dataType)
    return rows.select("record_id", content.alias("content"))


@query
def o11_chat_format(spark, sf_dir):
    return tx.chat_format(views.qa_pairs(spark, sf_dir)).select("record_id", "text")


@query
def o11_training_text(spark, sf_dir):
    """Chat texts; rows without an instruction or an answer have none."""
    key = F.col("record_id")
    dual = views.qa_dual(spark, sf_dir)
    return tr.training_text(dual.withColumn("instruction", F.when(key % 4 != 0, F.col("instruction"))), "gpt_output")


@query
def o12_assemble_messages(spark, sf_dir):
    assembled = pa.assemble_messages(views.table(spark, sf_dir, "conversations"))
    line = F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"]))
    return assembled.select(
        "conv_id", *_long("part", "n_parts"), F.size("messages").cast("long").alias("n_messages"),
        F.array_join(line, "\n").alias("messages"),
    )


@query
def o12_ordered_turns(spark, sf_dir):
    turns = pa.ordered_turns(views.table(spark, sf_dir, "conversations"), turns_per_block=3)
    return turns.select("conv_id", *_long("position"), "role", F.md5("content").alias("digest"))


VOCABULARY = 500


@query
def o13_build_vocab(spark, sf_dir):
    vocab = en.build_vocab(views.spread(views.table(spark, sf_dir, "documents")), VOCABULARY)
    return vocab.select("token", *_long("count", "id"))


@query
def o13_encode(spark, sf_dir):
    docs = views.spread(views.table(spark, sf_dir, "documents"))
    encoded = en.encode(docs, en.build_vocab(docs, VOCABULARY))
    ids = [F.array_join(F.col(c).cast("array<string>"), " ").alias(c) for c in ("input_ids", "attention_mask", "labels")]
    return encoded.select("doc_id", *ids, "truncated")


#: A public byte-pair vocabulary; its one special token stands for padding too.
SUBWORDS, SUBWORD_PAD = "/opt/tokenizers/byte_bpe_50k.json", 50_256


@query
def o13_encode_subwords(spark, sf_dir):
    docs = views.spread(views.table(spark, sf_dir, "documents"))
    encoded = sw.encode_subwords(docs, SUBWORDS, SUBWORD_PAD)
    ids = [F.array_join(F.col(c).cast("array<string>"), " ").alias(c) for c in ("input_ids", "attention_mask", "labels")]
    return encoded.select("doc_id", *ids, "truncated")


def _coverage(spark, sf_dir) -> DataFrame:
    docs = views.table(spark, sf_dir, "documents").withColumnRenamed("source", "topic")
    labels = views.table(spark, sf_dir, "labels")
    targets = docs.groupBy("topic").agg(F.count("*").alias("target"))
    return ge.topic_coverage(docs.join(labels, "doc_id", "left_semi"), targets)


@query
def o14_generation_plan(spark, sf_dir):
    plan = ge.generation_plan(_coverage(spark, sf_dir), ["gpt", "gemini"])
    return plan.select("topic", *_long("round"), "model", *_long("batch_size"))


@query
def o15_render_prompt(spark, sf_dir):
    judged = ju.judge_prompts(views.eval_rows(spark, sf_dir)).select(
        F.col("metric").alias("kind"), F.col("record_id").alias("id"), "prompt"
    )
    pairs = views.qa_pairs(spark, sf_dir)
    asked = [
        tx.render_prompt(pairs, kind).select(F.lit(kind).alias("kind"), F.col("record_id").alias("id"), "prompt")
        for kind in pa.PROVIDERS
    ]
    docs = views.table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("topic"), F.col("lang").alias("model"), F.lit(10).alias("batch_size")
    )
    planned = tx.render_prompt(pa.stamp_settings(docs), "instructions").select(
        F.lit("instructions").alias("kind"), F.col("doc_id").alias("id"), "prompt"
    )
    return pa.concat_all([judged, *asked, planned]).select(
        "kind", "id", F.md5("prompt").alias("digest"), F.length("prompt").cast("long").alias("n_chars")
    )


@query
def o16_preview(spark, sf_dir):
    text = F.col("text")
    return views.table(spark, sf_dir, "documents").select(
        "doc_id", tx.preview(text, 80).alias("short"), tx.preview(text, 100).alias("sample"),
        tx.preview(text, 50, always=True).alias("log"),
    )


@query
def o17_slugs(spark, sf_dir):
    url = F.col("url")
    slug = tx.model_slug(url, F.lit("v-a.l"))
    return views.table(spark, sf_dir, "pages").select(
        "page_id", slug.alias("slug"),
        tx.model_uri(tx.model_slug(url, F.lit("v1"), "main", "models"), "prod").alias("registered"),
        tx.model_uri(slug).alias("uri"),
        tx.endpoint_slug(tx.endpoint_name(slug, F.col("page_id"))).alias("endpoint"),
    )


@query
def o18_run_name(spark, sf_dir):
    return views.table(spark, sf_dir, "events").select(
        "event_id", tx.run_name(F.col("event_type"), F.col("ts")).alias("run_name")
    )


@query
def o19_stamp_settings(spark, sf_dir):
    stamped = pa.stamp_settings(views.qa_dual(spark, sf_dir))
    return stamped.select("record_id", "gpt_output", "temperature", *_long("max_tokens"))


@query
def o20_normalize_prediction(spark, sf_dir):
    listed = tx.normalize_prediction(F.col("response"))
    return (
        views.responses(spark, sf_dir)
        .select("record_id", F.posexplode(listed).alias("pos", "prediction"))
        .select("record_id", *_long("pos"), "prediction")
    )


# Filters and conditional fill


@query
def o21_split_blank(spark, sf_dir):
    full, blank = pa.split_blank(views.qa_dual(spark, sf_dir), "gpt_output")
    return full.select("record_id", F.lit(False).alias("blank")).unionByName(
        blank.select("record_id", F.lit(True).alias("blank"))
    )


@query
def o22_pending_outputs(spark, sf_dir):
    return pa.pending_outputs(views.qa_dual(spark, sf_dir)).select("record_id", "provider")


@query
def o23_fill_missing(spark, sf_dir):
    dual = views.qa_dual(spark, sf_dir)
    response = F.when(F.col("record_id") % 3 != 0, F.concat(F.col("provider"), F.lit(": "), "instruction"))
    return pa.fill_missing(dual, pa.pending_outputs(dual).withColumn("response", response))


def stand_in_model(prompts: list[str]) -> list[str]:
    """Stands in for a model: deterministic, and fails for some prompts."""
    if any(len(p) % 17 == 0 for p in prompts):
        raise ValueError("stand-in failure")
    return [f"{len(p)} characters" for p in prompts]


@query
def o24_batch_infer(spark, sf_dir):
    asked = tx.render_prompt(pa.pending_outputs(views.qa_dual(spark, sf_dir)), "gpt_output")
    return batch_infer(asked, stand_in_model, ["record_id", "provider"])


@query
def o24_infer_by_chunk(spark, sf_dir):
    """A run that ends after half of the rows, and one over all rows: five calls in flight per task."""
    dual, path = views.qa_dual(spark, sf_dir), shared_path(spark, "answers")
    models = {"gpt_output": stand_in_model, "gemini_output": stand_in_model}
    calls = {"in_flight": 5, "seconds": 60.0, "rows_per_chunk": ROWS_PER_RANGE // 16}
    an.request_answers(dual.where("record_id % 2 = 0"), models, path=path, **calls)
    return an.request_answers(dual, models, path=path, **calls)


@query
def o25_attach_outputs(spark, sf_dir):
    rows = views.eval_rows(spark, sf_dir)
    labels = views.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("record_id"))
    known = rows.join(labels, "record_id", "left_semi")
    return pa.attach_outputs(rows.drop("outputs"), known).select(
        "record_id", "topic", F.md5("outputs").alias("digest")
    )


# Split, position, resume, set operations


@query
def o26_slice_rows(spark, sf_dir):
    docs = views.table(spark, sf_dir, "documents")
    n = docs.count()
    part = po.slice_rows(docs, n // 4, n // 2, "doc_id", ROWS_PER_RANGE)
    return part.select("doc_id", "position")


@query
def o26_slice_shards(spark, sf_dir):
    """The second quarter of a sharded table, from the shards that its index names."""
    rows, root = views.qa_dual(spark, sf_dir), shared_path(spark, "shards")
    tables.write_shards(rows, root, 100, rows_per_bucket=ROWS_PER_RANGE // 16)
    n = shard_index.index_shards(spark, root, rows.schema["record_id"]).agg(F.sum("n_rows")).first()[0]
    part = shard_index.read_slice(spark, root, T.StructType(DUAL_FIELDS), n // 4, n // 2)
    return part.select("record_id", "gpt_output", "shard", "position")


@query
def o27_train_test_split(spark, sf_dir):
    docs = views.table(spark, sf_dir, "documents")
    return docs.select("doc_id", is_test_row(docs, "doc_id").alias("is_test"))


@query
def o27_exact_split(spark, sf_dir):
    docs = views.table(spark, sf_dir, "documents")
    return docs.select("doc_id", is_test_row(docs, "doc_id", exact=True).alias("is_test"))


@query
def o28_pending_rows(spark, sf_dir):
    dual = views.qa_dual(spark, sf_dir)
    done = dual.where(~tx.is_blank(F.col("gpt_output")) & ~tx.is_blank(F.col("gemini_output")))
    return pa.pending_rows(dual, done).select("record_id", "instruction")


@query
def o28_pending_filtered(spark, sf_dir):
    """The same with a bitmap of the finished keys before the join."""
    dual = views.qa_dual(spark, sf_dir)
    done = dual.where(~tx.is_blank(F.col("gpt_output")) & ~tx.is_blank(F.col("gemini_output")))
    return prefilter.filtered_anti_join(dual, done, "record_id").select("record_id", "instruction")


@query
def o29_with_batches(spark, sf_dir):
    numbered = po.with_batches(views.table(spark, sf_dir, "events"), "event_id", rows_per_bucket=ROWS_PER_RANGE)
    return numbered.select("event_id", *_long("position", "batch", "batch_start", "batch_end"))


@query
def o30_concat_all(spark, sf_dir):
    dual = views.qa_dual(spark, sf_dir)
    return pa.concat_all(
        [
            dual.select("record_id", "gpt_output"),
            dual.select("record_id", "gemini_output"),
            dual.select("record_id", "instruction", "gpt_output"),
        ]
    )


def _registry(spark, sf_dir) -> DataFrame:
    return views.table(spark, sf_dir, "labels").select(
        F.concat(F.lit("model_"), (F.col("doc_id") % 40).cast("string")).alias("name")
    )


@query
def o31_existing(spark, sf_dir):
    rows, registry = views.versions(spark, sf_dir), _registry(spark, sf_dir)
    return pa.mark_existing(rows, registry, "name", "version")


# Aggregation, metrics, gate


@query
def o32_batch_progress(spark, sf_dir):
    batches = po.with_batches(views.qa_dual(spark, sf_dir), rows_per_bucket=ROWS_PER_RANGE)
    return pr.batch_progress(batches)


@query
def o33_topic_coverage(spark, sf_dir):
    return _coverage(spark, sf_dir).select("topic", *_long("produced", "target", "shortfall"))


@query
def o34_rouge_n(spark, sf_dir):
    scored = lx.rouge_n(views.eval_rows(spark, sf_dir), 1, 2)
    names = [f"rouge{n}{part}" for n in (1, 2) for part in ("_precision", "_recall", "")]
    return scored.select("record_id", *_round(*names))


@query
def o35_rouge_l(spark, sf_dir):
    scored = lx.rouge_l(views.predictions(spark, sf_dir))
    return scored.select("record_id", "source", *_round("rougeL_precision", "rougeL_recall", "rougeL"))


@query
def o35_rouge_l_documents(spark, sf_dir):
    scored = lx.rouge_l(views.eval_rows(spark, sf_dir))
    return scored.select("record_id", *_round("rougeL_precision", "rougeL_recall", "rougeL"))


@query
def o36_corpus_bleu(spark, sf_dir):
    return lx.corpus_bleu(views.eval_rows(spark, sf_dir), ["topic"]).select("topic", *_round("bleu"), "n")


@query
def o37_token_count(spark, sf_dir):
    return lx.token_count(views.eval_rows(spark, sf_dir)).select("record_id", "token_count")


@query
def o37_subword_count(spark, sf_dir):
    rows = views.eval_rows(spark, sf_dir)
    return rows.select("record_id", sw.subword_count(SUBWORDS)(F.col("outputs")).alias("token_count"))


@query
def o38_parse_score(spark, sf_dir):
    response = F.col("response")
    return views.judge_raw(spark, sf_dir).select(
        "record_id", "metric", ju.parse_score(response).alias("score"),
        ju.found_score(response).isNull().alias("defaulted"),
    )


@query
def o39_judge_scores(spark, sf_dir):
    rows = views.eval_rows(spark, sf_dir)
    judged = ju.judge_scores(rows.select("record_id"), views.judge_responses(rows))
    return judged.select("record_id", *fixed.JUDGE_METRICS, *_long("defaulted"))


def _scored(spark, sf_dir) -> DataFrame:
    return ev.score_rows(*_judged(spark, sf_dir))


def _judged(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return views.predictions(spark, sf_dir), views.judge_responses(views.qa_pairs(spark, sf_dir))


@query
def o40_metric_means(spark, sf_dir):
    means = ev.metrics_of(_scored(spark, sf_dir), ["source"])
    return means.select("source", "metric", *_round("value"), "n")


@query
def o40_means_of_increments(spark, sf_dir):
    """The same from stored sums that three increments were added to, one of them twice."""
    scored, path = _scored(spark, sf_dir), shared_path(spark, "sums")
    for i in (0, 1, 2, 1):
        means = ev.add_scores(scored.where(F.pmod("record_id", F.lit(3)) == i), path, str(i))
    return means.select("source", "metric", *_round("value"), "n")


@query
def o41_check_thresholds(spark, sf_dir):
    gate = re_.check_thresholds(ev.metrics_of(_scored(spark, sf_dir), ["source"]))
    return gate.select(
        "source", "threshold_name", *_round("value"), "threshold", "status", "all_pass", *_long("n_missing")
    )


@query
def o42_compare_sources(spark, sf_dir):
    metrics = ev.metrics_of(_scored(spark, sf_dir), ["source"])
    wide = re_.compare_sources(metrics, ev.METRIC_NAMES)
    short = {name: name.split("/")[0] for name in ev.METRIC_NAMES}
    return wide.select("source", *[F.round(F.col(f"`{n}`"), 6).alias(s) for n, s in short.items()])


@query
def o42_source_summary(spark, sf_dir):
    gate = re_.check_thresholds(ev.metrics_of(_scored(spark, sf_dir), ["source"]))
    return re_.source_summary(gate)


@query
def o43_eval_results(spark, sf_dir):
    return _scored(spark, sf_dir).select(
        "record_id", "source", "outputs", *_round("rouge1", "rouge2", "rougeL"), "token_count",
        *fixed.JUDGE_METRICS, *_long("defaulted"),
    )


@query
def o44_metrics_long(spark, sf_dir):
    entry = F.concat(
        F.lit('{"step":'), F.col("event_id").cast("string"), F.lit(',"loss":'),
        (F.col("event_id") % 97).cast("string"), F.lit('.5,"note":"'), "event_type",
        F.lit('","ok":true,"quoted":"7","empty":null,'), F.col("props").substr(F.lit(2), F.length("props")),
    )
    events = views.spread(views.table(spark, sf_dir, "events"))
    logged = events.select("event_id", entry.alias("entry"))
    return re_.metrics_long(logged, "entry")


@query
def o44_params_long(spark, sf_dir):
    runs = views.predictions(spark, sf_dir).groupBy("source").agg(F.count("*").alias("num_samples"))
    params = {
        "model_name": tx.model_slug(F.lit("Org/Base-0.5"), F.col("source")),
        "source_column": F.col("source"),
        "num_samples": F.col("num_samples"),
    }
    return re_.params_long(runs, params).select("source", "key", "value")


# Ranking, top-k, versioned tables


@query
def o45_latest_version(spark, sf_dir):
    return ve.latest_version(views.versions(spark, sf_dir)).select("name", *_long("latest"))


@query
def o46_retain_versions(spark, sf_dir):
    return ve.retain_versions(views.versions(spark, sf_dir))


@query
def o47_resolve_endpoint(spark, sf_dir):
    key = F.col("doc_id")
    served = views.table(spark, sf_dir, "documents").select(
        F.col("source").alias("endpoint"),
        F.concat(F.lit("model_"), (key % 40).cast("string")).alias("entity_name"),
        F.when(key % 9 == 0, "latest").when(key % 8 == 0, None).otherwise(key.cast("string")).alias("entity_version"),
    )
    requests = views.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("request_id"),
        F.concat(F.lit("model_"), (F.col("user_id") % 50).cast("string")).alias("name"),
        (F.col("event_id") % 1000).cast("int").alias("version"),
    )
    found = ve.resolve_endpoint(requests, served)
    return found.select("request_id", "name", *_long("version"), "endpoint", "error")


@query
def o48_sample_rows(spark, sf_dir):
    rows = re_.sample_rows(views.eval_rows(spark, sf_dir))
    return rows.select("record_id", "inputs", "outputs")


@query
def o49_cap_per_topic(spark, sf_dir):
    docs = views.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("record_id"), F.nullif(F.col("lang"), F.lit("es")).alias("topic")
    )
    return ge.cap_per_topic(docs, 150)


# Streaming

#: Files per micro-batch: a few micro-batches at any size of the samples.
MAX_FILES = 50
#: Where that would make more micro-batches than this, they take more files each.
MAX_BATCHES = 4


@query
def o50_ingest_stream(spark, sf_dir):
    """Files arrive, one per micro-batch; then more files, some rows a second time, after a restart."""
    table = views.table(spark, sf_dir, "conversations")
    source, sink, checkpoint = (shared_path(spark, n) for n in ("arrived", "ingested", "checkpoint"))
    third = F.pmod(F.xxhash64("conv_id"), F.lit(3))
    for part in (table.where(third < 2), table.where(third > 0)):
        tables.append_dataset(part.repartition(2), source)
        turns = shards.shard_stream(spark, source, schemas.CONVERSATIONS, max_files=1)
        keyed = turns.withColumn("record_id", F.col("conv_id") * views.TURNS + F.col("turn"))
        shards.ingest_stream(keyed, sink, checkpoint)
    schema = T.StructType([*schemas.CONVERSATIONS.fields, T.StructField("record_id", T.LongType())])
    return tables.read_dataset(spark, sink, schema).drop("run", "batch_id")


@query
def o50_ingest_shards(spark, sf_dir):
    """Shards arrive, some in two parts; after a restart the rest, and all of them a second time."""
    rows = stored(tables.with_shards(views.qa_dual(spark, sf_dir), 100), "rows")
    source, sink, checkpoint = (shared_path(spark, n) for n in ("arrived", "ingested", "checkpoint"))
    half = F.xxhash64("record_id") % 2 == 0
    schema = T.StructType([*rows.drop("shard").schema.fields, rows.schema["shard"]])
    for part in (rows.where(half), rows):
        part.repartition("shard").write.mode("append").partitionBy("shard").parquet(source)
        arrived = shards.shard_stream(spark, source, schema, max_files=MAX_FILES, max_batches=MAX_BATCHES)
        shards.ingest_shards(arrived, sink, checkpoint)
    return tables.read_dataset(spark, sink, schema).drop("run", "batch_id")


@query
def o51_progress_stream(spark, sf_dir):
    root = _sharded(spark, sf_dir)
    schema = T.StructType([*DUAL_FIELDS, T.StructField("shard", T.StringType())])
    sink, checkpoint = shared_path(spark, "progress"), shared_path(spark, "checkpoint")
    stream = shards.shard_stream(spark, root, schema, max_files=MAX_FILES, max_batches=MAX_BATCHES)
    shards.progress_stream(stream, sink, checkpoint, ["shard"])
    return shards.latest_progress(spark, sink)


# User functions


@query
def o52_score(spark, sf_dir):
    scorers = {
        "exact_match": (F.col("outputs") == F.col("targets")).cast("double"),
        "length_ratio": F.round(F.length("outputs") / F.greatest(F.length("targets"), F.lit(1)), 6),
        "names_source": F.contains(F.col("outputs"), F.col("topic")).cast("double"),
    }
    return re_.score(views.eval_rows(spark, sf_dir), scorers).select("record_id", *scorers)


def word_lengths(pdf: pd.DataFrame) -> pd.DataFrame:
    """A batched map for the query below: text length and line count of every row."""
    return pd.DataFrame(
        {
            "doc_id": pdf["doc_id"],
            "n_text": pdf["text"].str.len().astype("int64"),
            "n_lines": pdf["text"].str.count("\n").astype("int64") + 1,
        }
    )


@query
def o53_map_batches(spark, sf_dir):
    docs = views.table(spark, sf_dir, "documents").select("doc_id", "text")
    return map_batches(docs, word_lengths, "doc_id long, n_text long, n_lines long")


# Whole entries


@query
def entry_answers(spark, sf_dir):
    """Answers are filled, sharded in two runs, and consolidated with what was done before."""
    dual = views.qa_dual(spark, sf_dir)
    blank = [tx.is_blank(F.col(p)) for p in pa.PROVIDERS]
    done = pa.stamp_settings(dual.where(~blank[0] & ~blank[1]))
    models = dict.fromkeys(pa.PROVIDERS, stand_in_model)
    filled = stored(an.fill_answers(dual, models, shared_path(spark, "answers"), done), "filled")
    root = shared_path(spark, "shards")
    for only in (F.xxhash64("shard") % 2 == 0, None):
        tables.write_shards(filled, root, rows_per_bucket=ROWS_PER_RANGE // 16, only=only)
    new = tables.read_shards(spark, root, filled.schema).drop("shard")
    table = tables.consolidate(done, new, shared_path(spark, "train"))
    return table.select("record_id", "gpt_output", "gemini_output", "temperature", *_long("max_tokens"))


@query
def entry_training(spark, sf_dir):
    """One source is selected, flattened, made chat text, encoded and split."""
    train, test = tr.training_rows(views.qa_dual(spark, sf_dir), "gemini_output", VOCABULARY)
    both = train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))
    ids = F.array_join(F.col("input_ids").cast("array<string>"), " ")
    return both.select("record_id", F.md5(ids).alias("digest"), "truncated", "is_test")


@query
def entry_instructions(spark, sf_dir):
    """Requests are planned, responses validated and appended, and what is still missing is planned.

    The recorded responses of ``record_sets`` stand for those of a model."""
    targets = views.table(spark, sf_dir, "documents").groupBy(F.col("lang").alias("topic")).agg(
        F.count("*").alias("target")
    )
    path, models = shared_path(spark, "records"), ["gpt", "gemini"]
    none = spark.createDataFrame([], "topic string")
    first = stored(ins.planned_requests(none, targets, models), "first")
    accepted, _ = ins.accepted_records(views.record_sets(spark, sf_dir), whole_response=False)
    tables.append_dataset(accepted.select(*[f.name for f in schemas.INSTRUCTION_RECORD.fields]), path)
    have = tables.read_dataset(spark, path, schemas.INSTRUCTION_RECORD)
    second = ins.planned_requests(have, targets, models, planning=2)
    both = first.unionByName(pa.pending_rows(second, first))
    return both.select("record_id", *_long("planning", "round"), "topic", "model", "prompt")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Do the sources' predictions pass the acceptance gate?"""
    return o41_check_thresholds(spark, sf_dir)
