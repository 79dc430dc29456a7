"""Subword tokens of given vocabularies."""

import os

import pytest
from pyspark.sql import functions as F

from pairtables.operators.subwords import encode_subwords, load_encoder, subword_count, subword_ids
from pairtables.plans.training import subword_training_rows

FOLDER = "/opt/tokenizers"
FILES = [f"{FOLDER}/{n}" for n in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model", "word_bpe_49k.json")]
TEXTS = [None, "", "one two three", "naïve 東京 🙂\n\n  x", "<|endoftext|> </s>", "word " * 3000]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no vocabulary files here")


def frame(spark):
    rows = [(i, t, i % 2) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "record_id long, text string, ids int")


@pytest.mark.parametrize("path", FILES)
def test_ids_and_counts(spark, path):
    got = frame(spark).select(
        "record_id", subword_ids(path)(F.col("text")).alias("all"), subword_ids(path, 4)(F.col("text")).alias("cut"),
        subword_count(path)(F.col("text")).alias("n"),
    )
    for row in got.collect():
        wanted = load_encoder(path)([TEXTS[row["record_id"]] or ""])[0]
        assert row["all"]["ids"] == wanted and row["cut"]["ids"] == wanted[:4]
        assert row["n"] == row["all"]["n"] == row["cut"]["n"] == len(wanted)


def test_same_ids_from_merges_and_ranks():
    texts = [t or "" for t in TEXTS]
    texts.remove("<|endoftext|> </s>")
    assert load_encoder(FILES[0])(texts) == load_encoder(FILES[1])(texts)


def test_special_strings_are_text():
    assert 50_256 not in load_encoder(FILES[0])(["a <|endoftext|> b"])[0]
    assert not {1, 2} & set(load_encoder(FILES[2])(["<s> a </s>"])[0])


def test_unknown_kind():
    with pytest.raises(ValueError, match="known kind"):
        load_encoder("vocabulary.txt")


def test_encode(spark):
    rows = {r["record_id"]: r for r in encode_subwords(frame(spark), FILES[0], 50_256, max_len=8).collect()}
    for i, text in enumerate(TEXTS):
        wanted = load_encoder(FILES[0])([text or ""])[0]
        n = min(8, len(wanted))
        assert rows[i]["input_ids"] == rows[i]["labels"] == wanted[:8] + [50_256] * (8 - n)
        assert rows[i]["attention_mask"] == [1] * n + [0] * (8 - n)
        assert rows[i]["truncated"] == (len(wanted) > 8)
        assert rows[i]["ids"] == i % 2  # a column of the caller stays


def test_nothing_is_shuffled(spark):
    plan = encode_subwords(frame(spark), FILES[0], 0)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ArrowEvalPython" in plan


def test_training_rows(spark):
    rows = [(i, f"ask {i}", f"say {i}" if i % 3 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "record_id long, instruction string, gpt_output string")
    train, test = subword_training_rows(df, "gpt_output", FILES[0], 50_256, max_len=40)
    both = train.unionByName(test)
    assert both.count() == 40 and set(both.select(F.size("input_ids")).distinct().toPandas().iloc[:, 0]) == {40}


def test_ids_of_a_whole_batch_are_not_held_at_once():
    import tracemalloc

    import pandas as pd

    def peak(n_rows):
        find, texts = subword_ids(FILES[0], 4).func, pd.Series(["one two three four " * 2000] * n_rows)
        list(find(iter([texts[:1]])))  # the vocabulary is loaded
        tracemalloc.start()
        found = pd.concat(find(iter([texts])))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(found) == n_rows and set(map(len, found["ids"])) == {4}
        return most

    assert peak(400) < 2 * peak(60)
