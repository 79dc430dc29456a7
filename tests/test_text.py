import re

import pytest
from pyspark.sql import functions as F, types as T

from pairtables import fixed_values as fixed
from pairtables.functions import text as tx


def values(spark, texts, *columns):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [tuple(r)[1:] if len(r) > 2 else r[1] for r in df.select("i", *columns).orderBy("i").collect()]


def test_strip_and_blank_follow_python(spark):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    texts = ["", " ", "a", "\ta b\n", "　x\xa0", *spaces, *[f"{s}y{s}" for s in spaces], "​z"]
    assert values(spark, texts, tx.strip(F.col("t"))) == [t.strip() for t in texts]
    assert values(spark, [*texts, None], tx.is_blank(F.col("t"))) == [not t.strip() for t in texts] + [True]
    assert values(spark, ["", " ", "a", None], tx.is_empty(F.col("t"))) == [True, False, False, True]


def test_tokens(spark):
    texts = ["", "  ", "The CAT, the cat!", "naïve café 3x", "...", None, "a\nb\tc"]
    expected = [None if t is None else re.findall("[a-z0-9]+", t.lower()) for t in texts]
    assert values(spark, texts, tx.tokens(F.col("t"))) == expected


def test_flatten_json_shapes(spark):
    cells = ['{"text":"a"}', '{"other":1}', '["x",{"text":"y"},{"z":1},2]', "[]", '"s"', "5", "true", "null", "{bad", None]
    assert values(spark, cells, tx.flatten_json(F.col("t"))) == ["a", "", "x y  2", "", "s", "5", "True", None, None, None]


def test_flatten_typed_cells(spark):
    schema = "i int, s struct<text string>, a array<struct<text string>>, l array<string>"
    rows = [
        (0, ("x",), [("p",), (None,), ("q",)], ["m", "n"]),
        (1, (None,), [], []),
        (2, None, None, None),
    ]
    df = spark.createDataFrame(rows, schema)
    flat = df.select("i", *[tx.flatten_text(F.col(c), df.schema[c].dataType).alias(c) for c in "sal"])
    assert [tuple(r) for r in flat.orderBy("i").collect()] == [
        (0, "x", "p  q", "m n"), (1, "", "", ""), (2, None, None, None),
    ]
    plain = df.select(tx.flatten_text(F.lit("t"), T.StringType()).alias("t")).first()
    assert plain["t"] == "t"


def test_normalize_content(spark):
    df = spark.createDataFrame([(["\t a ", " b\n"],)], "c array<string>")
    assert df.select(tx.normalize_content(F.col("c"), df.schema["c"].dataType)).first()[0] == "a   b"


def test_normalize_prediction(spark):
    cells = [
        '{"predictions":[{"generated_text":"a"},"b"],"outputs":["c"]}', '{"outputs":["c"]}', '{"x":1}',
        '["d",{"generated_text":"e"},{"n":1},7]', "[]", "{bad", None,
    ]
    assert values(spark, cells, tx.normalize_prediction(F.col("t"))) == [
        ["a", "b"], ["c"], [], ["d", "e", '{"n":1}', "7"], [], None, None,
    ]


def test_preview(spark):
    texts = ["a" * 80, "a" * 81, "", None]
    assert values(spark, texts, tx.preview(F.col("t"), 80)) == ["a" * 80, "a" * 80 + "...", "", None]
    assert values(spark, ["ab"], tx.preview(F.col("t"), 50, always=True)) == ["ab..."]


def test_slugs(spark):
    assert values(spark, ["Org/Some-Name-0.6B"], tx.model_slug(F.col("t"), F.lit("x1"))) == ["Org_Some_Name_06B_x1"]
    named = tx.model_slug(F.col("t"), F.lit("x1"), "main", "m")
    assert values(spark, ["a/b"], named) == ["main.m.a_b_x1"]
    endpoint = tx.endpoint_slug(tx.endpoint_name(F.col("t"), F.lit(7)))
    assert values(spark, ["Main.m.A,b-c"], endpoint) == ["main-m-ab-c-v7"]


def test_chat_template(spark):
    df = spark.createDataFrame([(1, "q", "a")], "record_id int, instruction string, output string")
    template = tx.ChatTemplate("[", "] ", "\n", "end")
    assert tx.chat_format(df, template).first()["text"] == "[user] q\n[assistant] a\nend"


@pytest.mark.parametrize("kind", sorted(fixed.PROMPTS))
def test_prompts_follow_their_template(spark, kind):
    row = {
        "batch_size": 10, "topic": "t'x", "model": "m", "max_tokens": 400, "temperature": 0.2,
        "instruction": "do {it}", "inputs": "q", "targets": "r", "outputs": "o",
    }
    df = spark.createDataFrame([row])
    assert tx.render_prompt(df, kind).first()["prompt"] == fixed.PROMPTS[kind].format(**row)


def test_map_cells(spark):
    df = spark.sql("select map('text', 'hi', 'n', 'x') as m union all select map('n', 'x') union all select null")
    kind = df.schema["m"].dataType
    assert [r[0] for r in df.select(tx.flatten_text(F.col("m"), kind)).collect()] == ["hi", "", None]
    lists = df.select(F.array("m", F.create_map(F.lit("text"), F.lit("b"))).alias("l"))
    found = lists.select(tx.flatten_text(F.col("l"), lists.schema["l"].dataType)).collect()
    assert [r[0] for r in found] == ["hi b", " b", " b"]


def test_no_text_without_both_turns(spark):
    from pairtables.plans.training import left_out, training_text

    df = spark.createDataFrame(
        [(1, "q", "a"), (2, None, "a"), (3, "q", None), (4, None, None)], "record_id long, instruction string, gpt_output string"
    )
    assert [r["record_id"] for r in training_text(df, "gpt_output").collect()] == [1]
    assert tuple(left_out(df, "gpt_output").first()) == (2, 1)
    chat = tx.chat_format(df.withColumnRenamed("gpt_output", "output"))
    assert [r["text"] is None for r in chat.orderBy("record_id").collect()] == [False, True, True, True]
