import json

import pytest
from pyspark.sql import functions as F

from millrace.functions import chatml
from millrace.functions.templates import prompt_messages, render_prompt, template_fields
from millrace.plans.conversations import convert_datasets, to_chat


def chats(frame, style, mapping, **options):
    rows = to_chat(frame, style, mapping, keep_raw=False, **options).collect()
    return [[(m.role, m.content) for m in r.messages] for r in rows]


def test_prompt_response(spark):
    rows = spark.createDataFrame([("a", "b"), ("", "b"), ("a", None), (" ", "b")], "p string, r string")
    assert chats(rows, "prompt_response", {"prompt": "p", "response": "r"}) == [
        [("user", "a"), ("assistant", "b")],
        [("user", " "), ("assistant", "b")],
    ]


def test_instruction_input_strips_only_when_joined(spark):
    rows = spark.createDataFrame([(" do ", "　x ", "r"), (" do ", "", "r"), (" do ", None, "r")], "p string, i string, r string")
    mapping = {"prompt": "p", "input": "i", "response": "r"}
    prompts = [c[0][1] for c in chats(rows, "instruction_input", mapping)]
    assert prompts == ["do \n\n　x", " do ", " do "]
    assert [c[0][1] for c in chats(rows.drop("i"), "instruction_input", mapping)] == [" do "] * 3


def test_sharegpt_drops_other_speakers_and_empty_turns(spark):
    turns = "c array<struct<`from` string, value string>>"
    rows = spark.createDataFrame(
        [([("system", "s"), ("human", "q"), ("gpt", ""), ("gpt", "a"), ("tool", "t"), ("user", "u")],),
         ([("system", "s")],), ([],), (None,)], turns)
    assert chats(rows, "sharegpt", {"conversations": "c"}) == [[("user", "q"), ("assistant", "a"), ("user", "u")]]


def test_messages_and_input_output(spark):
    kind = "m array<struct<role string, content string, extra int>>, o string"
    rows = spark.createDataFrame([([("user", "q", 1)], "a"), ([], "a"), (None, "a"), ([("user", "q", 1)], "")], kind)
    assert chats(rows, "messages", {"messages": "m"}) == [[("user", "q")], [("user", "q")]]
    assert chats(rows, "input_output_messages", {"input": "m", "output": "o"}) == [[("user", "q"), ("assistant", "a")]]
    assert chats(rows, "messages", {"messages": "none"}) == []
    assert chats(rows, "prompt_text_only", {"prompt_text": "o"}) == [[("user", "a")]] * 3


def test_system_prompt_only_where_missing(spark):
    rows = spark.createDataFrame([([("system", "own"), ("user", "q")],), ([("user", "q")],)],
                                 "m array<struct<role string, content string>>")
    out = chats(rows, "messages", {"messages": "m"}, system_prompt="S")
    assert out == [[("system", "own"), ("user", "q")], [("system", "S"), ("user", "q")]]


def test_raw_data_keeps_nulls_and_binary(spark):
    rows = spark.createDataFrame([("a", "b", None, bytearray(b"\x00\x01"))], "p string, r string, n int, x binary")
    row = to_chat(rows, "prompt_response", {"prompt": "p", "response": "r"}).first()
    assert json.loads(row.raw_data) == {"p": "a", "r": "b", "n": None, "x": "AAE="} and row.format == "chatml"


def test_request_modes(spark):
    rows = spark.createDataFrame([([("system", "s"), ("user", "q"), ("assistant", "a"), ("user", "r")],)],
                                 "m array<struct<role string, content string>>")
    ask = {mode: rows.select(chatml.request_messages(F.col("m"), mode).alias("a")).first().a
           for mode in ("first_message", "last_user", "full")}
    assert [(m.role, m.content) for m in ask["first_message"]] == [("user", "s")]
    assert [(m.role, m.content) for m in ask["last_user"]] == [("user", "r")]
    assert len(ask["full"]) == 4
    with pytest.raises(ValueError):
        chatml.request_messages(F.col("m"), "other")


def test_template_equals_format_map(spark):
    rows = spark.createDataFrame([("{x} }}", True, None, 3)], "text string, flag boolean, gap string, n int")
    template = "{{{sample}}} {flag} {gap} {n} {{}} {text}"
    out = rows.select(render_prompt(rows, template, "text", "sample").alias("p")).first().p
    assert out == template.format(sample="{x} }}", flag=True, gap=None, n=3, text="{x} }}")
    assert template_fields(template) == ["sample", "flag", "gap", "n", "text"]


def test_row_field_wins_over_the_input_name(spark):
    rows = spark.createDataFrame([("input", "field")], "text string, sample string")
    assert rows.select(render_prompt(rows, "{sample}", "text", "sample").alias("p")).first().p == "field"


@pytest.mark.parametrize("template", ["{a.b}", "{a[0]}", "{text:>3}", "{text!r}", "{}", "{missing}"])
def test_other_placeholders_are_refused(spark, template):
    rows = spark.createDataFrame([("x",)], "text string")
    with pytest.raises(ValueError):
        render_prompt(rows, template)


def test_system_message_is_optional(spark):
    rows = spark.createDataFrame([("x",)], "text string")
    with_system = rows.select(prompt_messages(F.col("text"), "S").alias("m")).first().m
    assert [m.role for m in with_system] == ["system", "user"]
    assert len(rows.select(prompt_messages(F.col("text"), "").alias("m")).first().m) == 1


def test_datasets_from_files(spark, tmp_path):
    (tmp_path / "org" / "pairs" / "web").mkdir(parents=True)
    (tmp_path / "org" / "pairs" / "web" / "train-0.jsonl").write_text('{"q": "a", "r": "b"}\n{"q": "", "r": "b"}\n')
    (tmp_path / "bare.jsonl").write_text('{"prompt_text": "p"}\n')
    datasets = {
        "org/pairs": {"configs": ["web"], "format_style": "prompt_response", "column_mapping": {"prompt": "q", "response": "r"}},
        "bare.jsonl": {"configs": [None], "format_style": "prompt_text_only", "column_mapping": {"prompt_text": "prompt_text"}},
    }
    rows = convert_datasets(spark, str(tmp_path), datasets).collect()
    assert sorted(r.output_file for r in rows) == ["bare/bare-train.jsonl", "pairs/org_pairs-web-train.jsonl"]
    only = convert_datasets(spark, str(tmp_path), datasets, selected=["bare.jsonl"], add_system_prompt=True).collect()
    assert [(m.role) for m in only[0].messages] == ["system", "user"]
    assert only[0].output_file == "bare/bare-train-with_system.jsonl"
    left = convert_datasets(spark, str(tmp_path), datasets, done={"bare/bare-train.jsonl"})
    assert [r.dataset for r in left.collect()] == ["org/pairs"]
    leaf = convert_datasets(spark, str(tmp_path / "org" / "pairs"), {"org/pairs": datasets["org/pairs"]})
    assert leaf.count() == 1
