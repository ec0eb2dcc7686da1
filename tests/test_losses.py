"""Inputs that must not get lost, and replies that must not stop a job."""

import json
import warnings

import pytest
from pyspark.sql import functions as F, types as T

from millrace.functions.replies import OutputContract, read_reply, with_reply_columns
from millrace.operators.calls import CallPolicy, call_with_retry
from millrace.operators.reports import score_statistics
from millrace.plans.conversations import convert_datasets, merge_collections
from millrace.plans.generation import done_keys

PAIRS = {"org/pairs": {"configs": [None], "format_style": "prompt_response", "column_mapping": {"prompt": "q", "response": "a"}}}


def test_all_splits_and_formats(spark, tmp_path):
    folder = tmp_path / "org" / "pairs"
    folder.mkdir(parents=True)
    for name in ("train-0.jsonl", "train_extra.jsonl", "chat.jsonl"):
        (folder / name).write_text(json.dumps({"q": name, "a": "x"}) + "\n")
    spark.createDataFrame([("parquet", "x")], "q string, a string").write.parquet(str(folder / "train-1.parquet"))
    rows = convert_datasets(spark, str(tmp_path), PAIRS).select("split", F.get_json_object("raw_data", "$.q").alias("q")).collect()
    assert {(r.split, r.q) for r in rows} == {
        ("train", "train-0.jsonl"), ("train", "parquet"), ("train_extra", "train_extra.jsonl"), ("chat", "chat.jsonl")
    }
    only = convert_datasets(spark, str(tmp_path), PAIRS, splits={"org/pairs": ["train"]})
    assert only.count() == 2
    with warnings.catch_warnings(record=True) as said:
        warnings.simplefilter("always")
        more = {**PAIRS, "org/none": PAIRS["org/pairs"]}
        assert convert_datasets(spark, str(tmp_path), more).count() == 4
    assert any("org/none" in str(w.message) for w in said)


def test_nested_splits_and_json(spark, tmp_path):
    folder = tmp_path / "org" / "pairs"
    files = {
        "data/train-00000-of-00002.jsonl": json.dumps({"q": "a", "a": "x"}) + "\n" + json.dumps({"q": "a2", "a": "x"}),
        "data/train-00001-of-00002.json": json.dumps({"q": "b", "a": "x"}) + "\n" + json.dumps({"q": "b2", "a": "x"}),
        "test.json": json.dumps([{"q": "c", "a": "x"}, {"q": "c2", "a": "x"}], indent=1),
        "validation/0000.jsonl": json.dumps({"q": "d", "a": "x"}),
        "README.md": "x",
    }
    for name, text in files.items():
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(text)
    found = lambda sets: {(r.config, r.split, r.q) for r in convert_datasets(spark, str(tmp_path), sets).select("config", "split", F.get_json_object("raw_data", "$.q").alias("q")).collect()}
    assert found(PAIRS) == {(None, "train", q) for q in ("a", "a2", "b", "b2")} | {(None, "test", "c"), (None, "test", "c2"), (None, "validation", "d")}
    (tmp_path / "org" / "set" / "data" / "easy").mkdir(parents=True)
    (tmp_path / "org" / "set" / "data" / "easy" / "train-0.jsonl").write_text(json.dumps({"q": "e", "a": "x"}))
    assert found({"org/set": {**PAIRS["org/pairs"], "configs": ["easy"]}}) == {("easy", "train", "e")}
    (tmp_path / "org" / "none").mkdir()
    (tmp_path / "org" / "none" / "rows.csv").write_text("q,a\n")
    with pytest.raises(FileNotFoundError, match="org/none"):
        convert_datasets(spark, str(tmp_path), {**PAIRS, "org/none": PAIRS["org/pairs"]})


def test_merge_inputs_in_subfolders(spark, tmp_path):
    for name in ("a/in.jsonl", "b/in.jsonl", "c d+e.jsonl"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(json.dumps({"k": name}) + "\n")
    groups = [{"name": "g", "output_file": "o", "input_files": ["b/in.jsonl", "c d+e.jsonl", "a/in.jsonl"]}]
    schema = T.StructType.fromDDL("k string")
    rows = merge_collections(spark, str(tmp_path), groups, schema).collect()
    assert {(r.src_ord, r.k) for r in rows} == {(0, "b/in.jsonl"), (1, "c d+e.jsonl"), (2, "a/in.jsonl")}


def test_replies_of_all_kinds(spark):
    contract = OutputContract(keys=("score",), required=("score",), defaults={"score": 0})
    replies = [
        '{"a":' * 100_000, "{" * 400_000, '{"score": ' + "9" * 5000 + "}", '{"score": "\\ud800"}', '{"score": 4.7}', '{"score": "4"}', '{"score": 4.0}', None,
    ]
    frame = spark.createDataFrame(list(enumerate(replies)), "i int, reply string")
    rows = {r.i: r for r in with_reply_columns(frame, "reply", contract).collect()}
    assert all(rows[i].reply_error for i in (0, 1, 2, 7))
    assert [rows[i].score for i in (3, 4, 5, 6)] == [None, None, 4, 4]
    assert not any(rows[i].reply_error for i in (3, 4, 5, 6))
    assert read_reply('so: ```json\n{"a": 1}\n``` or {b}') == {"a": 1}


def test_check_that_raises_is_a_format_error():
    def check(reply):
        raise RecursionError("deep")

    result = call_with_retry(lambda m, c: "half \ud800", check, CallPolicy(attempts=2, wait_factor=0.0, wait_min=0.0), {"messages": []})
    assert result[0] == "half ?" and result[2] == "format" and "deep" in result[3]


def test_null_group_has_statistics(spark):
    rows = spark.createDataFrame([("a", 1.0), (None, 2.0), (None, 4.0)], "g string, score double")
    found = {r.g: (r.n, r.median) for r in score_statistics(rows, by=["g"]).collect()}
    assert found == {"a": (1, 1.0), None: (2, 3.0)}


def test_failed_rows_are_not_done(spark):
    done = spark.createDataFrame([("u1", "success"), ("u2", "error"), ("u3", None)], "uid string, status string")
    assert {r.uid for r in done_keys(done).collect()} == {"u1", "u3"}
