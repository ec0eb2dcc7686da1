import json
import sys

import pytest
from pyspark.cloudpickle.cloudpickle import register_pickle_by_value
from pyspark.sql import functions as F, types as T

from millrace.functions.replies import OutputContract
from millrace.operators.calls import CallPolicy
from millrace.plans import conversations, generation, preprocess, reports, scoring
from millrace.sources.listing import file_path

register_pickle_by_value(sys.modules[__name__])
FAST = CallPolicy(concurrency=4, wait_factor=0.0, wait_min=0.0)
RAW = "id string, text string, content string, body string, source string, n int"
CONVERSATION = "array<struct<role string, content string>>"


def test_universal_order_of_steps(spark):
    rows = spark.createDataFrame(
        [
            ("1", "  keep   this\ttext  ", None, None, "s", 1),
            ("2", "short", None, None, "s", 1),
            ("3", "has BLOCKED words in it", None, None, "s", 1),
            ("4", None, "blocked text from content", None, "s", 1),
            ("", "an id is made for this", None, None, None, 1),
            ("6", "no number in this row", None, None, "s", 0),
        ],
        RAW,
    )
    config = {
        "source_name": "web",
        "field_mapping": {"title": "id", "both": {"type": "combine", "fields": ["id", "n", "body"], "separator": "+"},
                          "const": {"type": "constant", "value": "c"}},
        "filters": {"min_text_length": 3, "required_fields": ["n"], "blacklist_patterns": ["blocked words"]},
        "transformations": {
            "text_cleaning": {"remove_extra_whitespace": True, "remove_characters": ["his"]},
            "computed_fields": {"chars": {"type": "text_length"}, "tokens": {"type": "token_count"},
                                "gone": {"type": "text_length", "source_field": "nope"}},
        },
    }
    out = {r.text: r for r in preprocess.universal(rows, config, max_tokens=2048).collect()}
    assert set(out) == {"keep t text", "short", "blocked text from content", "an id is made for t"}
    row = out["keep t text"]
    assert (row.title, row.both, row.const, row.chars, row.tokens, row.content_truncate_2k) == ("1", "1+1", "c", 11, 5, "keep t text")
    assert out["an id is made for t"].source == "web" and len(out["an id is made for t"].id) == 64
    assert "gone" not in row.asDict()


def test_rows_without_text_pass_the_text_filters(spark):
    rows = spark.createDataFrame([("1", None, "none blocked"), ("2", "none", "c")], "id string, text string, content string")
    config = {"filters": {"min_text_length": 10, "blacklist_patterns": ["none"]},
              "transformations": {"computed_fields": {"n": {"type": "text_length"}}}}
    out = preprocess.universal(rows, config).collect()
    assert [(r.id, r.text, r.n) for r in out] == [("1", "none blocked", None)]


def test_empty_ids(spark):
    rows = spark.createDataFrame([("", "a"), (None, "b")], "id string, text string")
    assert [len(r.id) for r in preprocess.universal(rows, {}).orderBy("text").collect()] == [64, 64]
    assert [len(r.id) for r in preprocess.base_rows(rows).orderBy("text").collect()] == [0, 64]
    assert [len(r.id) for r in preprocess.raw_code(rows).orderBy("text").collect()] == [0, 64]


def test_raw_code_needs_a_text_column(spark):
    rows = spark.createDataFrame([("x" * 20_001,)], "code string")
    row = preprocess.raw_code(rows, max_tokens=1024).first()
    assert row.text == row.code and row.source == "github_raw_code" and row.content_truncate_1k == row.code
    with pytest.raises(ValueError):
        preprocess.raw_code(spark.createDataFrame([("x",)], "other string"))


def test_triplets(spark):
    rows = spark.createDataFrame([("a", "t", "Go"), (None, "t", None), ("c", "", "Go")], "id string, text string, lg string")
    out = preprocess.triplets(rows, max_tokens=1024).collect()
    assert [(r.language, r.has_readme, r.content_truncate_1k) for r in out] == [
        ("Go", "Unknown", "t"), ("Unknown", "Unknown", "t"), (None, None, None)]
    assert out[1].id and preprocess.preprocessor("triplet_filter") is preprocess.triplets
    assert preprocess.preprocessor(None) is preprocess.preprocessor("?") is preprocess.universal


def test_preprocess_files_skips_finished_ones(spark, tmp_path):
    for name in ("a", "b", "c"):
        text = "drop" if name == "b" else "text"
        spark.createDataFrame([(name, text)], "id string, text string").toPandas().to_parquet(tmp_path / f"{name}.parquet")

    def read(paths):
        return spark.read.parquet(*paths).select("*", file_path().alias("source_path"))

    def run(out, stats=None, limit=-1):
        job = lambda d: preprocess.universal(d, {"filters": {"blacklist_patterns": ["drop"]}})
        return preprocess.preprocess_files(spark, str(tmp_path), str(tmp_path / out), read, job, "?.parquet", stats, limit)

    rows, first = run("out1")
    assert sorted(r.id for r in rows.collect()) == ["a", "c"]
    assert {(r.file_name, r.n_sample) for r in first.collect()} == {("a.parquet", 1), ("b.parquet", 0), ("c.parquet", 1)}
    spark.createDataFrame([("d", "text")], "id string, text string").toPandas().to_parquet(tmp_path / "d.parquet")
    rows, second = run("out2", first)
    assert [r.id for r in rows.collect()] == ["d"]
    with pytest.raises(FileNotFoundError):
        run("out3", first.unionByName(second))
    with pytest.raises(FileNotFoundError):
        run("out4", first, limit=3)
    gone = second.withColumn("formatted_file_path", F.lit(str(tmp_path / "gone")))
    rows, _ = run("out5", first.unionByName(gone))
    assert [r.id for r in rows.collect()] == ["d"]


def test_stats_of_files_with_one_name(spark, tmp_path):
    for folder, n in (("x", 2), ("y z+1", 5)):
        (tmp_path / folder).mkdir()
        spark.range(n).toPandas().to_parquet(tmp_path / folder / "same.parquet")

    def read(paths):
        return spark.read.parquet(*paths).select("*", file_path().alias("source_path"))

    _, stats = preprocess.preprocess_files(spark, f"{tmp_path}/*", str(tmp_path / "out"), read, lambda d: d)
    found = stats.select(F.element_at(F.split("raw_file_path", "/"), -2).alias("folder"), "n_sample").collect()
    assert {(r.folder, r.n_sample) for r in found} == {("x", 2), ("y z+1", 5)}


TASK = scoring.ScoringTask.from_config(
    {
        "prompt_template": {"system_text": "S", "prompt_text": "Rate {text}"},
        "output_config": {"require_json": True, "json_keys": ["score", "tag"], "json_key_must_exists": ["score"],
                          "json_default_values": {"score": 3, "tag": "none"}},
    }
)


def rating(messages, chat):
    assert [m["role"] for m in messages] == ["system", "user"]
    text = messages[-1]["content"].removeprefix("Rate ")
    if text == "boom":
        raise RuntimeError("down")
    return {"plain": "no json", "null": '{"score": null}'}.get(text, json.dumps({"score": len(text), "tag": text}))


def test_scoring_outcomes(spark):
    rows = spark.createDataFrame([("1", "abc", 9), ("2", "boom", 9), ("3", "plain", 9), ("4", "null", 9)], "id string, text string, score int")
    out = {r.id: r for r in scoring.score_rows(rows, TASK, rating, FAST).collect()}
    assert {k: (r.api_status, r.score, r.tag, r.error_kind, r.api_attempts) for k, r in out.items()} == {
        "1": ("success", 3, "abc", None, 1),
        "2": ("error", 3, "none", "call", 3),
        "3": ("error", 3, "none", "format", 3),
        "4": ("success", None, "none", None, 1),
    }
    assert out["1"].api_fail_reason == "" and out["3"].api_return == "no json" and out["2"].api_return == ""
    assert out["2"].api_fail_reason == "API call failed after all retries: RuntimeError: down"
    assert out["3"].api_fail_reason.startswith("JSON format validation failed after all retries: ")


def test_scoring_without_json(spark):
    task = scoring.ScoringTask("{text}", OutputContract(require_json=False, defaults={"score": 1}))
    row = scoring.score_rows(spark.createDataFrame([("1", "abc")], "id string, text string"), task, lambda m, c: "free", FAST).first()
    assert (row.api_status, row.api_return, row.score) == ("success", "free", 1)


def test_scoring_resume_and_debug_limit(spark):
    rows = spark.createDataFrame([(str(i), "t" * i, f"f{i % 2}") for i in range(1, 9)], "id string, text string, source_file string")
    done = scoring.score_rows(rows.filter("id < 4"), TASK, rating, FAST)
    gone = done.limit(1).withColumn("id", F.lit("no longer there"))
    both = scoring.score_with_resume(rows, TASK, rating, done.unionByName(gone), policy=FAST)
    assert sorted(r.id for r in both.collect()) == sorted([*map(str, range(1, 9)), "no longer there"])
    again = scoring.score_rows(rows, TASK, rating, FAST, done=both)
    assert again.count() == 0
    first = scoring.score_rows(rows, TASK, rating, FAST, done=done, debug_items=1)
    assert sorted(r.id for r in first.collect()) == ["4", "5"]
    stats = {r.source_file: (r.n_rows, r.n_success) for r in scoring.scoring_stats(first).collect()}
    assert stats == {"f0": (1, 1), "f1": (1, 1)}


def conversation_rows(spark):
    return spark.createDataFrame(
        [("a", [("system", "first"), ("user", "q")], 1), (None, [("user", "hello")], 2), (None, [("user", "hello")], 3),
         (None, [], 4), ("e", None, 5), (None, [("user", "boom")], 6)],
        f"uid string, messages {CONVERSATION}, n int",
    )


def echo(messages, chat):
    if messages[0]["content"] == "boom":
        raise RuntimeError("down")
    return messages[0]["role"] + ":" + messages[0]["content"]


def test_generation_outcomes(spark):
    results = generation.generate(conversation_rows(spark), echo, FAST)
    good = {r.n: r for r in generation.success_rows(results).collect()}
    assert {n: r.response for n, r in good.items()} == {1: "user:first", 2: "user:hello", 3: "user:hello"}
    assert [(m.role, m.content) for m in good[1].final_messages] == [("user", "first"), ("assistant", "user:first")]
    bad = {r.n: r for r in generation.error_rows(results).collect()}
    assert {n: (r.error_type, r.error) for n, r in bad.items()} == {
        4: ("input", generation.MISSING_MESSAGES), 5: ("input", generation.MISSING_MESSAGES), 6: ("call", "RuntimeError: down")}
    assert all(r.timestamp and r.task_index is not None and r.uid for r in bad.values())
    assert "error" not in good[1].asDict()


def test_generation_resume_twice_is_resume_once(spark):
    rows = conversation_rows(spark)
    first = generation.success_rows(generation.generate(rows.filter("n <= 2"), echo, FAST))
    left = generation.generate(rows, echo, FAST, done=first)
    assert sorted(r.n for r in left.collect()) == [4, 5, 6], "a second row with a finished uid is skipped too"
    done = first.unionByName(generation.success_rows(left))
    assert sorted(r.n for r in generation.pending_requests(rows, done).collect()) == [4, 5, 6]
    assert generation.pending_requests(rows, dedupe=True).count() == 5
    without_uid = first.drop("uid")
    assert sorted(r.n for r in generation.pending_requests(rows, without_uid).collect() if r.n in (2, 3)) == []


def test_retry(spark):
    results = generation.generate(conversation_rows(spark), echo, FAST)
    merged, left = generation.retry_failed(
        generation.error_rows(results), generation.success_rows(results), lambda m, c: "now", FAST)
    assert {r.n: r.response for r in merged.collect()} == {1: "user:first", 2: "user:hello", 3: "user:hello", 6: "now"}
    assert sorted(r.n for r in left.collect()) == [4, 5] and "error" not in merged.columns
    empty = generation.success_rows(results).limit(0)
    fresh, _ = generation.retry_failed(generation.error_rows(results), empty, lambda m, c: "now", FAST)
    assert [r.n for r in fresh.collect()] == [6]


def test_models_in_one_run(spark):
    rows = spark.range(10).select(F.array(F.struct(F.lit("user").alias("role"), F.col("id").cast("string").alias("content"))).alias("messages"), "id")

    def transport(messages, chat):
        if chat["model"] == "b" and messages[0]["content"] == "7":
            raise RuntimeError
        return chat["model"]

    work = generation.fan_out(rows, ["a", "b"], ["id"], 4)
    results = generation.generate(work, transport, FAST, model_column="model")
    summary = {r.model: (r.total_files, r.success_count, r.error_count) for r in generation.model_summary(results).collect()}
    assert summary == {"a": (4, 10, 0), "b": (4, 9, 1)}
    only_a = generation.success_rows(results).filter("model = 'a'")
    left = generation.generate(work, transport, FAST, done=only_a, model_column="model")
    assert {(r.model, r.status) for r in left.select("model", "status").distinct().collect()} == {("b", "success"), ("b", "error")}
    assert left.count() == 10
    merged, failed = generation.retry_failed(
        generation.error_rows(results), generation.success_rows(results), lambda m, c: "now", FAST, model_column="model")
    assert merged.count() == 20 and failed.count() == 0


def test_merge_results(spark, tmp_path):
    files = {
        "m1/in_split_0001/in_split_0001.jsonl": '{"k": 1}\n{"k": 2}\n',
        "m1/in_split_0001/in_split_0001_error.jsonl": '{"k": 3}\n',
        "m1/in_split_0001/in_split_0001_error_retry_1.jsonl": '{"k": 4}\n',
        "m1/in_split_0002/in_split_0002.jsonl": '{"k": 5}\nbroken\n',
        "m2/in_split_0001/in_split_0001.jsonl": '{"k": 6}\n',
        "m2/other/x.jsonl": '{"k": 7}\n',
    }
    for name, text in files.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    schema = T.StructType([T.StructField("k", T.LongType())])
    rows = generation.merge_results(spark, str(tmp_path), schema)
    assert sorted((r.model, r.status, r.k) for r in rows.collect()) == [
        ("m1", "error", 3), ("m1", "success", 1), ("m1", "success", 2), ("m2", "success", 6)]
    assert generation.merge_results(spark, str(tmp_path), schema, merge_errors=False).count() == 3


def test_merge_collections(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"k": 1}\nbad\n')
    (tmp_path / "b.jsonl").write_text('{"k": 2}\n\n{"k": 3} x\n')
    schema = T.StructType([T.StructField("k", T.LongType())])
    groups = [{"name": "g", "output_file": "g.jsonl", "input_files": ["b.jsonl", "a.jsonl"]},
              {"name": "h", "output_file": "h.jsonl", "input_files": ["missing.jsonl"]}]
    rows = conversations.merge_collections(spark, str(tmp_path), groups, schema, ["g"]).collect()
    assert sorted((r.src_ord, r.k, r.output_file) for r in rows) == [(0, 2, "g.jsonl"), (1, 1, "g.jsonl")]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        conversations.merge_collections(spark, str(tmp_path), groups, schema).collect()


def test_log_report_from_file(spark, tmp_path):
    entries = [{"timestamp": f"2025-01-01T00:0{i}:00.5", "job_index": 0, "file": f"f{i % 2}", "item_id": str(i),
                "status": "error" if i == 3 else "success", "score": None if i == 3 else i, "fail_reason": ""} for i in range(6)]
    (tmp_path / "log.jsonl").write_text("\n".join(map(json.dumps, entries)))
    parts = {name: frame.collect() for name, frame in reports.log_report(reports.read_log(spark, str(tmp_path / "log.jsonl"))).items()}
    assert parts["scores"][0].median == 2.0 and parts["scores"][0].n == 5
    assert [(r.status, r.n) for r in parts["statuses"]] == [("success", 5), ("error", 1)]
    assert [(r.file, r.n) for r in parts["files"]] == [("f0", 3), ("f1", 3)]
    total = parts["totals"][0]
    assert (total.total_files, total.processed_items, total.failed_items, total.processing_speed) == (2, 6, 1, 1.2)
    assert parts["batches"][0].batch_size == 6


def test_profile(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"input": [{"role": "user"}], "output": "x"}\n{"output": null, "odd.name": 1}\n')
    parts = reports.profile(spark, str(tmp_path / "a.jsonl"), preview=1)
    assert parts["rows"].first().n_rows == 2 and parts["preview"].count() == 1
    fields = {(r.field, r.type): r.n_rows for r in parts["fields"].collect()}
    assert fields == {("input", "array"): 1, ("output", "string"): 1, ("output", "void"): 1, ("odd.name", "bigint"): 1}
