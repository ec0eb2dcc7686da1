"""Progress held against output; line numbers by blocks; files judged in one pass."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F, types as T

from conftest import executed_plan
from millrace.operators.ordinals import number_in_blocks, running_sums
from millrace.plans.progress import disagreements, process_files, processed, progress
from millrace.sources.jsonl import is_json_object, number_lines, read_tolerant, split_lines
from millrace.sources.listing import file_path, read_shards

ROW = T.StructType([T.StructField("k", T.LongType())])


@pytest.fixture
def job(spark, tmp_path):
    folder, root, seen = tmp_path / "in", str(tmp_path / "out"), []
    folder.mkdir()

    def read(paths):
        seen.append(sorted(os.path.basename(p) for p in paths))
        return spark.read.schema(ROW).json(paths).withColumn("source_path", file_path())

    def run():
        done = process_files(spark, str(folder), root, read, lambda rows: rows.where("k % 5 <> 0"), "*.json")
        return {os.path.basename(r.path): (r.n_rows, r.reason) for r in done.collect()}

    def write(name, keys):
        (folder / name).write_text("".join(f'{{"k": {k}}}\n' for k in keys))

    return run, write, root, seen


def test_only_files_that_disagree_are_replayed(spark, job):
    run, write, root, seen = job
    write("a.json", range(10))
    write("b.json", range(10, 20))
    write("none.json", [5])
    assert run() == {"a.json": (8, "new"), "b.json": (8, "new"), "none.json": (0, "new")}
    assert run() == {} and len(seen) == 1
    entry = next(r for r in progress(spark, root).collect() if r.path.endswith("a.json"))
    folder = f"{root}/files/run={entry.run:06d}/file={entry.file}"
    spark.read.parquet(folder).limit(2).write.mode("append").parquet(folder)
    assert [(r.n_rows, r.found) for r in disagreements(spark, root).collect()] == [(8, 10)]
    assert processed(spark, root).count() == 8
    assert run() == {"a.json": (8, "mismatch")}
    assert sorted(r.k for r in processed(spark, root).collect()) == [k for k in range(20) if k % 5]
    time.sleep(0.01)
    write("b.json", range(30, 40))
    write("c.json", [41])
    assert run() == {"b.json": (8, "changed"), "c.json": (1, "new")}
    assert sorted(r.k for r in processed(spark, root).collect()) == [k for k in [*range(10), *range(30, 40), 41] if k % 5]
    assert seen[1:] == [["a.json"], ["b.json", "c.json"]]


def test_a_run_that_dies_enters_nothing(spark, tmp_path, job):
    run, write, root, _ = job
    write("a.json", range(10))

    def broken(paths):
        return spark.read.schema(ROW).json(paths).withColumn("source_path", file_path()).withColumn("k", F.raise_error(F.lit("no")).cast("long"))

    with pytest.raises(Exception):
        process_files(spark, str(tmp_path / "in"), root, broken, lambda rows: rows, "*.json")
    assert processed(spark, root) is None
    assert run() == {"a.json": (8, "new")} and processed(spark, root).count() == 8


def test_running_sums(spark, conf):
    frame = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("n")).repartition(5)
    summed, total = running_sums(frame, [F.desc("id")], "n", "before")
    wanted, so_far = {}, 0
    for i in reversed(range(1000)):
        wanted[i] = so_far
        so_far += i % 7
    assert total == so_far and {r.id: r.before for r in summed.collect()} == wanted
    empty, none = running_sums(frame.where("id < 0"), ["id"], "n", "before")
    assert empty.collect() == [] and none == 0


def test_lines_are_numbered_where_they_stand(spark, tmp_path, conf):
    """Two files in many blocks, bad lines between good ones; no exchange but those of the counts."""
    conf(spark__sql__files__maxPartitionBytes="2k", spark__sql__files__openCostInBytes="512")
    wanted = []
    for name in ("x_10", "x_9"):
        lines = [f'{{"k": {len(name) * 10_000 + (i * 37) % 5000}}}' if i % 11 else "bad" for i in range(3000)]
        (tmp_path / f"{name}.jsonl").write_text("\n\n".join(lines) + "\n")
        wanted = [json.loads(x)["k"] for x in lines if x != "bad"] + (wanted if name == "x_9" else [])
    rows = read_tolerant(spark, str(tmp_path / "*.jsonl"), ROW, places=True)
    assert rows.rdd.getNumPartitions() > 10
    numbered, total = number_lines(rows)
    assert total == len(wanted) and [r.k for r in numbered.orderBy("ord").collect()] == wanted
    assert sorted(r.ord for r in numbered.collect()) == list(range(1, total + 1))
    plan = executed_plan(numbered)
    assert "rangepartitioning" not in plan and "Exchange hashpartitioning" not in plan
    chunks = split_lines(rows, chunks=4, stem="x")
    assert [r.n for r in chunks.groupBy("chunk_name").agg(F.count("*").alias("n")).orderBy("chunk_name").collect()] == [-(-total // 4)] * 3 + [total - 3 * -(-total // 4)]


def test_many_blocks_are_joined_without_a_broadcast(spark, monkeypatch):
    import millrace.operators.ordinals as ordinals

    monkeypatch.setattr(ordinals, "BROADCAST_BLOCKS", 3)
    frame = spark.range(0, 1000, 1, 10).withColumn("block", F.spark_partition_id())
    numbered, total = number_in_blocks(frame, ["block"], ["block"])
    assert total == 1000 and all(r.ord == r.id + 1 for r in numbered.collect())


LINES = [
    '{"a": 1}', '{"a": 1} x', '{"a": 1}, {"b": 2}', '{"a": 1}], [{"b": 2}', '{"a": [1, {"b": null}]}', "{'a': 1}", '{"a": 01}', '{"a": NaN}', '{"a": -Infinity}',
    "[1]", "1", '"x"', "null", "{}", "{", "}", '{"a": "\t"}', '{"a": "\\u00e9\\ud800"}', '{"a": 1,}', '{"a": 1, "a": 2}', '{a: 1}', '{"a": tru}', '{"a": "\\x"}', '{"a": 1}/*c*/',
    '{"a": ' + "9" * 1200 + "}", '{"a": ' + "[" * 1100 + "]" * 1100 + "}", '﻿{"a": 1}', '{"a": 1} ', '{"a" 1}', '{"a": .5}', '{"a": 1e5}', '{"a": +1}', '{"a": "\x7f "}',
]


def test_verdicts_are_those_of_the_python_parser(spark):
    def whole(line):
        try:
            return isinstance(json.loads(line), dict)
        except (ValueError, RecursionError):
            return False

    frame = spark.createDataFrame([(i, x) for i, x in enumerate([*LINES, None])], "i int, line string")
    found = {r.i: r.good for r in frame.select("i", is_json_object("line").alias("good")).collect()}
    assert found == {i: whole(x) for i, x in enumerate(LINES)} | {len(LINES): False}


def test_shards_with_a_bad_line_are_left_out_whole(spark, tmp_path, conf):
    conf(spark__sql__files__maxPartitionBytes="1k", spark__sql__files__openCostInBytes="256")
    for model in ("m1", "m2"):
        folder = tmp_path / model / "docs_split_0001"
        folder.mkdir(parents=True)
        lines = [f'{{"k": {i}}}' for i in range(500)]
        (folder / "good.jsonl").write_text("\n".join(lines))
        (folder / "bad.jsonl").write_text("\n".join([*lines, '{"k": 1']))
    rows = read_shards(spark, str(tmp_path), ROW)
    assert sorted({(r.model, r.file_name) for r in rows.collect()}) == [("m1", "good.jsonl"), ("m2", "good.jsonl")]
    assert rows.count() == 1000 and executed_plan(rows).count("Scan text") == 0
