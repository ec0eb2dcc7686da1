import random

from pyspark.sql import functions as F, types as T

from millrace.operators.ordinals import split_rows
from millrace.operators.unions import in_merged_order, merge_chunks
from millrace.plans import conversations, reports
from millrace.sources.jsonl import in_written_order, line_order, read_tolerant, write_jsonl
from millrace.sources.tables import append_checked

ROW = T.StructType([T.StructField("k", T.StringType())])


def shuffled(n, seed=1):
    keys = [f"{i:05d}" for i in range(n)]
    random.Random(seed).shuffle(keys)
    return keys


def write_lines(path, keys):
    path.write_text("".join(f'{{"k": "{k}"}}\n' for k in keys))


def test_lines_keep_their_order_over_blocks(spark, tmp_path, conf):
    conf(spark__sql__files__maxPartitionBytes="2k", spark__sql__files__openCostInBytes="512")
    keys = shuffled(3000)
    write_lines(tmp_path / "in.jsonl", keys)
    rows = read_tolerant(spark, str(tmp_path / "in.jsonl"), ROW, places=True)
    assert rows.rdd.getNumPartitions() > 5
    assert [r.k for r in rows.orderBy(*line_order()).collect()] == keys
    chunks = split_rows(rows, line_order(), chunks=4, stem="in")
    assert [r.k for r in chunks.orderBy("ord").collect()] == keys
    assert chunks.groupBy("chunk_name").count().orderBy("chunk_name").collect()[3] == ("in_split_0004", 750)


def test_split_and_merge_give_the_lines_back(spark, tmp_path):
    keys = shuffled(2000, 2)
    write_lines(tmp_path / "in.jsonl", keys)
    rows = split_rows(read_tolerant(spark, str(tmp_path / "in.jsonl"), ROW, places=True), line_order(), chunks=7)
    write_jsonl(in_written_order(rows, ["chunk_name", "ord"]).select("k", "chunk_name"), str(tmp_path / "out"), ["chunk_name"])
    back = read_tolerant(spark, str(tmp_path / "out/*/*.json"), ROW, places=True)
    assert [r.k for r in merge_chunks(back).collect()] == keys


def test_numbers_in_names_count_by_value(spark, tmp_path):
    for number in (2, 10, 9):
        write_lines(tmp_path / f"x_{number}.jsonl", [f"{number}b", f"{number}a"])
    back = read_tolerant(spark, str(tmp_path / "*.jsonl"), ROW, places=True)
    assert [r.k for r in merge_chunks(back).collect()] == ["2b", "2a", "9b", "9a", "10b", "10a"]


def test_merged_collections_keep_line_order(spark, tmp_path):
    for name, keys in (("a", "zyx"), ("b", "cab")):
        write_lines(tmp_path / f"{name}.jsonl", keys)
    groups = [{"name": "g", "output_file": "g.jsonl", "input_files": ["b.jsonl", "a.jsonl"]}]
    rows = conversations.merge_collections(spark, str(tmp_path), groups, ROW)
    assert "".join(r.k for r in in_merged_order(rows).collect()) == "cabzyx"


def test_preview_is_the_first_lines(spark, tmp_path):
    write_lines(tmp_path / "a.jsonl", "zyxab")
    preview = reports.profile(spark, str(tmp_path / "a.jsonl"), preview=2)["preview"]
    assert sorted(r.line for r in preview.collect()) == ['{"k": "y"}', '{"k": "z"}']


def test_append_counts_empty_inputs(spark, tmp_path):
    some = spark.range(5)
    assert append_checked(some, some.where("false"), str(tmp_path / "one")).count() == 5
    assert append_checked(some.where("id < 0"), some, str(tmp_path / "two")).count() == 5
    more = some.select((F.col("id") + 5).alias("id"))
    assert {r.id for r in append_checked(some, more, str(tmp_path / "three")).collect()} == set(range(10))
