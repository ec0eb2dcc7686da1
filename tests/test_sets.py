import math

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import SMALL, executed_plan
from millrace.operators import ordinals, resume, unions
from millrace.operators.fanout import over_models, over_runs
from millrace.sources.jsonl import write_jsonl

FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def ids(frame, column="k"):
    return sorted([r[column] for r in frame.collect()], key=lambda v: (v is not None, v))


@pytest.mark.parametrize("n", [0, 1, 7, 1000])
def test_ordinals_are_dense_and_ordered(spark, n):
    frame = spark.range(n).select((F.col("id") * F.col("id") % 1009).alias("r"), "id").repartition(3)
    numbered, total = ordinals.with_ordinal(frame, ["r", "id"], ranges=8)
    rows = sorted(((x.r, x.id, x.ord) for x in numbered.collect()))
    assert total == n and [x[2] for x in rows] == list(range(1, n + 1))


def test_ordinals_with_one_frequent_rank_and_nulls(spark):
    rank = F.when(F.col("id") < 400, 5).when(F.col("id") < 450, F.lit(None)).otherwise(F.col("id"))
    frame = spark.range(1000).select(rank.alias("r"), "id")
    numbered, _ = ordinals.with_ordinal(frame, ["r", "id"], ranges=16)
    rows = sorted((x.r is not None, x.r or 0, x.id, x.ord) for x in numbered.collect())
    assert [x[3] for x in rows] == list(range(1, 1001))


def test_ordinals_of_texts_with_a_common_prefix_and_descending(spark):
    frame = spark.range(500).select(F.concat(F.lit("folder/with/a/long/name/"), F.col("id").cast("string")).alias("path"))
    numbered, _ = ordinals.with_ordinal(frame, ["path"], ranges=8)
    assert [r.path for r in numbered.orderBy("ord").collect()] == sorted(r.path for r in frame.collect())
    downwards, _ = ordinals.with_ordinal(spark.range(300), [F.desc("id")], ranges=8)
    assert [r.id for r in downwards.orderBy("ord").collect()] == list(range(299, -1, -1))


def test_a_frequent_first_value_is_spread_over_tasks(spark):
    frame = spark.range(4000).select(F.lit("same").alias("r"), "id")
    numbered, total = ordinals.with_ordinal(frame, ["r", "id"], ranges=8)
    sizes = [r["count"] for r in numbered.groupBy(F.input_file_name()).count().collect()]
    assert total == 4000 and len(sizes) == 8 and max(sizes) < 1000
    assert numbered.where(F.col("ord") != F.col("id") + 1).count() == 0


@FEW
@given(st.integers(0, 40), st.integers(1, 50))
def test_split_equals_slices_and_joins_back(spark, n, k):
    frame = spark.range(n).withColumnRenamed("id", "k")
    rows = sorted((r.chunk, r.ord, r.k) for r in ordinals.split_rows(frame, ["k"], chunks=k).collect())
    size = math.ceil(n / k) if n else 1
    slices = [list(range(n))[i * size : (i + 1) * size] for i in range(k)]
    expected = [(i + 1, v + 1, v) for i, part in enumerate(slices) for v in part]
    assert rows == expected


def test_split_sizes_and_names(spark):
    rows = ordinals.split_rows(spark.range(10), ["id"], chunks=4, stem="in")
    counts = {r.chunk_name: r["count"] for r in rows.groupBy("chunk_name").count().collect()}
    assert counts == {"in_split_0001": 3, "in_split_0002": 3, "in_split_0003": 3, "in_split_0004": 1}
    by_rows = ordinals.split_rows(spark.range(10), ["id"], rows_per_chunk=5)
    assert by_rows.select("chunk").distinct().count() == 2
    with pytest.raises(ValueError):
        ordinals.split_rows(spark.range(1), ["id"])


def test_no_task_gets_the_whole_table(spark):
    numbered, _ = ordinals.with_ordinal(spark.range(5000), ["id"], ranges=16)
    assert "SinglePartition" not in executed_plan(numbered)


def test_first_n_per_group(spark):
    frame = spark.range(3000).select((F.col("id") % 7 < 5).alias("g"), "id")
    expected = {(g, i) for g in (True, False) for i in sorted(x for x in range(3000) if (x % 7 < 5) == g)[:40]}
    assert {(r.g, r.id) for r in ordinals.first_n_per_group(frame, ["g"], ["id"], 40).collect()} == expected
    assert "WindowGroupLimit" in executed_plan(ordinals.first_n_per_group(frame, ["g"], ["id"], 40))
    assert {(r.g, r.id) for r in ordinals.first_n_per_group(frame, ["g"], ["id"], 40, parts=1).collect()} == expected


def test_file_limits_and_shards(spark):
    files = spark.createDataFrame([(l, f"{l}/{i}") for l in "abc" for i in range(4)], "language string, path string")
    assert ids(ordinals.limit_files(files, 7, "language"), "path") == ["a/0", "a/1", "b/0", "b/1", "c/0", "c/1"]
    assert ids(ordinals.limit_files(files, 1, "language"), "path") == ["a/0", "b/0", "c/0"]
    assert ordinals.limit_files(files, -1).count() == 12 and ids(ordinals.limit_files(files, 2), "path") == ["a/0", "a/1"]
    shards = [ids(ordinals.shard_files(files, i, 5), "path") for i in range(5)]
    assert [len(s) for s in shards] == [3, 3, 3, 3, 0] and sorted(sum(shards, [])) == ids(files, "path")


def test_spread_is_reproducible_and_even(spark):
    frame = spark.range(4000).select(F.lit("same").alias("uid"), "id")
    one, two = (ordinals.spread(frame.repartition(n), "uid", 1, 8) for n in (2, 5))
    assert sorted(r.id for r in one.collect()) == list(range(4000))
    assert one.orderBy("id").collect() == two.orderBy("id").collect()
    sizes = [r["count"] for r in one.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 800


KEYS = st.lists(st.one_of(st.none(), st.integers(0, 8)), max_size=30)


@FEW
@given(KEYS, KEYS)
def test_resume_laws(spark, source, done):
    src = spark.createDataFrame([(k, i) for i, k in enumerate(source)], "k int, i int")
    fin = spark.createDataFrame([(k,) for k in done], "k int")
    left = resume.pending(src, fin, "k")
    expected = [(k, i) for i, k in enumerate(source) if k is None or k not in done]
    assert sorted([(r.k is None, r.k or 0, r.i) for r in left.collect()]) == sorted([(k is None, k or 0, i) for k, i in expected])
    assert resume.pending(left, fin, "k").count() == left.count()
    kept = src.filter("k is not null").join(fin.distinct(), "k", "left_semi")
    assert left.count() + kept.count() == len(source)


@FEW
@given(KEYS, KEYS)
def test_keep_first_equals_python(spark, existing, new):
    old = spark.createDataFrame([(k,) for k in existing], "k int")
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(new)], "k int, i int")
    seen, expected = set(existing) - {None}, []
    for i, k in enumerate(new):
        if k is None or k not in seen:
            expected.append((k, i))
        if k is not None:
            seen.add(k)
    got = [(r.k, r.i) for r in resume.new_rows(old, rows, "k", ["i"]).collect()]
    assert sorted(got, key=lambda t: t[1]) == expected


def test_keep_latest_and_statuses(spark):
    rows = spark.createDataFrame([("a", 1, "error"), ("a", 2, "success"), ("b", 1, "error")], "uid string, t int, status string")
    assert {(r.uid, r.status) for r in unions.latest_status(rows, "uid", ["t"]).collect()} == {("a", "success"), ("b", "error")}


def test_retry_merge_keeps_prior_and_adds_new_once(spark):
    prior = spark.createDataFrame([("a", 0), ("a", 1)], "uid string, t int")
    retried = spark.createDataFrame([("a", 5), ("b", 7), ("b", 6), (None, 8)], "uid string, t int")
    got = sorted(((r.uid or "", r.t) for r in resume.retry_merge(prior, retried, "uid", ["t"]).collect()))
    assert got == [("", 8), ("a", 0), ("a", 1), ("b", 6)]
    empty = prior.limit(0)
    assert resume.retry_merge(empty, retried, "uid", ["t"]).count() == 3


def test_skewed_keys_are_split(spark, conf):
    """A key with a third of the rows, and a third without a key: AQE splits both."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1",
         spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
         spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
         spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
         spark__sql__shuffle__partitions="16")
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.col("id").cast("string"))
    source = spark.range(0, 60_000, 1, 12).select(key.alias("uid"), "id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    done = spark.range(0, 30_000, 1, 6).select(F.when(F.col("id") % 2 == 0, F.lit("done")).otherwise(F.col("id").cast("string")).alias("uid"))
    left = resume.pending(source, done, "uid")
    rows = left.groupBy(F.coalesce("uid", F.lit("none")).isin("hot", "none").alias("big")).agg(
        F.count(F.lit(1)).alias("n"), F.max("text")
    )
    counts = {r.big: r.n for r in rows.collect()}
    taken = {str(i) for i in range(30_000) if i % 2}
    assert counts == {True: 40_000, False: sum(str(i) not in taken for i in range(1, 60_000, 3))}
    assert "skew=true" in executed_plan(rows)


def test_duplicate_done_keys_are_collapsed_before_they_move(spark):
    done = spark.range(0, 10_000, 1, 4).select(F.lit("hot").alias("uid"))
    keys = resume.distinct_keys(done, "uid")
    assert keys.count() <= 4
    plan = executed_plan(keys)
    assert plan.index("HashAggregate") < plan.index("Exchange") < plan.rindex("HashAggregate")


def test_finished_files(spark):
    files = spark.createDataFrame([(p,) for p in "abcd"], "path string")
    stats = spark.createDataFrame([("a", "out/a", True), ("b", "out/b", True), ("c", "out/c", False), ("x", "", True)],
                                  "raw_file_path string, formatted_file_path string, processing_complete boolean")
    outputs = spark.createDataFrame([("out/a",), ("out/c",)], "path string")
    assert ids(resume.pending_files(files, stats, outputs), "path") == ["b", "c", "d"]
    assert ids(resume.pending_files(files, stats), "path") == ["c", "d"]


def test_unions(spark):
    a, b = spark.createDataFrame([(1, "x")], "k int, s string"), spark.createDataFrame([(2,)], "k int")
    merged = unions.union_in_order([a, b])
    assert sorted((r.src_ord, r.k, r.s) for r in merged.collect()) == [(0, 1, "x"), (1, 2, None)]
    assert "Exchange" not in executed_plan(merged)
    with pytest.raises(ValueError):
        unions.union_in_order([])
    files = spark.createDataFrame([("f1", 1), ("f2", 2), ("f3", 3)], "file_name string, k int")
    groups = [{"name": "g", "output_file": "g.jsonl", "input_files": ["f2", "f1"]}, {"name": "h", "output_file": "h.jsonl", "input_files": ["f1"]}]
    got = {(r.group, r.src_ord, r.k) for r in unions.merge_groups(files, groups).collect()}
    assert got == {("g", 0, 2), ("g", 1, 1), ("h", 0, 1)}
    assert unions.merge_groups(files, groups, ["h"]).count() == 1
    shards = spark.createDataFrame([("p.jsonl",), ("p_error.jsonl",), ("p_error_retry_1.jsonl",), ("p_success_retry_1.jsonl",)], "file_name string")
    assert ids(unions.merge_shards(shards), "status") == ["error", "success"]
    assert ids(unions.merge_shards(shards, merge_errors=False), "status") == ["success"]


def test_fan_out_multiplies_in_place(spark):
    rows = over_models(over_runs(spark.range(3), 2), ["a", "b"])
    assert rows.count() == 12
    assert "Join" not in executed_plan(rows) and "Exchange" not in executed_plan(rows)


def test_written_chunks_join_back(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    write_jsonl(ordinals.split_rows(docs, ["doc_id"], chunks=6, stem="d"), str(tmp_path / "c"), ["chunk_name"])
    back = spark.read.schema("doc_id bigint, text string, ord bigint, chunk_name string").json(str(tmp_path / "c"))
    rows = [(r.doc_id, r.text) for r in back.orderBy("chunk_name", "ord").collect()]
    assert rows == [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]
