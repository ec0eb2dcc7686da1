import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from conftest import column_values
from millrace.sources import listing, naming, tables
from millrace.sources.jsonl import read_strict, read_tolerant, rejected_lines, write_jsonl

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("s", T.StringType())])


def test_strict_read(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('\n{"a": 1, "s": "é"}\n   \n{"a": 2}\n')
    assert [tuple(r) for r in read_strict(spark, str(path), SCHEMA).collect()] == [(1, "é"), (2, None)]
    assert read_strict(spark, str(path), SCHEMA, max_rows=1).count() == 1
    path.write_text('{"a": 1}\nbroken\n')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_strict(spark, str(path), SCHEMA).collect()


def test_exact_read_refuses_text_after_the_object(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"a": 1}\n\n{"a": 2, "s": "y"}\n')
    assert [tuple(r) for r in read_strict(spark, str(path), SCHEMA, exact=True).collect()] == [(1, None), (2, "y")]
    path.write_text('{"a": 1}\n{"a": 2} junk\n')
    with pytest.raises(Exception, match="invalid JSON line"):
        read_strict(spark, str(path), SCHEMA, exact=True).collect()


def test_tolerant_read_skips_what_python_cannot_parse(spark, tmp_path):
    lines = ['{"a": 1, "s": "x"}', '{"a": 2} junk', "{'a': 3}", "", " \t{\"a\": 4} ", "[1]", "nope", '{"a": 5,}', '{"a": NaN, "s": "n"}']
    path = tmp_path / "x.jsonl"
    path.write_bytes("\n".join(lines).encode() + b'\n{"a": 6, "s": "b\xffd"}\r\n{"a": 7}\r{"a": 8}')
    rows = read_tolerant(spark, str(path), SCHEMA).collect()
    assert sorted((r.a or 0, r.s) for r in rows) == [(0, "n"), (1, "x"), (4, None), (6, "bd"), (7, None), (8, None)]
    assert rejected_lines(spark, str(path)).first().n_rejected == 5


def test_written_lines_keep_nulls_and_non_ascii(spark, tmp_path):
    frame = spark.createDataFrame([(1, "ü"), (2, None)], SCHEMA)
    write_jsonl(frame.coalesce(1), str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("*.json"))
    assert "ü" in text and [json.loads(x) for x in text.splitlines()] == [{"a": 1, "s": "ü"}, {"a": 2, "s": None}]


def test_format_by_extension(spark, tmp_path):
    frame = spark.createDataFrame([(1, "x")], SCHEMA)
    for name in ("t.jsonl", "t.parquet"):
        tables.save(frame, str(tmp_path / name))
        assert tables.load(spark, str(tmp_path / name), SCHEMA).collect() == frame.collect()
    with pytest.raises(ValueError):
        tables.load(spark, "t.csv")


def test_folder_reads_both_formats_not_deeper(spark, tmp_path):
    spark.createDataFrame([(1, "x")], SCHEMA).coalesce(1).toPandas().to_parquet(tmp_path / "a.parquet")
    (tmp_path / "a.jsonl").write_text('{"a": 2, "s": "y"}\nbad\n')
    (tmp_path / "b.txt").write_text("no")
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "c.jsonl").write_text('{"a": 3}\n')
    rows = listing.read_folder(spark, str(tmp_path), SCHEMA, tolerant=True).collect()
    assert sorted((r.a, r.source_file) for r in rows) == [(1, "a.parquet"), (2, "a.jsonl")]
    names = listing.output_names(listing.list_files(spark, str(tmp_path), "a.*")).orderBy("path").collect()
    assert [n.output_name for n in names] == ["a.jsonl.parquet", "a.parquet.parquet"]
    found = listing.read_pattern(spark, str(tmp_path), "*.parquet").collect()
    assert [(r.a, r.source_file) for r in found] == [(1, "a.parquet")]


def test_listing_does_not_read_contents(spark, tmp_path):
    (tmp_path / "x").write_text("abc")
    frame = listing.list_files(spark, str(tmp_path))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1].split("\n")[0]
    assert [(r.file_name, r.length) for r in frame.collect()] == [("x", 3)]


def test_triplet_languages(spark, tmp_path):
    names = ["pt_data_Python.jsonl", "pt_data_Python_part01.jsonl", "pt_data_A_B_part1.jsonl", "pt_data_X_part_y_part02.jsonl", "pt_data_A_part9.jsonl"]
    languages = [n[8:-6].rsplit("_part", 1)[0] if "_part" in n else n[8:-6] for n in names]
    assert column_values(spark, names, lambda v: listing.triplet_language(F.col(v))) == languages
    for i, name in enumerate(names):
        (tmp_path / name).write_text(f'{{"a": {i}}}\n\nbroken\n')
    (tmp_path / "other.jsonl").write_text('{"a": 99}\n')
    rows = listing.read_triplets(spark, str(tmp_path), SCHEMA).collect()
    assert {r.a: r.file_language for r in rows} == dict(enumerate(languages))


def test_stems(spark):
    assert column_values(spark, ["a.b.c", "noext", ".env"], lambda v: listing.stem(F.col(v))) == ["a.b", "noext", ".env"]


def test_names_and_paths(spark):
    rows = spark.createDataFrame([("org/ds", "c"), ("org/ds", None), ("oo.jsonl", None)], "d string, c string")
    name = naming.chat_file_name(F.col("d"), F.col("c"), F.lit("train"))
    assert [r[0] for r in rows.select(name).collect()] == ["ds/org_ds-c-train.jsonl", "ds/org_ds-train.jsonl", "oo/oo-train.jsonl"]
    assert naming.resolve_path("a/{task_name}/{timestamp}/{x}", task_name="t", timestamp="s") == "a/t/s/{x}"


def test_latest_run_has_no_fallback(spark):
    runs = spark.createDataFrame(
        [("20250101_000000", "a", True), ("20250102_000000", "b", False), ("zzz", "c", True)], "stamp string, path string, has_data boolean")
    assert naming.latest_run(runs).collect() == []
    assert naming.latest_run(runs.filter("path <> 'b'")).first().path == "a"


def test_run_folders(spark, tmp_path):
    template, now = f"file:{tmp_path}/{{task_name}}/{{timestamp}}", datetime(2025, 3, 1)
    fresh = f"file:{tmp_path}/t/20250301_000000"
    assert naming.run_folder(spark, template, "t", now=now) == fresh
    spark.createDataFrame([(1, "x")], SCHEMA).write.parquet(f"{tmp_path}/t/20250101_000000")
    (tmp_path / "t" / "notes").mkdir()
    assert naming.run_folder(spark, template, "t", now=now) == f"file:{tmp_path}/t/20250101_000000"
    assert naming.run_folder(spark, template, "t", resume=False, now=now) == fresh
    (tmp_path / "t" / "20250201_000000").mkdir()
    assert naming.run_folder(spark, template, "t", now=now) == fresh


def test_publish_keeps_the_earlier_table(spark, tmp_path):
    target = str(tmp_path / "t")
    for i in (1, 2):
        spark.createDataFrame([(i, "x")], SCHEMA).write.parquet(str(tmp_path / f"s{i}"))
        aside = tables.publish(spark, str(tmp_path / f"s{i}"), target)
    assert spark.read.parquet(target).first().a == 2 and spark.read.parquet(aside).first().a == 1
    assert tables.exists(spark, target)


def test_append_checked(spark, tmp_path):
    a, b = spark.createDataFrame([(1, "x")], SCHEMA), spark.createDataFrame([(2,)], "a bigint")
    rows = tables.append_checked(a, b, str(tmp_path / "s")).collect()
    assert sorted((r.a, r.s) for r in rows) == [(1, "x"), (2, None)]
