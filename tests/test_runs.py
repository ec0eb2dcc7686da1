"""Queries that write their input as files: more files, not larger tasks, as the table grows."""

import glob

import duckdb
import pytest

from conftest import SMALL, optimized_plan
from millrace.catalog import runs
from millrace.session import staging_dir
from millrace.sources import json_array
from test_catalog import ordered

#: Query, its staged folder, and what was one file there however large the table.
FILES = [
    ("io16_batches", "incoming", "lang=en/*.parquet"),
    ("io17_timed", "incoming", "lang=en/*.parquet"),
    ("io18_mismatch", "sources", "lang=en/*.json"),
    ("se4_files", "shards", "model=en/split=*_0001/*.txt"),
    ("io11_lists", "lists", "config=two/split=*/*.txt"),
]


@pytest.mark.parametrize("name, folder, files", FILES, ids=[f[0] for f in FILES])
def test_a_group_is_written_by_several_tasks(spark, conf, monkeypatch, name, folder, files):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")  # shares this small would be merged
    monkeypatch.setattr(runs, "pieces", lambda *_: 6)
    before = set(glob.glob(f"{staging_dir(spark)}/{folder}-*"))
    frame = runs.ENTRIES[name].run(spark, SMALL)
    rows = frame.collect()
    written = [p for p in set(glob.glob(f"{staging_dir(spark)}/{folder}-*")) - before if glob.glob(f"{p}/*=*")]
    assert len(written) == 1 and len(glob.glob(f"{written[0]}/{files}")) > 1
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    result = connection.execute(runs.ENTRIES[name].sql)
    assert ordered(frame.columns, rows) == ordered([d[0] for d in result.description], result.fetchall())


def test_block_begins_grow_no_array(spark):
    pieces = spark.createDataFrame([("f", n, f'[{{"a": "{n}') for n in range(5)], "file string, block long, piece string")
    starts = json_array._starts(pieces)
    assert "aggregate(" not in optimized_plan(starts)
    # An odd number of quotes each, the first block begins outside: every third quote opens or closes.
    assert [(r.block, r.inside, r.place, r.base) for r in starts.orderBy("block").collect()] == [(n, n % 2 == 1, n, 1) for n in range(5)]


def test_a_list_ends_in_its_own_file(spark, conf):
    """However Spark merges small tasks, a list and its closing bracket are written by one."""
    conf(spark__sql__shuffle__partitions="12", spark__sql__adaptive__coalescePartitions__parallelismFirst="false")
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="16k", spark__sql__adaptive__coalescePartitions__minPartitionSize="1b")
    assert runs.ENTRIES["io11_lists"].run(spark, SMALL).where("doc_id is null").count() == 0
