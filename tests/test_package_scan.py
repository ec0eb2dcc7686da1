"""Packages read by blocks against packages read as rows."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, optimized_plan
from millrace.catalog.inputs import read_by_blocks
from millrace.functions import packages as pk
from millrace.session import staging_dir
from millrace.sources import package_scan
from millrace.sources.listing import read_packages
from millrace.sources.package_scan import BEFORE, BEHIND, BODY, SECTION, next_state, read_entries, repository_columns

TAGS = ["<files>", "</files>", "</file>", '<file path="a.py">', '<file path="docs/README.md">', '<file path="x/.gitignore">', '<file path=".gitignore">', '<file path="LICENSE">', '<file path="">', "<file path=\"open"]


def package(draw, lines):
    """Tags in any order, among words; most packages begin like one."""
    parts = ["intro\n<files>\n"] if draw.random() < 0.8 else []
    for _ in range(lines):
        parts.append(draw.choice(TAGS) if draw.random() < 0.35 else "w" * draw.randint(0, 30))
        parts.append(draw.choice(["\n", "\n", "\r\n", "", " ", "\n\n"]))
    # Sections that end at once say little; most ends come late.
    text = "".join(p for p in parts if p != "</files>" or draw.random() < 0.1)
    return text + draw.choice(["</files>", "</file></files>", "\n</files>\nrest <file path=\"late\">x</file>", ""])


def in_rows(spark, root):
    """(file name, path, body) and (file name, named paths) by the functions that hold a package in a row."""
    sections = pk.with_section(read_packages(spark, root))
    entries = sections.select("file_name", F.explode(pk.file_entries("section")).alias("e")).select("file_name", "e.path", "e.body")
    return sections, sorted(map(tuple, entries.collect()))


@pytest.mark.parametrize("size", ["200b", "64m"])
def test_entries_equal_those_of_whole_packages(spark, tmp_path, conf, size):
    draw = random.Random(3)
    for n in range(200):
        folder = tmp_path / ["c", "py"][n % 2]
        folder.mkdir(exist_ok=True)
        (folder / f"u_r{n}_ab.xml").write_bytes(package(draw, draw.randint(0, 60)).encode())
    sections, wanted = in_rows(spark, str(tmp_path))
    flags = {r.file_name: tuple(r)[1:] for r in sections.select("file_name", pk.mentions(pk.file_paths("section"), "readme"), pk.mentions(pk.file_paths("section"), "license"), pk.has_path(pk.file_paths("section"), ".gitignore"), F.size(pk.file_entries("section")).cast("bigint"), pk.total_lines(pk.file_entries("section")).cast("bigint"), pk.counts_json(pk.extension_counts(pk.file_entries("section")))).collect()}
    conf(spark__sql__files__maxPartitionBytes=size, spark__sql__files__openCostInBytes="100")
    entries, names = read_entries(spark, str(tmp_path))
    base = F.element_at(F.split("file", "/"), -1)
    found = sorted(map(tuple, entries.select(base.alias("f"), "path", "body").collect()))
    assert found == wanted and len(wanted) > 50
    numbers = entries.groupBy("file").agg(F.count("*").alias("n"), F.count_distinct("entry").alias("d")).collect()
    assert all(r.n == r.d for r in numbers)
    columns = repository_columns(entries, names)
    for r in columns.select(base.alias("f"), "has_readme", "has_license", "has_gitignore", "files_with_content", "total_lines", pk.counts_json("file_types").alias("types")).collect():
        assert tuple(r)[1:] == flags[r.f], r.f


def test_an_entry_over_several_blocks(spark, tmp_path, conf):
    body = "\n".join(f"line {i} <b> </fil" for i in range(400))
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "u_r_ab.xml").write_text(f'x\n<files><file path="one">1</file>\n<file path="long">{body}</file> <file path="two">\n2</file></files>\n')
    conf(spark__sql__files__maxPartitionBytes="1k", spark__sql__files__openCostInBytes="100")
    assert package_scan.package_lines(spark, str(tmp_path)).select("block").distinct().count() > 3
    entries, _ = read_entries(spark, str(tmp_path))
    assert sorted((r.entry, r.path, r.body, r.language) for r in entries.collect()) == [(1, "one", "1", "c"), (2, "long", body, "c"), (3, "two", "\n2", "c")]


def test_many_blocks_keep_their_order_without_a_broadcast(spark, tmp_path, conf, monkeypatch):
    monkeypatch.setattr(package_scan, "BROADCAST_BLOCKS", 0)
    body = "\n".join(str(i) for i in range(3000))
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "u_r_ab.xml").write_text(f'<files>\n<file path="long">{body}</file></files>')
    conf(spark__sql__files__maxPartitionBytes="2k", spark__sql__files__openCostInBytes="100")
    entries, _ = read_entries(spark, str(tmp_path))
    assert [r.body for r in entries.collect()] == [body]


def test_states():
    assert [next_state(s, "<files>") for s in range(4)] == [SECTION, SECTION, BODY, BEHIND]
    assert [next_state(s, "</files>") for s in range(4)] == [BEFORE, BEHIND, BEHIND, BEHIND]
    assert [next_state(s, "</file>") for s in range(4)] == [BEFORE, SECTION, SECTION, BEHIND]
    assert [next_state(s, '<file path="x">') for s in range(4)] == [BEFORE, BODY, BODY, BEHIND]


def test_no_packages(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "u_r_ab.xml").write_text("")
    entries, names = read_entries(spark, str(tmp_path))
    assert entries.collect() == [] and repository_columns(entries, names).collect() == []


def test_a_package_in_parts_equals_the_package_in_one_file(spark, tmp_path, conf):
    draw = random.Random(5)
    for n in range(12):
        text = package(draw, 60)
        for kind in ("whole", "parts"):
            (tmp_path / kind / f"l{n}").mkdir(parents=True)
        (tmp_path / "whole" / f"l{n}" / "u_r_ab.xml").write_text(text, newline="")
        lines = text.split("\n")
        for part, first in enumerate(range(0, len(lines), 9)):
            # Names in the order of their numbers, not of their letters.
            (tmp_path / "parts" / f"l{n}" / f"p{part + 7}.xml").write_text("\n".join(lines[first : first + 9]) + "\n", newline="")
    conf(spark__sql__files__maxPartitionBytes="100b", spark__sql__files__openCostInBytes="100", spark__sql__files__maxPartitionNum="3")
    found = []
    for kind in ("whole", "parts"):
        entries, names = read_entries(spark, str(tmp_path / kind), in_parts=kind == "parts")
        columns = repository_columns(entries, names).withColumn("file", F.element_at(F.split("file", "/"), -2))
        found.append([sorted(map(tuple, entries.select("language", "entry", "path", "body").collect())), sorted((r.file, r.files_with_content, r.total_lines, r.has_readme) for r in columns.collect())])
    assert found[0] == found[1] and len(found[0][0]) > 10


def test_parts_without_an_order_are_an_error(spark, tmp_path):
    (tmp_path / "c").mkdir()
    for name in ("p1.xml", "q1.xml"):
        (tmp_path / "c" / name).write_text("<files>\n")
    with pytest.raises(ValueError, match="no part number of its own"):
        read_entries(spark, str(tmp_path), in_parts=True)


def test_blocks_begin_as_the_tags_before_them_say(spark, tmp_path):
    """Random runs of tags in blocks against one walk over them; no array grows by the block."""
    draw, rows, wanted = random.Random(9), [], set()
    for n in range(40):
        state, opened, own = BEFORE, 0, set()
        for block in range(60):
            own.add((f"f{n}", block * 10, state, opened))
            for _ in range(draw.choice([0, 0, 1, 2])):
                tag = draw.choice(["<files>", "</file>", '<file path="a">', "x"] + ["</files>"] * (draw.random() < 0.1))
                rows.append((f"f{n}", block * 10, tag))
                after = next_state(state, tag) if tag != "x" else state
                opened += after == BODY and state == SECTION
                state = after
            rows.append((f"f{n}", block * 10, "w"))
        wanted |= own if state == BEHIND else set()
    # A block's tags on one line keep their order.
    joined = {}
    for file, block, line in rows:
        joined[file, block] = joined.get((file, block), "") + " " + line
    lines = spark.createDataFrame([(*of, line) for of, line in joined.items()], "file string, block long, line string")
    starts = package_scan.block_starts(lines)
    assert {tuple(r) for r in starts.select("file", "block", "state", "entry").collect()} == wanted and len(wanted) > 500
    plan = optimized_plan(starts)
    assert "aggregate(" not in plan and "collect_list" not in plan


def test_blocks_share_tasks(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "u_r_ab.xml").write_text("<files>\n" + "a line\n" * 60_000)
    with read_by_blocks(spark, str(tmp_path), "4k"):
        lines = package_scan.package_lines(spark, str(tmp_path))
        assert lines.select("block").distinct().count() > 90
        assert lines.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism + 1
    assert spark.conf.get("spark.sql.files.maxPartitionNum", None) is None


@pytest.mark.parametrize("name", ["io9_entries", "jb4_repositories"])
def test_no_task_writes_a_whole_package(spark, name):
    """A package of the query is written in parts, ranges of its entries."""
    from millrace.catalog import entries as catalog

    before = set(glob.glob(f"{staging_dir(spark)}/large-*"))
    catalog()[name].run(spark, SMALL)
    (root,) = set(glob.glob(f"{staging_dir(spark)}/large-*")) - before
    assert len(glob.glob(f"{root}/lang=en/*.txt")) > 2
