"""JSON lists read by blocks."""

import json
import random

import pytest

from millrace.sources import json_array
from millrace.sources.json_array import array_pieces, read_array_rows
from millrace.sources.listing import whole_json_files


def value(draw, depth=0):
    kind = draw.randint(0, 6 if depth < 3 else 3)
    if kind == 0:
        return draw.choice([None, True, 1.5, -3])
    if kind <= 3:
        return "".join(draw.choice('ab,:"\\[]{}\n é') for _ in range(draw.randint(0, 12)))
    if kind == 4:
        return [value(draw, depth + 1) for _ in range(draw.randint(0, 4))]
    return {f"k{i},{i}": value(draw, depth + 1) for i in range(draw.randint(0, 4))}


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("size", ["300b", "64m"])
def test_rows_equal_the_parsed_list(spark, tmp_path, conf, size, indent):
    draw, wanted = random.Random(4), []
    for n in range(6):
        rows = [{"id": f"{n}-{i}", "v": value(draw)} for i in range(draw.choice([0, 1, 80]))]
        wanted += [json.dumps(r) for r in rows]
        (tmp_path / f"f{n}.json").write_text(draw.choice(["", "\n "]) + json.dumps(rows, indent=indent, ensure_ascii=n % 2 == 0) + "\n")
    conf(spark__sql__files__maxPartitionBytes=size, spark__sql__files__openCostInBytes="100")
    paths = [str(tmp_path / f"f{n}.json") for n in range(6)]
    found = [r.text for r in read_array_rows(spark, paths).collect()]
    assert sorted(json.dumps(json.loads(x)) for x in found) == sorted(wanted) and "\n" not in "".join(found)


def test_one_long_line_is_read_by_several_tasks(spark, tmp_path, conf, monkeypatch):
    monkeypatch.setattr(json_array, "BROADCAST_BLOCKS", 0)
    rows = [{"k": i, "t": "x, y" * 20} for i in range(300)] + [{"k": 300, "t": "z, " * 5000}]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    conf(spark__sql__files__maxPartitionBytes="2k", spark__sql__files__openCostInBytes="100")
    assert array_pieces(spark, [str(tmp_path / "a.json")]).rdd.getNumPartitions() > 10
    assert sorted((json.loads(r.text) for r in read_array_rows(spark, [str(tmp_path / "a.json")]).collect()), key=lambda r: r["k"]) == rows


def test_a_file_of_one_object(spark, tmp_path):
    (tmp_path / "a.json").write_text('{\n  "k": [1, 2],\n  "t": "x"\n}\n')
    assert [json.loads(r.text) for r in read_array_rows(spark, [str(tmp_path / "a.json")]).collect()] == [{"k": [1, 2], "t": "x"}]


def test_files_are_told_apart_in_one_job(spark, tmp_path):
    texts = {"lines 1.json": '\n{"a": 1}\n{"a": 2}\n', "list.json": '\n\n[{"a": 1},\n{"a": 2}]', "one.json": '{\n"a": 1}', "empty.json": "\n"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    paths = [str(tmp_path / name) for name in texts]
    assert whole_json_files(spark, paths) == [str(tmp_path / n) for n in ("list.json", "one.json")]
    assert whole_json_files(spark, []) == []
