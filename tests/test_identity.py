import hashlib
import json

from pyspark.sql import functions as F

from millrace.functions.identity import ensure_id, sorted_json, stable_uid, with_uid


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_uid_prefers_own_keys(spark):
    rows = spark.createDataFrame(
        [("u", "i", [("user", "x")]), (None, "i", [("user", "x")]), (None, None, [("system", "é x")])],
        "uid string, id string, messages array<struct<role string, content string>>",
    )
    assert [r.uid for r in with_uid(rows).select("uid").collect()] == ["u", "i", md5("é x")]


def test_uid_of_rows_without_content(spark):
    rows = spark.createDataFrame(
        [([], "b\n\"q\" \\ é", 3), (None, "c", None), ([("user", "")], None, 1)],
        "messages array<struct<role string, content string>>, b string, a int",
    )
    expected = [
        {"messages": [], "b": "b\n\"q\" \\ é", "a": 3},
        {"b": "c"},
        {"messages": [{"role": "user", "content": ""}], "a": 1},
    ]
    expected = [md5(json.dumps(e, sort_keys=True, ensure_ascii=False)) for e in expected]
    assert [r.u for r in rows.select(stable_uid(rows).alias("u")).collect()] == expected


def test_sorted_json_of_nested_values(spark):
    frame = spark.sql("SELECT named_struct('z', 1, 'a', named_struct('k', true, 'b', array('x', null))) AS v, "
                      "map('q', 2, 'd', 1) AS m")
    value = F.struct("v", "m")
    row = frame.select(sorted_json(value, frame.schema).alias("j")).first()
    assert row.j == '{"m": {"d": 1, "q": 2}, "v": {"a": {"b": ["x", null], "k": true}, "z": 1}}'


def test_made_ids_are_stable_and_fill_gaps_only(spark):
    rows = spark.createDataFrame([("a", "x"), ("", "y"), (None, "y"), (None, "z")], "id string, text string")
    first = [r.id for r in ensure_id(rows).orderBy("text", "id").collect()]
    again = [r.id for r in ensure_id(rows.repartition(3)).orderBy("text", "id").collect()]
    assert first == again and first[0] == "a" and first[1] == first[2] != first[3]
    assert all(len(i) == 64 for i in first[1:])
