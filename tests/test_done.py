"""Resume against a bucketed table of done keys."""

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import executed_plan
from millrace.operators.done import KeyFilter, frequent_keys, pending_against, write_done
from millrace.operators.resume import pending


@pytest.fixture
def tables(spark):
    """A third of the rows on one done key, a sixth on a pending one, a tenth without; every third key is done."""
    kind = F.pmod(F.xxhash64("id"), F.lit(30))
    key = F.when(kind < 10, "hot").when(kind < 15, "hot pending").when(kind >= 18, F.concat(F.lit("k"), F.pmod("id", F.lit(4000))))
    source = spark.range(0, 20_000, 1, 6).select("id", key.alias("uid"), F.lit("wide").alias("text"))
    done = spark.range(0, 4000, 3).select(F.concat(F.lit("k"), F.col("id")).alias("uid")).unionByName(spark.createDataFrame([("hot",), ("hot",), (None,), ("else",)], "uid string"))
    name = f"done_{uuid.uuid4().hex}"
    return source, done, write_done(done, "uid", name, 8)


def rows(frame):
    return sorted(r.id for r in frame.collect())


@pytest.mark.parametrize("filtered", [False, True])
@pytest.mark.parametrize("frequent", [0, 5])
def test_equals_the_plain_resume(spark, tables, filtered, frequent):
    source, done, table = tables
    bloom = KeyFilter.of(table, "uid") if filtered else None
    found = pending_against(source, table, "uid", bloom, frequent)
    assert rows(found) == rows(pending(source, done, "uid")) and found.columns == source.columns


def test_the_done_side_stays(spark, tables):
    source, _, table = tables
    plan = executed_plan(pending_against(source, table, "uid", frequent=5))
    lines = plan.splitlines()
    at = next(i for i, x in enumerate(lines) if "Bucketed: true" in x)
    depth, above = len(lines[at]), []
    for line in reversed(lines[: at + 1]):
        indent = len(line) - len(line.lstrip(" :+-*"))
        if indent < depth:
            depth, above = indent, [*above, line]
    assert any("SortMergeJoin" in x for x in above) and not any("Exchange" in x for x in above)


def test_frequent_keys_and_most_pending_rows_skip_the_join(spark, tables):
    source, _, table = tables
    assert set(frequent_keys(source, "uid", 2)) == {"hot", "hot pending"}
    bloom = KeyFilter.of(table, "uid")
    keys = spark.range(100_000).select(F.concat(F.lit("new"), F.col("id")).alias("uid"))
    assert keys.where(bloom.may_hold(spark, "uid")).count() < 2500
    assert table.where(~bloom.may_hold(spark, "uid")).count() == 0


def test_bounds_and_compound_keys(spark, tables):
    _, _, table = tables
    assert KeyFilter.of(table, "uid", most_bits=1 << 10) is None
    source = spark.createDataFrame([(1, "a", "m"), (2, "a", "n"), (3, None, "m"), (4, "b", None)], "id int, uid string, model string")
    done = spark.createDataFrame([("a", "m"), ("b", None), ("a", "m")], "uid string, model string")
    kept = write_done(done, ["uid", "model"], f"done_{uuid.uuid4().hex}", 3)
    assert kept.count() == 1
    for bloom in (None, KeyFilter.of(kept, ["uid", "model"])):
        assert rows(pending_against(source, kept, ["uid", "model"], bloom)) == [2, 3, 4]
    none = write_done(done.where("false"), ["uid", "model"], f"done_{uuid.uuid4().hex}", 3)
    assert rows(pending_against(source, none, ["uid", "model"], KeyFilter.of(none, ["uid", "model"]))) == [1, 2, 3, 4]
