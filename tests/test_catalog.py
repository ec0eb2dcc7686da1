"""Every registered query against its SQL, and rules its plan must keep."""

import datetime
import decimal
import math

import duckdb
import pytest

from conftest import SMALL, executed_plan
from millrace.catalog import entries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
ENTRIES = entries()


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return float(value) if isinstance(value, decimal.Decimal) else value


def ordered(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    table = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(table, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", ENTRIES)
def test_query_equals_sql(spark, sql, name):
    frame = ENTRIES[name].run(spark, SMALL)
    rows = frame.collect()
    plan = executed_plan(frame)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "BatchEvalPython" not in plan
    for row in rows[:1]:
        assert not any(isinstance(v, (list, dict, datetime.datetime, decimal.Decimal)) for v in row), "plain types only"
    assert ENTRIES[name].sql, "every query has SQL"
    result = sql.execute(ENTRIES[name].sql)
    assert ordered(frame.columns, rows) == ordered([d[0] for d in result.description], result.fetchall())


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["doc_id", "score"] and entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
