import statistics

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import executed_plan
from millrace.operators import reports


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.integers(-3, 3).map(float), st.floats(-1e6, 1e6)), max_size=60))
def test_statistics_equal_python(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "score double")
    given_scores = [v for v in values if v is not None]
    row = reports.score_statistics(rows).collect()
    if not given_scores:
        assert row == []
        return
    (row,) = row
    assert row.n == len(given_scores) and row.median == statistics.median(given_scores)
    assert (row.minimum, row.maximum) == (min(given_scores), max(given_scores))


def test_exact_median_of_large_and_skewed_scores(spark):
    value = F.when(F.col("id") % 3 == 0, F.lit(0.25)).otherwise(F.rand(5))
    rows = spark.range(0, 60_000, 1, 6).select((F.col("id") % 2).alias("g"), value.alias("score")).cache()
    whole = reports.score_statistics(rows, accuracy=200).first()
    assert whole.median == rows.select(F.median("score")).first()[0]
    groups = {r.g: r.median for r in reports.score_statistics(rows, by=["g"], accuracy=200).collect()}
    assert groups == {r.g: r.m for r in rows.groupBy("g").agg(F.median("score").alias("m")).collect()}
    rows.unpersist()


def test_empty_log(spark):
    log = spark.createDataFrame([], "timestamp string, file string, status string, score double")
    totals = reports.run_totals(log).first()
    assert (totals.total_files, totals.processed_items, totals.success_rate) == (0, 0, 0.0)
    assert reports.status_distribution(log).collect() == [] and reports.top_files(log).collect() == []
    assert reports.generation_summary(log).first().success_rate == 0.0


def test_status_shares_count_unknown_rows_in_the_total(spark):
    log = spark.createDataFrame([("success",)] * 3 + [("error",)] + [(None,)] * 4, "status string")
    assert [(r.status, r.n, r.percentage) for r in reports.status_distribution(log).collect()] == [
        ("success", 3, 37.5), ("error", 1, 12.5)]


def test_ties_are_broken_by_name(spark):
    rows = spark.createDataFrame([(f"f{i:02d}",) for i in range(12)] * 2, "file string")
    assert [r.file for r in reports.top_files(rows).collect()] == [f"f{i:02d}" for i in range(10)]


def test_batches(spark):
    rows = spark.range(250).select("id", F.when(F.col("id") < 120, "success").otherwise("error").alias("status"))
    out = [(r.batch_size, r.success_count, r.error_count) for r in reports.batch_summary(rows, ["id"]).orderBy("batch").collect()]
    assert out == [(100, 100, 0), (100, 20, 80), (50, 0, 50)]


def test_shards_and_languages(spark):
    rows = spark.createDataFrame([("m", "a", "success"), ("m", "a", "error"), ("m", "b", "success"), ("n", "c", "error")],
                                 "model string, file_name string, status string")
    out = {r.model: tuple(r)[1:] for r in reports.shard_summary(rows, ["model"]).collect()}
    assert out == {"m": (2, 2, 1, 200 / 3), "n": (0, 0, 1, 0.0)}
    files = spark.createDataFrame([("go", 3), ("go", 0), ("c", 0)], "language string, n_sample int")
    languages = reports.language_summary(files)
    assert {tuple(r) for r in languages.collect()} == {("go", 2, 3, 1), ("c", 1, 0, 0)}
    assert tuple(reports.language_totals(languages).first()) == (2, 1, 3, 3, 50.0)


def test_duplicates_and_resume_counts(spark):
    rows = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "id string")
    assert {(r.id, r.n) for r in reports.duplicate_ids(rows).collect()} == {("a", 2), (None, 2)}
    counts = reports.resume_counts(rows, rows.filter("id = 'b'"), ["uid", "id"])
    assert counts.first().asDict() == {"n_rows": 5, "n_uid_made": 2, "n_remaining": 1, "n_skipped": 4}
    assert "Cartesian" not in executed_plan(counts) and "NestedLoop" not in executed_plan(counts)


def test_nested_profile(spark):
    from millrace.plans.reports import nested_profile

    lines = [
        '{"a": {"b": [1, 2.5, null, {"c": "x"}]}, "m": {"k1": 1, "k2": "t", "k3": {"z": 1}}}',
        '{"a": "text", "m": {"k4": 1}, "few": {"x": true}}',
        '{"a": {"b": []}, "m": {}}',
        "broken",
        "[1]",
    ]
    frame = spark.createDataFrame([("f", x) for x in lines] + [("g", '{"a": null}'), ("g", None)], "file_name string, line string").repartition(3)
    found = {(r.file_name, r.path, r.type): r.n_values for r in nested_profile(frame, map_keys=3).collect()}
    assert found == {
        ("f", "a", "object"): 2, ("f", "a", "string"): 1, ("f", "a.b", "array"): 2, ("f", "a.b[]", "bigint"): 1, ("f", "a.b[]", "double"): 1,
        ("f", "a.b[]", "null"): 1, ("f", "a.b[]", "object"): 1, ("f", "a.b[].c", "string"): 1, ("f", "m", "map"): 3, ("f", "m.*", "bigint"): 2,
        ("f", "m.*", "string"): 1, ("f", "m.*", "object"): 1, ("f", "m.*.z", "bigint"): 1, ("f", "few", "object"): 1, ("f", "few.x", "boolean"): 1, ("g", "a", "null"): 1,
    }
    assert nested_profile(frame.limit(0)).collect() == []
