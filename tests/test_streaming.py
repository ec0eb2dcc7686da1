from pyspark.sql import functions as F, types as T

from millrace.streaming import append_increments, read_increments, run_available

SCHEMA = T.StructType([T.StructField("k", T.LongType())])


def test_only_new_files_are_processed(spark, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    (tmp_path / "in").mkdir()
    for round_, keys in enumerate(([1, 2], [3], [])):
        if keys:
            (tmp_path / "in" / f"{round_}.json").write_text("\n".join(f'{{"k": {k}}}' for k in keys))
        stream = read_increments(spark, source, SCHEMA, files_per_batch=1)
        run_available(stream, out, progress, transform=lambda d: d.withColumn("round", F.lit("x")))
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_a_repeated_batch_replaces_its_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"k": 1}\n{"k": 2}')
    stream = read_increments(spark, str(tmp_path / "in"), SCHEMA)
    for progress in ("p1", "p2"):
        run_available(stream, str(tmp_path / "out"), str(tmp_path / progress))
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2]


def test_statuses_are_parted_from_one_computation(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"k": 1}\n{"k": 2}\n{"k": 3}')
    stream = read_increments(spark, str(tmp_path / "in"), SCHEMA)

    def judge(df):
        status = F.when(F.col("k") == 1, "success").when(F.col("k") == 2, "error")
        return df.select("k", status.alias("status"), F.expr("uuid()").alias("call"))

    query = append_increments(stream, str(tmp_path / "out"), str(tmp_path / "p"), judge, "status", every="1 second")
    query.processAllAvailable()
    query.stop()
    read = {part: {r.k: r.call for r in spark.read.parquet(str(tmp_path / "out" / part)).collect()} for part in ("all", "success", "error")}
    assert set(read["success"]) == {1} and set(read["error"]) == {2, 3}
    assert read["all"] == {**read["success"], **read["error"]}
