"""Files through a transformation, with progress that is held against what was written.

The log says for each file how long it was, when it was changed and how many rows were
written for it. Before a run the output's footers are counted again: a file counts as done
only if its log entry, its output and the file itself still agree. Any other is run anew,
alone, into a folder of this run; readers take a file's rows from the folder that its last
entry names, so a replay neither loses nor doubles a row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from millrace.sources.commits import CommitLog, rows_by_folder
from millrace.sources.listing import list_files

ENTRY = "path string, length long, modified string, run int, file string, n_rows long"
#: Columns that name a row's output folder.
_FOLDER = ["run", "file"]


def _log(spark: SparkSession, root: str) -> CommitLog:
    return CommitLog(spark, root, ENTRY)


def progress(spark: SparkSession, root: str) -> DataFrame:
    """The last entry of each file with ``found``, the rows its folder holds now; folders are counted by their footers."""
    last = Window.partitionBy("path").orderBy(F.desc("run"))
    entries = _log(spark, root).entries().withColumn("_rank", F.row_number().over(last)).where("_rank = 1").drop("_rank")
    parts = F.split("folder", "/")
    found = rows_by_folder(spark, f"{root.rstrip('/')}/files/run=*/file=*").select(
        F.regexp_replace(F.element_at(parts, -2), "^run=", "").cast("int").alias("run"),
        F.regexp_replace(F.element_at(parts, -1), "^file=", "").alias("file"),
        "found",
    )
    return entries.join(found, _FOLDER, "left").withColumn("found", F.coalesce("found", F.lit(0)))


def disagreements(spark: SparkSession, root: str) -> DataFrame:
    """Files whose output no longer holds what their entry says."""
    return progress(spark, root).where("found <> n_rows").select("path", "run", "n_rows", "found")


def processed(spark: SparkSession, root: str) -> DataFrame | None:
    """The rows of all files whose entry and output agree, each with its ``source_path``; None before the first run."""
    good = progress(spark, root).where("found = n_rows and n_rows > 0").select(*_FOLDER)
    folder = f"{root.rstrip('/')}/files"
    if not _log(spark, root).names() or good.isEmpty():
        return None
    rows = spark.read.option("basePath", folder).parquet(folder)
    rows = rows.withColumns({"run": F.col("run").cast("int"), "file": F.col("file").cast("string")})
    # One row per file on the right: Spark broadcasts it if it is small and prunes folders by it.
    return rows.join(good, _FOLDER, "left_semi").drop(*_FOLDER)


def process_files(
    spark: SparkSession,
    folder: str,
    root: str,
    read: Callable[[list[str]], DataFrame],
    transform: Callable[[DataFrame], DataFrame],
    pattern: str = "*",
    recursive: bool = False,
) -> DataFrame:
    """Transform the files of a folder that are not done; returns a row for each: ``path``, ``n_rows``, ``reason``.

    ``read`` gets paths and tags rows with ``source_path`` as ``sources.listing.file_path``
    gives it; ``transform`` keeps it. ``reason`` is ``new``, ``changed`` (the file is not what
    it was) or ``mismatch`` (its output is not what was logged). All files of a run share
    one job and are entered together when it has ended, so a run that dies enters nothing
    and what it wrote is never read. Files that are gone keep their rows. The paths pass
    the driver, as in any Spark read of a list of files.
    """
    listing = list_files(spark, folder, pattern, recursive).withColumn("modified", F.col("modified").cast("string"))
    known = progress(spark, root).select("path", F.col("length").alias("_length"), F.col("modified").alias("_modified"), "n_rows", "found")
    joined = listing.join(known, "path", "left")
    changed = (F.col("length") != F.col("_length")) | (F.col("modified") != F.col("_modified"))
    reason = F.when(F.col("n_rows").isNull(), F.lit("new")).when(changed, F.lit("changed")).when(F.col("n_rows") != F.col("found"), F.lit("mismatch"))
    todo = joined.withColumn("reason", reason).where("reason is not null").select("path", "length", "modified", "reason")
    files = todo.orderBy("path").collect()
    out_schema = "path string, n_rows long, reason string"
    if not files:
        return spark.createDataFrame([], out_schema)
    log = _log(spark, root)
    run = 1 + max((int(n) for n in log.names()), default=0)
    named = lambda path: F.concat(F.lit("x"), F.md5(F.col(path).cast("binary")))  # noqa: E731  never read as a number
    written = transform(read([f.path for f in files])).withColumn("file", named("source_path"))
    out = f"{root.rstrip('/')}/files/run={run:06d}"
    written.write.mode("overwrite").partitionBy("file").parquet(out)
    counts = rows_by_folder(spark, f"{out}/file=*")
    counts = counts.select(F.regexp_replace(F.element_at(F.split("folder", "/"), -1), "^file=", "").alias("file"), F.col("found").alias("n_rows"))
    done = spark.createDataFrame(files, todo.schema).withColumn("file", named("path"))
    done = done.join(counts, "file", "left").select("path", "length", "modified", "file", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "reason")
    entries = [r.asDict() for r in done.orderBy("path").collect()]
    log.enter_all(f"{run:06d}", [{"run": run} | {k: e[k] for k in ("path", "length", "modified", "file", "n_rows")} for e in entries])
    return spark.createDataFrame([(e["path"], e["n_rows"], e["reason"]) for e in entries], out_schema)
