"""Parquet, format choice, and publishing of written tables."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from millrace.sources.jsonl import read_strict, write_jsonl

FORMATS = {".jsonl": "jsonl", ".parquet": "parquet"}


def format_of(path: str) -> str:
    """Format by extension; any other extension is an error."""
    for extension, name in FORMATS.items():
        if path.rstrip("/").endswith(extension):
            return name
    raise ValueError(f"unsupported file format: {path}")


def load(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    if format_of(path) == "jsonl":
        return read_strict(spark, path, schema)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace the table at ``path``. Do not call it on a path ``df`` reads from."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def save(df: DataFrame, path: str) -> None:
    if format_of(path) == "jsonl":
        write_jsonl(df, path)
    else:
        write_parquet(df, path)


def file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def bytes_below(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder."""
    target, fs = file_system(spark, path)
    return fs.getContentSummary(target).getLength()


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = file_system(spark, path)
    return fs.exists(target)


def publish(spark: SparkSession, staged: str, target: str) -> str | None:
    """Move a finished table into place; an earlier one is moved aside, not deleted.

    Returns where the earlier one went.
    """
    source, fs = file_system(spark, staged)
    place, _ = file_system(spark, target)
    aside = None
    if fs.exists(place):
        stamp = datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
        aside = f"{target.rstrip('/')}.before-{stamp}-{uuid.uuid4().hex[:8]}"
        if not fs.rename(place, file_system(spark, aside)[0]):
            raise OSError(f"could not move {target} aside")
    if not fs.rename(source, place):
        raise OSError(f"could not move {staged} to {target}")
    return aside


def append_checked(prior: DataFrame, new: DataFrame, staged: str) -> DataFrame:
    """Write prior and new rows together and make sure none was lost or doubled.

    The result sits at ``staged``; ``publish`` it from there. On a mismatch
    nothing has been replaced, so there is nothing to roll back. The inputs are
    counted as they are written, the result by its Parquet footers.
    """
    spark = prior.sparkSession
    before, added = Observation(), Observation()
    counted = prior.observe(before, F.count(F.lit(1)).alias("n")).unionByName(
        new.observe(added, F.count(F.lit(1)).alias("n")), allowMissingColumns=True
    )
    counted.write.mode("errorifexists").parquet(staged)
    written = spark.read.parquet(staged)
    expected, found = before.get.get("n", 0) + added.get.get("n", 0), written.count()
    if expected != found:
        raise ValueError(f"expected {expected} rows, wrote {found}")
    return written
