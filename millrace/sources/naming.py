"""Output names and run folders."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.sources.tables import file_system

# Stamp of a run folder.
STAMP_PATTERN = r"^\d{8}_\d{6}"
STAMP_FORMAT = "%Y%m%d_%H%M%S"


def chat_file_name(dataset: Column, config: Column, split: Column, with_system: bool = False) -> Column:
    """``<leaf>/<key>[-config]-<split>[-with_system].jsonl`` with slashes in the key as underscores."""
    bare = F.regexp_replace(dataset, r"\.jsonl$", "")
    leaf = F.element_at(F.split(bare, "/"), -1)
    key = F.replace(bare, F.lit("/"), F.lit("_"))
    named = F.when(config != "", F.concat(F.lit("-"), config))
    tail = F.lit("-with_system.jsonl" if with_system else ".jsonl")
    return F.concat(leaf, F.lit("/"), key, F.coalesce(named, F.lit("")), F.lit("-"), split, tail)


def resolve_path(template: str, **values: str | int) -> str:
    """Fill ``{name}`` in a path; unknown names stay as they are."""
    for name, value in values.items():
        template = template.replace("{" + name + "}", str(value))
    return template


def run_stamp(now: datetime | None = None) -> str:
    return (now or datetime.now()).strftime(STAMP_FORMAT)


def run_path(template: Column, task: Column, stamp: Column, run_index: Column) -> Column:
    """``resolve_path`` over a table of runs."""
    filled = F.replace(template, F.lit("{task_name}"), task)
    filled = F.replace(filled, F.lit("{timestamp}"), stamp)
    return F.replace(filled, F.lit("{run_index}"), run_index.cast("string"))


def list_runs(spark: SparkSession, base: str) -> DataFrame:
    """Folders directly below ``base`` with their name as stamp and whether they hold Parquet files."""
    runs = []
    folder, fs = file_system(spark, base)
    for status in fs.listStatus(folder) if fs.exists(folder) else []:
        if status.isDirectory():
            path = status.getPath()
            held = fs.globStatus(file_system(spark, f"{path.toString()}/*.parquet")[0])
            runs.append((path.getName(), path.toString(), len(held) > 0))
    return spark.createDataFrame(runs, "stamp string, path string, has_data boolean")


def run_folder(spark: SparkSession, template: str, task: str, resume: bool = True, now: datetime | None = None) -> str:
    """Where a run writes: the newest earlier run to go on with, or a folder with a new stamp.

    Only a template with ``{timestamp}`` as its last part has earlier runs.
    """
    if resume and template.endswith("/{timestamp}"):
        base = resolve_path(template.removesuffix("/{timestamp}"), task_name=task)
        if found := latest_run(list_runs(spark, base)).first():
            return found.path
    return resolve_path(template, task_name=task, timestamp=run_stamp(now))


def latest_run(runs: DataFrame, stamp: str = "stamp", path: str = "path", has_data: str = "has_data") -> DataFrame:
    """The newest run folder, if it holds data; otherwise no row.

    Only the newest is looked at: an older run with data does not stand in.
    """
    stamped = runs.filter(F.col(stamp).rlike(STAMP_PATTERN))
    newest = stamped.agg(
        F.max(stamp).alias(stamp),
        F.max_by(path, F.struct(stamp, path)).alias(path),
        F.max_by(has_data, F.struct(stamp, path)).alias(has_data),
    )
    return newest.filter(F.col(has_data)).select(stamp, path)
