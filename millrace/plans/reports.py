"""Run log report and dataset profile."""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.text import as_column
from millrace.operators import reports
from millrace.operators.ordinals import first_n_per_group
from millrace.session import stage
from millrace.sources.jsonl import LINE_PLACE, read_lines, read_strict

# Fixed value: the shape of a run log entry.
LOG_SCHEMA = (
    "timestamp string, job_index int, file string, item_id string, status string, score double, fail_reason string"
)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return read_strict(spark, path, LOG_SCHEMA)


def log_report(log: DataFrame) -> dict[str, DataFrame]:
    """The parts of a run report, by name."""
    return {
        "range": reports.time_range(log),
        "statuses": reports.status_distribution(log),
        "scores": reports.score_statistics(log),
        "files": reports.top_files(log),
        "totals": reports.run_totals(log, time="timestamp"),
        "batches": reports.batch_summary(log, ["timestamp", "item_id"]),
    }


def field_profile(lines: DataFrame, file: str = "file_name", line: str = "line") -> DataFrame:
    """Fields of JSON lines per file: how many rows have each, by value type.

    Long form, one row per file, field and type, so nothing is collected.
    """
    value = F.try_parse_json(as_column(line))
    fields = lines.select(file, F.explode(F.json_object_keys(line)).alias("field"), value.alias("_v"))
    typed = F.schema_of_variant(F.try_variant_get("_v", F.concat(F.lit("$['"), F.col("field"), F.lit("']")), "variant"))
    kind = F.lower(F.regexp_extract(typed, "^[A-Z]+", 0))
    return fields.groupBy(file, "field", kind.alias("type")).agg(F.count(F.lit(1)).alias("n_rows"))


#: Counted paths that a task holds before it hands them on, and keys beyond which an object counts as a map.
HELD_PATHS, MAP_KEYS = 100_000, 64


def _kind(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "boolean"
    return {int: "bigint", float: "double", str: "string", list: "array", dict: "object"}[type(value)]


def _count_paths(counts: Counter, file: str, path: tuple[str, ...], value) -> None:
    """Count the value and all that it holds; elements of a list share one path."""
    waiting = [(path, value)]
    while waiting:
        path, value = waiting.pop()
        counts[file, path, _kind(value)] += 1
        if isinstance(value, dict):
            waiting += [((*path, key), x) for key, x in value.items()]
        elif isinstance(value, list):
            waiting += [((*path, "[]"), x) for x in value]


def nested_profile(lines: DataFrame, file: str = "file_name", line: str = "line", map_keys: int = MAP_KEYS) -> DataFrame:
    """What JSON lines hold at every depth, per file: ``path``, ``type``, ``n_values``.

    Paths go through objects by key and through lists by ``[]``. A path of several types has
    a row for each: nulls, numbers and texts that share a field all show. An object with
    more than ``map_keys`` different keys in a file is a map: its keys become ``*``, and its
    own type ``map``. Lines that are no JSON object are left out. Counts are added up in
    the tasks; a task holds a bounded number of paths.
    """
    kind = pa.schema([("file", pa.string()), ("path", pa.list_(pa.string())), ("type", pa.string()), ("n", pa.int64())])

    def batch_of(counts: Counter) -> pa.RecordBatch:
        rows = [(f, list(p), t, n) for (f, p, t), n in counts.items()]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(columns, kind, strict=True)], schema=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    row = json.loads(text)
                except (TypeError, ValueError, RecursionError):
                    continue
                if isinstance(row, dict):
                    for key, value in row.items():
                        _count_paths(counts, name, (key,), value)
                if len(counts) > HELD_PATHS:
                    yield batch_of(counts)
                    counts.clear()
        yield batch_of(counts)

    partial = lines.select(F.col(file).alias("file"), F.col(line).alias("line")).mapInArrow(run, "file string, path array<string>, type string, n long")
    counted = stage(partial.groupBy("file", "path", "type").agg(F.sum("n").alias("n")), "profile")
    depth = counted.agg(F.max(F.size("path")).alias("d")).first().d or 0
    # Maps from the outside in: what a map's keys hold is one path before the next depth is judged.
    for level in range(2, depth + 1):
        keys = F.when((F.size("path") >= level) & (F.element_at("path", level) != "[]"), F.element_at("path", level))
        parent = F.slice("path", 1, level - 1)
        wide = counted.where(keys.isNotNull()).groupBy("file", parent.alias("parent")).agg(F.count_distinct(keys).alias("n_keys"))
        wide = wide.where(F.col("n_keys") > map_keys).select(F.col("file").alias("_file"), "parent")
        if wide.isEmpty():
            continue
        joined = counted.join(wide, (F.col("file") == F.col("_file")) & (parent == F.col("parent")), "left")
        is_map = F.col("_file").isNotNull()
        below = F.concat(parent, F.array(F.lit("*")), F.slice("path", level + 1, depth))
        path = F.when(is_map & keys.isNotNull(), below).otherwise(F.col("path"))
        own = F.when(is_map & (F.size("path") == level - 1) & (F.col("type") == "object"), "map").otherwise(F.col("type"))
        counted = stage(joined.select("file", path.alias("path"), own.alias("type"), "n").groupBy("file", "path", "type").agg(F.sum("n").alias("n")), "profile")
    return counted.select(F.col("file").alias(file), F.replace(F.array_join("path", "."), F.lit(".[]"), F.lit("[]")).alias("path"), "type", F.col("n").alias("n_values"))


def profile(spark: SparkSession, path: str, preview: int = 3) -> dict[str, DataFrame]:
    """Row counts, fields and first rows of each JSON-lines file."""
    lines = read_lines(spark, path, places=True)
    return {
        "rows": lines.groupBy("file_name").agg(F.count(F.lit(1)).alias("n_rows")),
        "fields": field_profile(lines),
        "nested": nested_profile(lines),
        "preview": first_n_per_group(lines, ["file_path"], LINE_PLACE, preview),
    }
