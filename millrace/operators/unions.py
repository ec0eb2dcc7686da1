"""Ordered unions of collections and of shard results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.filters import shard_file_kind
from millrace.operators.resume import Key, keep_latest
from millrace.sources.jsonl import line_order


def union_in_order(inputs: list[DataFrame], source_column: str = "src_ord") -> DataFrame:
    """All rows of all inputs, tagged with their input's position.

    Columns are matched by name; one that an input lacks is null there. The order
    is data (``source_column`` plus whatever orders an input's own rows), so the
    union itself moves nothing.
    """
    if not inputs:
        raise ValueError("nothing to merge")
    tagged = [df.withColumn(source_column, F.lit(i)) for i, df in enumerate(inputs)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def merge_groups(
    files: DataFrame, groups: list[dict], selected: list[str] | None = None, name: Column | None = None
) -> DataFrame:
    """Rows of each group's input files, tagged with group and file position.

    ``files`` carries ``file_name``, or ``name`` says what the groups call a row's file; ``groups`` are ``{"name", "output_file",
    "input_files"}``. A file may serve several groups. The groups are a literal
    map in the plan: a lookup and an explode, no join.
    """
    wanted = [g for g in groups if not selected or g["name"] in selected]
    entries: dict[str, list[Column]] = {}
    for group in wanted:
        for position, input_file in enumerate(group["input_files"]):
            entry = F.struct(
                F.lit(group["name"]).alias("group"),
                F.lit(group["output_file"]).alias("output_file"),
                F.lit(position).alias("src_ord"),
            )
            entries.setdefault(input_file, []).append(entry)
    if not entries:
        raise ValueError("no merge group to run")
    lookup = F.create_map(*[c for key, found in entries.items() for c in (F.lit(key), F.array(*found))])
    matched = files.withColumn("_groups", F.element_at(lookup, F.col("file_name") if name is None else name))
    return matched.withColumn("_group", F.explode("_groups")).select("*", "_group.*").drop("_groups", "_group")


def merge_chunks(lines: DataFrame) -> DataFrame:
    """Lines of chunk files, read with their places, in one order: chunks by name, lines as they stand."""
    return lines.orderBy(*line_order())


def in_merged_order(rows: DataFrame) -> DataFrame:
    """Rows of merge groups in the order of the merged files: inputs as the group lists them, their lines as they stand."""
    return rows.orderBy("group", "src_ord", *line_order())


def merge_shards(rows: DataFrame, merge_errors: bool = True) -> DataFrame:
    """Shard results with ``status`` from their file's name; retry files drop out.

    ``rows`` carries ``file_name``. Write the result partitioned by model and
    status to get both outputs from one read.
    """
    kind = shard_file_kind(F.col("file_name"))
    kept = rows.withColumn("_kind", kind).filter(F.col("_kind") != "ignored")
    if not merge_errors:
        kept = kept.filter(F.col("_kind") == "output")
    status = F.when(F.col("_kind") == "error", F.lit("error")).otherwise(F.lit("success"))
    return kept.withColumn("status", status).drop("_kind")


def latest_status(rows: DataFrame, key: Key, order: list[Column | str]) -> DataFrame:
    """The last outcome per key, so a row that failed and then succeeded counts once."""
    return keep_latest(rows, key, order)
