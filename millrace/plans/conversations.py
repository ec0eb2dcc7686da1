"""Instruction datasets to chat records; merging of record collections."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.functions.chatml import DEFAULT_SYSTEM_PROMPT, FORMAT_NAME, LAYOUTS, add_system
from millrace.operators.filters import with_messages
from millrace.operators.unions import merge_groups
from millrace.sources.jsonl import read_tolerant
from millrace.sources.listing import dataset_splits, read_dataset
from millrace.sources.naming import chat_file_name


def to_chat(
    df: DataFrame,
    style: str,
    mapping: dict[str, str],
    keep_raw: bool = True,
    system_prompt: str | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Chat records of one dataset; rows that give no message are dropped.

    ``raw_data`` is the source row as JSON text (binary values in base64).
    ``keep`` names columns carried along.
    """
    turns = LAYOUTS[style](df, mapping)
    columns = [*(keep or []), turns.alias("messages"), F.lit(FORMAT_NAME).alias("format")]
    if keep_raw:
        sample = [c for c in df.columns if c not in (keep or [])] or df.columns
        columns.append(F.to_json(F.struct(*sample), {"ignoreNullFields": "false"}).alias("raw_data"))
    records = with_messages(df.select(*columns))
    if system_prompt is None:
        return records
    return records.withColumn("messages", add_system(F.col("messages"), system_prompt))


def convert_datasets(
    spark: SparkSession,
    folder: str,
    datasets: dict[str, dict[str, Any]],
    selected: list[str] | None = None,
    splits: dict[str, list[str]] | None = None,
    schemas: dict[str, T.StructType] | None = None,
    keep_raw: bool = True,
    add_system_prompt: bool = False,
    system_prompt: str = DEFAULT_SYSTEM_PROMPT,
    done: set[str] | None = None,
) -> DataFrame:
    """All configured (dataset, config, split) parts as one table of chat records.

    Without ``splits`` all splits that a dataset's files name are read; a dataset
    without files is skipped with a warning. ``done`` holds names of finished outputs. ``output_file`` names each row's
    output; write the result partitioned by dataset, config and split.
    """
    parts = []
    tags = ["dataset", "config", "split"]
    for dataset, details in datasets.items():
        if selected and dataset not in selected:
            continue
        for config in details.get("configs") or [None]:
            named = (splits or {}).get(dataset) or dataset_splits(spark, folder, dataset, config)
            for split in named:
                rows = read_dataset(spark, folder, dataset, config, split, (schemas or {}).get(dataset))
                prompt = system_prompt if add_system_prompt else None
                chat = to_chat(rows, details["format_style"], details["column_mapping"], keep_raw, prompt, keep=tags)
                parts.append(chat)
    if not parts:
        raise ValueError("no dataset to convert")
    records = reduce(lambda a, b: a.unionByName(b), parts)
    name = chat_file_name(F.col("dataset"), F.col("config"), F.col("split"), add_system_prompt)
    records = records.withColumn("output_file", name)
    return records.filter(~F.col("output_file").isin(sorted(done))) if done else records


def merge_collections(
    spark: SparkSession,
    folder: str,
    groups: list[dict],
    schema: T.StructType,
    selected: list[str] | None = None,
) -> DataFrame:
    """Merge groups of JSON-lines files; invalid lines are skipped.

    Inputs are files below ``folder``, subfolders included, or folders that Spark wrote. Every input must exist,
    otherwise nothing is merged: a missing path fails the read. Rows carry ``group``, ``output_file``, ``src_ord`` and
    their place in their file; ``in_merged_order`` sorts by these.
    """
    wanted = [g for g in groups if not selected or g["name"] in selected]
    paths = sorted({f"{folder}/{name}" for g in wanted for name in g["input_files"]})
    if not paths:
        raise ValueError("no merge group to run")
    rows = read_tolerant(spark, paths, schema, places=True)
    root = folder.split(":", 1)[-1].rstrip("/") + "/"
    relative = F.url_decode(F.substring_index(F.replace("file_path", F.lit("+"), F.lit("%2B")), root, -1))
    folder_of = F.regexp_replace(relative, "/[^/]*$", "")
    named = sorted({name for g in wanted for name in g["input_files"]})
    return merge_groups(rows, wanted, name=F.when(relative.isin(named), relative).otherwise(folder_of))
