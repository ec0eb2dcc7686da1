"""Input discovery: file listings as DataFrames, reads that keep the file's name."""

from __future__ import annotations

import re
import warnings
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.functions.text import unix_newlines
from millrace.operators.resume import pending
from millrace.session import new_stage_path, stage
from millrace.sources.json_array import read_array_rows
from millrace.sources.jsonl import LINE_PLACE, is_json_object, read_lines, read_strict, read_tolerant

# File names of triplets and the layout of package folders.
TRIPLET_GLOB = "pt_data_*.jsonl"
_TRIPLET_LANGUAGE = r"^pt_data_(.+?)(?:_part(?:(?!_part).)*)?\.jsonl$"
PACKAGE_GLOB = "*.{xml,cxml}"


def list_files(spark: SparkSession, folder: str, pattern: str = "*", recursive: bool = False) -> DataFrame:
    """``path``, ``file_name``, ``length`` and ``modified`` of matching files.

    The binary source leaves the contents alone unless they are selected.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    if recursive:
        files = files.option("recursiveFileLookup", "true")
    return files.load(folder).select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        "length",
        F.col("modificationTime").alias("modified"),
    )


def file_path() -> Column:
    """The path of a row's file, written as ``list_files`` writes it."""
    decoded = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def stem(file_name: Column) -> Column:
    """File name without its extension."""
    return F.regexp_replace(file_name, r"(?<=[^.])\.[^.]*$", "")


def output_names(listing: DataFrame) -> DataFrame:
    """Adds ``output_name``: the whole input name, so that equal stems stay apart."""
    return listing.withColumn("output_name", F.concat("file_name", F.lit(".parquet")))


def read_folder(
    spark: SparkSession, folder: str, schema: T.StructType, tolerant: bool = False, lines: str = "*.jsonl"
) -> DataFrame:
    """All Parquet and JSON-lines files directly in a folder, tagged ``source_file``."""
    name = F.col("_metadata.file_name").alias("source_file")
    columns = [F.col(f.name) for f in schema]
    parts = []
    parquet = spark.read.option("pathGlobFilter", "*.parquet").schema(schema)
    parts.append(parquet.parquet(folder).select(*columns, name))
    if tolerant:
        rows = read_tolerant(spark, f"{folder}/{lines}", schema, keep_file=True)
        parts.append(rows.select(*columns, F.col("file_name").alias("source_file")))
    else:
        strict = spark.read.option("pathGlobFilter", lines).option("mode", "FAILFAST").schema(schema)
        parts.append(strict.json(folder).select(*columns, name))
    return reduce(lambda a, b: a.unionByName(b), parts)


def read_pattern(spark: SparkSession, folder: str, pattern: str = "*.parquet", schema: T.StructType | None = None) -> DataFrame:
    """Files of a folder that match a pattern, tagged ``source_file``."""
    reader = spark.read.option("pathGlobFilter", pattern)
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.json(folder) if pattern.endswith((".jsonl", ".json")) else reader.parquet(folder)
    return rows.select("*", F.col("_metadata.file_name").alias("source_file"))


def package_language(path: Column) -> Column:
    """The folder a package lies in names its language."""
    return F.element_at(F.split(path, "/"), -2)


def read_packages(
    spark: SparkSession, root: str, languages: list[str] | None = None, pattern: str = PACKAGE_GLOB
) -> DataFrame:
    """Packaged repositories below ``<root>/<language>/``, one row per file.

    Columns: ``path``, ``file_name``, ``language``, ``content`` (line ends as
    ``\\n``). Only the named languages' folders are read.
    """
    folders = [f"{root}/{name}" for name in languages] if languages else [f"{root}/*"]
    texts = spark.read.option("pathGlobFilter", pattern).text(folders, wholetext=True)
    path = F.col("_metadata.file_path")
    return texts.select(
        path.alias("path"),
        F.col("_metadata.file_name").alias("file_name"),
        package_language(path).alias("language"),
        unix_newlines("value").alias("content"),
    )


def triplet_language(file_name: Column) -> Column:
    """Language in a triplet file's name, up to the last part marker."""
    return F.regexp_extract(file_name, _TRIPLET_LANGUAGE, 1)


def read_triplets(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Triplet files of a folder, bad lines skipped, tagged ``file_language``."""
    rows = read_tolerant(spark, f"{folder}/{TRIPLET_GLOB}", schema, keep_file=True)
    return rows.withColumn("file_language", triplet_language(F.col("file_name"))).drop("file_path")


def read_shards(spark: SparkSession, base: str, schema: T.StructType, pattern: str = "*/*split*/*.jsonl") -> DataFrame:
    """Result files of a multi-model run below ``<base>/<model>/``, tagged ``model`` and ``file_name``.

    A file with a line that is not JSON is left out whole. Lines are read and parsed once:
    each is written with its verdict, and the files of bad ones, which may be split over
    tasks, are taken out of what was written.
    """
    root = base.split(":", 1)[-1].rstrip("/") + "/"
    model = F.substring_index(F.substring_index("file_path", root, -1), "/", 1)
    parsed = F.from_json("line", schema, {"allowSingleQuotes": "false"})
    lines = read_lines(spark, f"{base}/{pattern}")
    judged = stage(lines.select(model.alias("model"), "file_name", "file_path", parsed.alias("_row"), is_json_object("line").alias("_good")), "shards")
    whole = pending(judged, judged.filter(~F.col("_good")).select("file_path"), "file_path")
    return whole.select("model", "file_name", "_row.*")


def read_dataset(
    spark: SparkSession, folder: str, dataset: str, config: str | None, split: str, schema: T.StructType | None = None
) -> DataFrame:
    """One (dataset, config, split), tagged with the three names.

    Tried in turn: ``<folder>/<dataset>`` as a bare JSON-lines file,
    ``<folder>/<dataset>[/<config>]/**/<split>[-<shard>]`` as Parquet, JSON lines and JSON, and
    the same below ``<folder>`` itself when it is the dataset's own folder. A file that is only
    numbered belongs to the split its folder names.
    """
    if dataset.endswith(".jsonl"):
        rows = read_strict(spark, f"{folder}/{dataset}", schema)
    else:
        rows = _read_split(spark, _dataset_folders(folder, dataset, config), split, schema)
    return rows.select(
        "*", F.lit(dataset).alias("dataset"), F.lit(config).cast("string").alias("config"), F.lit(split).alias("split")
    )


def _own_folders(folder: str, dataset: str) -> list[str]:
    bases = [f"{folder}/{dataset}"]
    if folder.rstrip("/").rsplit("/", 1)[-1] == dataset.rsplit("/", 1)[-1]:
        bases.append(folder.rstrip("/"))
    return bases


def _dataset_folders(folder: str, dataset: str, config: str | None) -> list[str]:
    bases = _own_folders(folder, dataset)
    return [f"{b}{below}/{config}" for b in bases for below in ("", "/data")] if config else bases


# A split's file or folder is its name, or its name and a shard number.
_SHARD = r"(?:-\d+(?:-of-\d+)?)?"
_EXTENSIONS = ("parquet", "jsonl", "json")
#: Files of a nested folder that name no split of their own.
_NUMBERED = r"\d+|part-\d+.*"


def _exists(spark: SparkSession, base: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def _split_names(spark: SparkSession, base: str, below: str = "") -> list[tuple[str, str, str]]:
    """(split, extension, name) of the files and table folders at any depth of ``base``; none if it doesn't exist."""
    if not _exists(spark, base):
        return []
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{below}" if below else base)
    found = []
    for status in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path):
        name = status.getPath().getName()
        if name.startswith((".", "_")):
            continue
        if match := re.fullmatch(rf"(.+?){_SHARD}\.({'|'.join(_EXTENSIONS)})", name):
            split = match[1]
            if below and re.fullmatch(_NUMBERED, split):
                own = below.rstrip("/").rsplit("/", 1)[-1]
                split = "train" if own == "data" else own
            found.append((split, match[2], below + name))
        elif status.isDirectory():
            found += _split_names(spark, base, f"{below}{name}/")
    return sorted(found)


def whole_json_files(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of the JSON files that are one value, such as a list of rows, and not a row a line; one job for all.

    The first line that isn't blank tells.
    """
    if not paths:
        return []
    lines = read_lines(spark, paths, places=True)
    first = lines.groupBy("file_path").agg(F.min_by("line", F.struct(*LINE_PLACE)).alias("line"))
    found = {unquote(r.file_path.split(":", 1)[-1].lstrip("/")) for r in first.where(~is_json_object("line")).select("file_path").collect()}
    own = {p: p.split(":", 1)[-1].strip("/") for p in paths}
    # A path may also be the folder of a table.
    return [p for p in paths if own[p] in found or any(f.startswith(own[p] + "/") for f in found)]


def dataset_splits(spark: SparkSession, folder: str, dataset: str, config: str | None) -> list[str]:
    """The splits that a dataset's files name; a bare JSON-lines file is one, ``train``.

    None, with a warning, where the dataset's folder doesn't exist; a folder without files of a split is an error.
    """
    if dataset.endswith(".jsonl"):
        return ["train"]
    for base in _dataset_folders(folder, dataset, config):
        if names := _split_names(spark, base):
            return sorted({split for split, _, _ in names})
    if present := [b for b in _own_folders(folder, dataset) if _exists(spark, b)]:
        raise FileNotFoundError(f"no file of {dataset} ({config}) names a split in {present}")
    warnings.warn(f"no files of {dataset} ({config}) below {folder}: skipped", stacklevel=2)
    return []


def _read_split(spark: SparkSession, bases: list[str], split: str, schema: T.StructType | None) -> DataFrame:
    """All files of exactly this split, Parquet, JSON lines and JSON together, from the first folder that has some."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    for base in bases:
        names = [(kind, f"{base}/{name}") for own, kind, name in _split_names(spark, base) if own == split]
        paths = {kind: [path for k, path in names if k == kind] for kind in _EXTENSIONS}
        whole = whole_json_files(spark, paths["json"])
        parts = [reader.parquet(*paths["parquet"])] if paths["parquet"] else []
        if lines := [*paths["jsonl"], *(p for p in paths["json"] if p not in whole)]:
            parts.append(reader.json(lines))
        if whole:
            # One row a line from here on: any reader of JSON lines takes it, with or without a schema.
            rows = new_stage_path(spark, "json-lines")
            read_array_rows(spark, whole).select("text").write.text(rows)
            parts.append(reader.json(rows))
        if parts:
            return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    raise FileNotFoundError(f"no files for split {split!r} in {bases}")
