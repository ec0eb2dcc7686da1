"""A folder's commit log: which written parts count.

A part is written first and then entered here, in a small file of its own that appears
whole or not at all. Readers take only entered parts, so what a killed run left behind is
never read, and a rerun knows what is done. Works on any file system Spark can rename on.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.sources.tables import file_system

LOG = "_commits"


class CommitLog:
    """Entries (flat dictionaries) of the folder ``root``, each in a file ``<name>.json`` below ``_commits``."""

    def __init__(self, spark: SparkSession, root: str, schema: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.folder, self.schema = f"{self.root}/{LOG}", T.StructType.fromDDL(schema)

    def enter(self, name: str, entry: dict) -> None:
        """Commit one part; a second entry of the same name is an error."""
        self.enter_all(name, [entry])

    def enter_all(self, name: str, entries: list[dict]) -> None:
        """Commit several parts at once, as lines of one file."""
        data = "".join(json.dumps(e, ensure_ascii=False) + "\n" for e in entries).encode()
        waiting, fs = file_system(self.spark, f"{self.folder}/_{name}-{uuid.uuid4().hex}.tmp")
        place, _ = file_system(self.spark, f"{self.folder}/{name}.json")
        out = fs.create(waiting)
        try:
            out.write(bytearray(data))
        finally:
            out.close()
        if fs.exists(place) or not fs.rename(waiting, place):
            raise FileExistsError(f"{name} is entered in {self.folder} already")

    def names(self) -> list[str]:
        """Names of the entered files, in order."""
        folder, fs = file_system(self.spark, self.folder)
        if not fs.exists(folder):
            return []
        found = [status.getPath().getName() for status in fs.listStatus(folder)]
        return sorted(n.removesuffix(".json") for n in found if n.endswith(".json") and not n.startswith(("_", ".")))

    def entries(self) -> DataFrame:
        """All entries as rows; no rows if there is no log yet."""
        if not self.names():
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("mode", "FAILFAST").json(f"{self.folder}/*.json")


def read_parts(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """The rows of committed parts; no rows without parts."""
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def rows_by_folder(spark: SparkSession, pattern: str) -> DataFrame:
    """``folder`` and ``found``: rows of each folder of Parquet files, counted by footers; ``pattern`` globs the folders."""
    folder, fs = file_system(spark, pattern)
    statuses = fs.globStatus(folder)
    if not statuses:
        return spark.createDataFrame([], "folder string, found long")
    place = F.regexp_replace(F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", ""), "^file:/+", "file:/")
    counted = spark.read.format("parquet").schema("`_nothing` int").option("pathGlobFilter", "*.parquet").load(pattern)
    return counted.groupBy(place.alias("folder")).agg(F.count(F.lit(1)).alias("found"))
