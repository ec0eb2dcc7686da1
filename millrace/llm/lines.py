"""Removal of lines that many sites share.

Each line's key is a hash of the trimmed line. A HyperLogLog sketch of the sites
of each key merges in the aggregation, map side first, so a line's spread costs a
few hundred bytes at most however many rows hold it. Keys whose estimate lies
near the threshold get an exact distinct count. A line over the threshold stays
in the first document that holds it (smallest doc_id) and goes from all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A line of more than this many distinct sites counts as boilerplate.
SITES = 5
#: Sketch size (2 ** bits registers) and the relative band round the threshold that is counted exactly.
SKETCH_BITS, BAND = 10, 0.15


def _lines() -> Column:
    return F.split("text", "\n")


def line_keys(documents: DataFrame, unknown_sites: bool = False) -> DataFrame:
    """``doc_id``, ``site``, ``key`` of each line with more than white space; rows without doc_id are left out, and those without site unless ``unknown_sites``."""
    known = F.col("doc_id").isNotNull() & (F.lit(unknown_sites) | F.col("source").isNotNull())
    lines = documents.where(known).select("doc_id", F.col("source").alias("site"), F.explode(_lines()).alias("line"))
    return lines.withColumn("line", _trimmed(F.col("line"))).where("line <> ''").select("doc_id", "site", F.md5("line").alias("key"))


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r\x0b\x0c\xa0"))


def shared_lines(keys: DataFrame, sites: int = SITES) -> DataFrame:
    """``key`` of the lines of more than ``sites`` sites, with the smallest doc_id that holds each."""
    spread = keys.groupBy("key").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(SKETCH_BITS))).alias("estimate"), F.min("doc_id").alias("first_id")
    )
    spread = spread.where(F.col("estimate") > sites * (1 - BAND) - 1)
    near = spread.where(F.col("estimate") <= sites * (1 + BAND) + 1).select("key", "first_id")
    exact = keys.join(near, "key").select("key", "site", "first_id").distinct().groupBy("key").agg(F.count("*").alias("n"), F.first("first_id").alias("first_id"))
    far = spread.where(F.col("estimate") > sites * (1 + BAND) + 1).select("key", "first_id")
    return far.unionByName(exact.where(F.col("n") > sites).select("key", "first_id"))


def remove_shared_lines(documents: DataFrame, sites: int = SITES, unknown_sites: bool = False) -> DataFrame:
    """``documents`` with ``text`` cleaned, and ``lines_removed``, the number of lines taken out.

    Lines are what line feeds separate; a line is compared without white space at its
    ends and blank lines are never removed. A null text stays null, a document may end
    up empty, rows without doc_id or source are left as they are, repeated rows are
    cleaned alike. ``sites`` is a number of distinct values of ``source``. With
    ``unknown_sites`` rows without source are cleaned too; they never add to a line's sites.
    """
    shared = shared_lines(line_keys(documents), sites)
    held = line_keys(documents, unknown_sites).join(shared, "key").where(F.col("doc_id") > F.col("first_id")).select("doc_id", "key")
    # One entry per different line of a document: bounded by the document itself.
    gone = held.groupBy("doc_id").agg(F.collect_set("key").alias("__gone"))
    joined = documents.join(gone, "doc_id", "left")
    kept = F.filter(_lines(), lambda line: F.isnull("__gone") | ~F.array_contains("__gone", F.md5(_trimmed(line))))
    left_alone = F.isnull("__gone") | (F.isnull("source") & F.lit(not unknown_sites))
    cleaned = F.when(left_alone, F.col("text")).otherwise(F.array_join(kept, "\n"))
    removed = F.when(left_alone, 0).otherwise(F.size(_lines()) - F.size(kept))
    columns = [cleaned.alias("text") if c == "text" else F.col(c) for c in documents.columns if c != "lines_removed"]
    return joined.select(*columns, removed.alias("lines_removed"))
