"""Preprocessing: raw rows of several kinds to one row shape."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions import packages as pk
from millrace.functions.identity import ensure_id
from millrace.functions.text import average_line_length, length_score, line_count
from millrace.functions.tokens import PatternTokenizer, truncate_text, truncated_name
from millrace.operators import fields, filters
from millrace.operators.ordinals import limit_files
from millrace.operators.reports import file_stats
from millrace.operators.resume import pending_files
from millrace.session import stage
from millrace.sources.listing import list_files
from millrace.sources.tables import exists

MAX_TOKENS = 32768
DEFAULT_TOKENIZER = PatternTokenizer()


def score_length(df: DataFrame, text: str = "text") -> DataFrame:
    """Every row with its length score."""
    return df.withColumn("score", length_score(text))


def universal(
    df: DataFrame, config: dict[str, Any], tokenizer=DEFAULT_TOKENIZER, max_tokens: int = MAX_TOKENS
) -> DataFrame:
    """Mapping, filters, cleaning, computed and required fields, truncation, in this order.

    Filters see the text as mapped: before cleaning, and before rows without text
    take it from another column.
    """
    mapped = fields.map_fields(df, config.get("field_mapping", {}))
    kept = filters.apply_filters(mapped, config.get("filters", {}))
    steps = config.get("transformations", {})
    if cleaning := steps.get("text_cleaning", {}):
        kept = fields.clean_text(
            kept, cleaning.get("remove_extra_whitespace", False), cleaning.get("remove_characters", [])
        )
    computed = fields.add_computed(kept, steps.get("computed_fields", {}), tokenizer)
    complete = fields.ensure_required(computed, config.get("source_name", "unknown"))
    return fields.add_truncated(complete, tokenizer, max_tokens)


def raw_code(df: DataFrame, tokenizer=DEFAULT_TOKENIZER, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Code rows: text column, truncated text, id, source."""
    rows = ensure_id(fields.pick_text(df), columns=[c for c in df.columns if c != "id"], fill_empty=False)
    cut = rows.withColumn(truncated_name(max_tokens), truncate_text("text", tokenizer, max_tokens))
    return fields.ensure_source(cut, "github_raw_code")


def base_rows(df: DataFrame, tokenizer=DEFAULT_TOKENIZER, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """The plain variant: id, and the first text column cut under its own name."""
    rows = ensure_id(df, fill_empty=False)
    name = fields.text_field(rows)
    if name is None:
        return rows
    return rows.withColumn(truncated_name(max_tokens, name), truncate_text(name, tokenizer, max_tokens))


def packaged_repositories(
    df: DataFrame, tokenizer=DEFAULT_TOKENIZER, max_tokens: int = MAX_TOKENS
) -> DataFrame:
    """One row per package text; packages without a files section are dropped.

    ``df`` has ``path``, ``file_name``, ``language`` and ``content``. Everything
    is worked out inside the row, so nothing is shuffled.
    """
    entries = F.col("_entries")
    n_files, lines = F.size(entries), F.col("_lines")
    staged = (
        pk.with_section(df, section="_section")
        .withColumn("_paths", pk.file_paths("_section"))
        .withColumn("_entries", pk.file_entries("_section"))
        .withColumn("_lines", pk.total_lines("_entries"))
    )
    columns: dict[str, Column] = {
        "id": F.sha2(F.concat_ws("\u0001", "path", "content"), 256),
        "text": F.col("content"),
        "source": F.lit("repo_xml"),
        **pk.package_identity("file_name"),
        "language": F.col("language"),
        "files_with_content": n_files,
        "total_lines": lines,
        "avg_lines_per_file": F.coalesce(F.try_divide(lines.cast("double"), n_files), F.lit(0.0)),
        "has_readme": pk.mentions("_paths", "readme"),
        "has_license": pk.mentions("_paths", "license"),
        "has_gitignore": pk.has_path("_paths", ".gitignore"),
        "content_length": F.length("content"),
        "content_lines": line_count("content"),
        "avg_line_length": average_line_length("content"),
        "file_types": pk.counts_json(pk.extension_counts("_entries")),
        "xml_file_path": F.col("path"),
        "file_extension": F.element_at(F.split("file_name", r"\."), -1),
        truncated_name(max_tokens): truncate_text("content", tokenizer, max_tokens),
    }
    return staged.select(*[value.alias(name) for name, value in columns.items()])


def rejected_packages(df: DataFrame) -> DataFrame:
    """Packages per language that have no files section."""
    lost = df.filter(pk.files_section("content").isNull())
    return lost.groupBy("language").agg(F.count(F.lit(1)).alias("n_rejected"))


def triplets(df: DataFrame, tokenizer=DEFAULT_TOKENIZER, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Triplet rows: id, truncated text, language and the fixed placeholders."""
    return fields.add_triplet_fields(fields.add_truncated(ensure_id(df, fill_empty=False), tokenizer, max_tokens))


PREPROCESSORS: dict[str, Callable[..., DataFrame]] = {
    "universal": universal,
    "github_raw_code": raw_code,
    "github": base_rows,
    "repo_xml": packaged_repositories,
    "triplet_filter": triplets,
}


def preprocessor(kind: str | None) -> Callable[..., DataFrame]:
    """The named preprocessor; the universal one by default."""
    return PREPROCESSORS.get(kind or "universal", universal)


def preprocess_files(
    spark: SparkSession,
    folder: str,
    out: str,
    read: Callable[[list[str]], DataFrame],
    transform: Callable[[DataFrame], DataFrame],
    pattern: str = "*.parquet",
    stats: DataFrame | None = None,
    limit: int = -1,
    check_outputs: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Run a preprocessor over a folder's unfinished files.

    ``read`` takes paths and must tag rows with ``source_path``, the file's path as
    ``sources.listing.file_path`` gives it; ``transform`` must keep it. Returns the rows
    as written to ``out`` and a stat row per file, those without rows included; add these
    to the stats table to skip the files next time. The first ``limit`` files by path are
    looked at, finished ones among them skipped. With ``check_outputs`` a file whose output
    folder is gone counts as unfinished; one folder per earlier run is looked up. The paths
    pass the driver, as in any Spark read of a list of files.
    """
    listing = limit_files(list_files(spark, folder, pattern).select("path", "file_name", "length"), limit)
    if stats is not None:
        there = None
        if check_outputs:
            runs = [r.formatted_file_path for r in stats.select("formatted_file_path").distinct().collect()]
            there = spark.createDataFrame([(r,) for r in runs if r and exists(spark, r)], "path string")
        listing = pending_files(listing, stats, there)
    files = listing.orderBy("path").collect()
    if not files:
        raise FileNotFoundError(f"no unfinished files match {pattern!r} in {folder}")
    started = datetime.now(timezone.utc)
    written = stage(transform(read([f.path for f in files])), path=out)
    ended = datetime.now(timezone.utc)
    done = spark.createDataFrame(files, listing.schema).select(
        "file_name",
        F.col("path").alias("raw_file_path"),
        F.lit(out).alias("formatted_file_path"),
        F.col("length").alias("input_file_size_bytes"),
        F.lit(started.isoformat()).alias("start_time"),
        F.lit(ended.isoformat()).alias("end_time"),
        F.lit((ended - started).total_seconds()).alias("processing_time_seconds"),
    )
    counts = file_stats(written, "source_path").drop("processing_complete").withColumnRenamed("source_path", "raw_file_path")
    return written, (
        done.join(counts, "raw_file_path", "left")
        .withColumn("n_sample", F.coalesce("n_sample", F.lit(0)))
        .withColumn("processing_complete", F.lit(True))
    )
