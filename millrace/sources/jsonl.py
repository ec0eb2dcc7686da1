"""JSON lines: strict and tolerant reads, writes."""

from __future__ import annotations

import json
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.functions.text import as_column, strip
from millrace.operators.ordinals import in_chunks, number_in_blocks

#: Standard JSON only, except for NaN, which writers in the field do emit.
_JSON_OPTIONS = {"allowSingleQuotes": "false", "mode": "FAILFAST"}


@F.pandas_udf(T.BooleanType())
def _not_an_object(lines: pd.Series) -> pd.Series:
    """True where the whole text is no JSON object; a null says that this is settled already."""

    def check(line: str | None) -> bool:
        if line is None:
            return False
        try:
            return not isinstance(json.loads(line), dict)
        except (ValueError, RecursionError):
            return True

    return lines.map(check).astype(bool)


def is_json_object(line: Column | str) -> Column:
    """True where the whole text is one JSON object.

    The JVM's parser lets pass single quotes, control characters and text after the object.
    Lines with a character of the first two kinds go to Python. Any other is put into a list
    before a text that no line can hold: that text is the list's second element only if the
    line is one whole value. Lines that fail go to Python too, which also takes NaN; the
    others are not sent. A null text is no object.
    """
    line = as_column(line)
    end = uuid.uuid4().hex
    second = F.get_json_object(F.concat(F.lit("["), line, F.lit(f',"{end}"]')), "$[1]")
    plain = F.startswith(line, F.lit("{")) & ~F.rlike(line, F.lit(r"['\x00-\x1f]"))
    sure = F.coalesce(plain & (second == end), F.lit(False))
    return ~_not_an_object(F.when(~sure, line)) & line.isNotNull()


def clean_utf8(text: Column) -> Column:
    """Bytes that are no UTF-8 are dropped."""
    dropped = F.replace(F.make_valid_utf8(text), F.lit("�"), F.lit(""))
    return F.when(F.is_valid_utf8(text), text).otherwise(dropped)


#: Columns that order the lines of one file: where its block starts, and a number that grows inside a block.
LINE_PLACE = ["file_block", "line_place"]


def read_lines(spark: SparkSession, path: str | list[str], places: bool = False) -> DataFrame:
    """Stripped, non-blank lines as ``line`` with ``file_name`` and ``file_path``.

    ``places`` adds ``LINE_PLACE``. One task reads a block, from its start to its end, so
    these columns follow the file's order without a task per file; their values depend on
    how Spark cuts the files and say nothing but the order.
    """
    place = [F.col("_metadata.file_block_start").alias("file_block"), F.monotonically_increasing_id().alias("line_place")]
    lines = spark.read.text(path).select(
        strip(clean_utf8(F.col("value"))).alias("line"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_path").alias("file_path"),
        *(place if places else []),
    )
    return lines.filter(F.col("line") != "")


def line_order(path: str = "file_path") -> list[Column]:
    """Sort keys for lines of many files: files by path, numbers in it by value, then lines as they stand."""
    padded = F.regexp_replace(path, r"(\d+)", "0" * 12 + "$1")
    return [F.regexp_replace(padded, r"0*(\d{12})(?!\d)", "$1"), F.col(path), *[F.col(c) for c in LINE_PLACE]]


def block_order(path: str = "file_path") -> list[Column]:
    """Sort keys for blocks of lines: as ``line_order``, without the place inside a block."""
    return line_order(path)[:-1]


def number_lines(lines: DataFrame, name: str = "ord") -> tuple[DataFrame, int]:
    """Lines read with their places, numbered 1, 2, ... in ``line_order``; also returns how many there are.

    Lines may have been filtered, not moved, since they were read.
    """
    numbered, total = number_in_blocks(lines, ["file_path", "file_block"], block_order(), name)
    return numbered.drop(*LINE_PLACE), total


def split_lines(lines: DataFrame, chunks: int | None = None, rows_per_chunk: int | None = None, stem: str = "part") -> DataFrame:
    """Contiguous chunks of lines as their files hold them, as ``operators.ordinals.split_rows`` cuts rows; no line moves."""
    if chunks is None and rows_per_chunk is None:
        raise ValueError("give chunks or rows_per_chunk")
    return in_chunks(*number_lines(lines), chunks, rows_per_chunk, stem)


def read_strict(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    max_rows: int | None = None,
    exact: bool = False,
) -> DataFrame:
    """Every non-blank line must be a JSON object; the first bad one fails the read.

    Give a schema for anything large: without one Spark reads the data twice.
    Spark's reader lets text after the object pass; ``exact`` does not, at the
    price of a check in Python. It needs a schema.
    """
    if exact:
        bad = F.raise_error(F.concat(F.lit("invalid JSON line in "), "file_path"))
        line = F.when(is_json_object("line"), F.col("line")).otherwise(bad)
        rows = read_lines(spark, path).select(F.from_json(line, schema, {"allowSingleQuotes": "false"}).alias("_row"))
        rows = rows.select("_row.*")
    else:
        reader = spark.read.options(**_JSON_OPTIONS)
        rows = reader.schema(schema).json(path) if schema is not None else reader.json(path)
    return rows.limit(max_rows) if max_rows is not None else rows


def read_tolerant(
    spark: SparkSession, path: str | list[str], schema: T.StructType, keep_file: bool = False, places: bool = False
) -> DataFrame:
    """Lines that are not JSON objects are skipped.

    Spark's own readers accept some lines that are not JSON (text after the
    object, for one), so Python passes the verdict; values are then read by
    ``from_json`` in the JVM. ``places`` keeps the file's columns and those of ``line_order``.
    """
    good = read_lines(spark, path, places).filter(is_json_object("line"))
    parsed = good.withColumn("_row", F.from_json("line", schema, {"allowSingleQuotes": "false"}))
    names = ["file_name", "file_path"] if keep_file or places else []
    names += LINE_PLACE if places else []
    return parsed.select(*names, "_row.*")


def rejected_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Number of lines per file that ``read_tolerant`` skips."""
    bad = read_lines(spark, path).filter(~is_json_object("line"))
    return bad.groupBy("file_name").agg(F.count(F.lit(1)).alias("n_rejected"))


def in_written_order(df: DataFrame, order: list[Column | str]) -> DataFrame:
    """Rows dealt and sorted so that files written from them follow ``order``, from file to file and line to line.

    Written with ``partition_by``, ``order`` must begin with these columns, and they must not be nullable.
    """
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def write_jsonl(df: DataFrame, path: str, partition_by: list[str] | None = None, keep_nulls: bool = True) -> None:
    """One JSON object per line, non-ASCII kept as it is; nulls are written by default."""
    writer = df.write.option("ignoreNullFields", str(not keep_nulls).lower()).mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(path)
