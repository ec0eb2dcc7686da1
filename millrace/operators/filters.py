"""Row filters."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.text import contains_any, truthy


def text_length_between(df: DataFrame, low: int = 0, high: int = 0, text: str = "text") -> DataFrame:
    """Keep texts of ``low`` to ``high`` characters, both included; 0 means no bound.

    Rows without text are not judged here.
    """
    if text not in df.columns:
        return df
    chars = F.length(F.col(text).cast("string"))
    if low:
        df = df.filter(chars.isNull() | (chars >= low))
    if high:
        df = df.filter(chars.isNull() | (chars <= high))
    return df


def require_fields(df: DataFrame, names: list[str]) -> DataFrame:
    """Keep rows where every named field holds something."""
    for name in names:
        if name not in df.columns:
            return df.filter(F.lit(False))
        df = df.filter(truthy(name, df.schema[name].dataType))
    return df


def without_words(df: DataFrame, words: list[str], text: str = "text") -> DataFrame:
    """Drop rows whose text contains a listed word, case ignored."""
    if not words or text not in df.columns:
        return df
    return df.filter(~contains_any(F.col(text).cast("string"), words))


def apply_filters(df: DataFrame, config: dict[str, Any]) -> DataFrame:
    """Length, required fields and word list, as configured."""
    df = text_length_between(df, config.get("min_text_length") or 0, config.get("max_text_length") or 0)
    df = require_fields(df, config.get("required_fields", []))
    return without_words(df, config.get("blacklist_patterns", []))


def with_messages(df: DataFrame, messages: str = "messages") -> DataFrame:
    """Keep rows that have at least one message."""
    return df.filter(F.size(F.col(messages)) > 0)


def successes(df: DataFrame, status: str = "api_status") -> DataFrame:
    return df.filter(F.col(status) == "success")


def failures(df: DataFrame, status: str = "api_status") -> DataFrame:
    return df.filter(F.col(status) == "error")


def shard_file_kind(file_name: Column) -> Column:
    """``output``, ``error`` or ``ignored`` for a shard file's name."""
    retry = file_name.contains("_retry")
    return (
        F.when(retry, F.lit("ignored"))
        .when(file_name.contains("_error"), F.lit("error"))
        .otherwise(F.lit("output"))
    )


def selected(df: DataFrame, column: str, names: list[str] | None) -> DataFrame:
    """Keep the named rows; no names keeps all."""
    return df.filter(F.col(column).isin(list(names))) if names else df
