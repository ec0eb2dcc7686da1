"""Field mapping and required fields."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, functions as F, types as T

from millrace.functions.identity import ensure_id
from millrace.functions.text import collapse_whitespace, remove_literals, render, truthy
from millrace.functions.tokens import truncate_text, truncated_name

# Where a row's text is looked for when it has none.
TEXT_FALLBACKS = ("content", "body", "description", "message")
CODE_TEXT_COLUMNS = ("text", "content", "code", "body", "description")
BASE_TEXT_COLUMNS = ("text", "content", "body")

# Placeholders that prompts for triplets refer to.
TRIPLET_PLACEHOLDERS = {
    "repo_full_name": "Code Repository",
    "files_with_content": "Multiple",
    "total_lines": "Large",
    "has_readme": "Unknown",
    "has_license": "Unknown",
    "has_gitignore": "Unknown",
}
UNKNOWN_LANGUAGE = "Unknown"


def map_fields(df: DataFrame, mapping: dict[str, Any]) -> DataFrame:
    """Build target columns; all other columns are kept.

    A target is a source column's name, ``{"type": "combine", "fields": [...],
    "separator": " "}`` for the non-empty values joined, or ``{"type":
    "constant", "value": ...}``. Every target reads the row as it came in.
    """
    targets = {}
    for target, source in mapping.items():
        if isinstance(source, str):
            if source in df.columns:
                targets[target] = F.col(source)
        elif source.get("type") == "combine":
            parts = []
            for name in source.get("fields", []):
                if name in df.columns:
                    dtype = df.schema[name].dataType
                    parts.append(F.when(truthy(name, dtype), render(name, dtype)))
            targets[target] = F.concat_ws(source.get("separator", " "), *parts)
        elif source.get("type") == "constant":
            targets[target] = F.lit(source.get("value", ""))
    return df.withColumns(targets) if targets else df


def clean_text(df: DataFrame, extra_whitespace: bool = False, remove: list[str] | None = None) -> DataFrame:
    """White space first, then the listed substrings."""
    if "text" not in df.columns:
        return df
    text = F.col("text").cast("string")
    if extra_whitespace:
        text = collapse_whitespace(text)
    return df.withColumn("text", remove_literals(text, remove or []))


def add_computed(df: DataFrame, computed: dict[str, dict[str, str]], tokenizer) -> DataFrame:
    """Length and token-count columns; no value where the source has none."""
    for name, rule in computed.items():
        source = rule.get("source_field", "text")
        if source not in df.columns:
            continue
        value = F.when(F.col(source).isNotNull(), render(source, df.schema[source].dataType))
        if rule["type"] == "text_length":
            df = df.withColumn(name, F.length(value))
        elif rule["type"] == "token_count":
            df = df.withColumn(name, tokenizer.count(value))
        else:
            raise ValueError(f"unknown computed field type: {rule['type']}")
    return df


def ensure_text(df: DataFrame) -> DataFrame:
    """Fill ``text`` from the first fallback column that holds something, else with ''."""
    candidates = [F.col("text").cast("string")] if "text" in df.columns else []
    for name in TEXT_FALLBACKS:
        if name in df.columns:
            dtype = df.schema[name].dataType
            candidates.append(F.when(truthy(name, dtype), render(name, dtype)))
    return df.withColumn("text", F.coalesce(*candidates, F.lit("")))


def ensure_source(df: DataFrame, name: str = "unknown") -> DataFrame:
    """Fill ``source`` with the configured name."""
    given = [F.col("source").cast("string")] if "source" in df.columns else []
    return df.withColumn("source", F.coalesce(*given, F.lit(name)))


def ensure_required(df: DataFrame, source_name: str = "unknown", id_columns: list[str] | None = None) -> DataFrame:
    """``id``, ``text`` and ``source`` on every row."""
    return ensure_source(ensure_text(ensure_id(df, columns=id_columns)), source_name)


def pick_text(df: DataFrame, candidates: tuple[str, ...] = CODE_TEXT_COLUMNS) -> DataFrame:
    """Set ``text`` from the first candidate column the data has; none is an error."""
    for name in candidates:
        if name in df.columns:
            return df if name == "text" else df.withColumn("text", F.col(name))
    raise ValueError(f"no text column among {df.columns}")


def text_field(df: DataFrame, candidates: tuple[str, ...] = BASE_TEXT_COLUMNS) -> str | None:
    """Name of the first candidate column the data has."""
    return next((name for name in candidates if name in df.columns), None)


def add_truncated(
    df: DataFrame, tokenizer, max_tokens: int, text: str = "text", prefix: str = "content", strict: bool = False
) -> DataFrame:
    """Add the text cut to ``max_tokens``; null where there is no text."""
    value = F.when(truthy(text, T.StringType()), F.col(text))
    return df.withColumn(truncated_name(max_tokens, prefix), truncate_text(value, tokenizer, max_tokens, strict))


def add_triplet_fields(df: DataFrame) -> DataFrame:
    """Language from ``lg`` and the fixed placeholders, on rows that have text."""
    has_text = truthy("text", T.StringType())
    language = F.coalesce(F.col("lg"), F.lit(UNKNOWN_LANGUAGE)) if "lg" in df.columns else F.lit(UNKNOWN_LANGUAGE)
    values = {"language": language, **{k: F.lit(v) for k, v in TRIPLET_PLACEHOLDERS.items()}}
    return df.withColumns({k: F.when(has_text, v) for k, v in values.items()})
