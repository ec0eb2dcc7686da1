"""Row identity: ids and uids that come out the same on every run."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions.text import truthy


def sorted_json(value: Column, dtype: T.DataType) -> Column:
    """The value as JSON text: keys sorted, blanks after colons and commas, nulls left out.

    Put together from the type, so it stays in the JVM. Numbers print as Spark
    casts them.
    """
    if isinstance(dtype, T.StructType):
        pairs = []
        for entry in sorted(dtype, key=lambda f: f.name):
            part = value[entry.name]
            text = F.concat(F.lit(json.dumps(entry.name, ensure_ascii=False) + ": "), sorted_json(part, entry.dataType))
            pairs.append(F.when(part.isNotNull(), text))
        return F.concat(F.lit("{"), F.concat_ws(", ", *pairs), F.lit("}"))
    if isinstance(dtype, T.ArrayType):
        items = F.transform(value, lambda x: F.coalesce(sorted_json(x, dtype.elementType), F.lit("null")))
        return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
    if isinstance(dtype, T.MapType):
        entries = F.array_sort(F.map_entries(value))
        items = F.transform(
            entries,
            lambda e: F.concat(sorted_json(e["key"], T.StringType()), F.lit(": "),
                               F.coalesce(sorted_json(e["value"], dtype.valueType), F.lit("null"))),
        )
        return F.concat(F.lit("{"), F.array_join(items, ", "), F.lit("}"))
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return value.cast("string")
    quoted = F.to_json(F.array(value.cast("string")))
    return F.substring(quoted, F.lit(2), F.length(quoted) - F.lit(2))


def first_content(df: DataFrame, messages: str = "messages") -> Column:
    """Content of the first message; null when there is no such column or entry."""
    if messages not in df.columns:
        return F.lit(None).cast("string")
    return F.get(F.col(messages), F.lit(0))["content"]


def stable_uid(df: DataFrame, messages: str = "messages") -> Column:
    """``uid``, else ``id``, else MD5 of the first message, else MD5 of the row as JSON."""
    given = [F.col(c).cast("string") for c in ("uid", "id") if c in df.columns]
    content = first_content(df, messages)
    by_content = F.when(content != "", F.md5(content.cast("binary")))
    by_row = F.md5(sorted_json(F.struct(*[F.col(c) for c in df.columns]), df.schema).cast("binary"))
    return F.coalesce(*given, by_content, by_row)


def with_uid(df: DataFrame, messages: str = "messages") -> DataFrame:
    """Fill or add ``uid``."""
    return df.withColumn("uid", stable_uid(df, messages))


def content_id(df: DataFrame, columns: list[str] | None = None) -> Column:
    """SHA-256 over the given columns (all by default); the same row, the same id."""
    names = columns or df.columns
    parts = [F.coalesce(F.to_json(F.struct(F.col(c))), F.lit("{}")) for c in names]
    return F.sha2(F.concat_ws("\u0001", *parts), 256)


def ensure_id(
    df: DataFrame, id_column: str = "id", columns: list[str] | None = None, fill_empty: bool = True
) -> DataFrame:
    """Give rows without an id one made from their content.

    ``fill_empty`` also replaces ids that are empty or zero.
    """
    if id_column not in df.columns:
        return df.withColumn(id_column, content_id(df, columns))
    names = columns or [c for c in df.columns if c != id_column]
    given = F.col(id_column).cast("string")
    if fill_empty:
        given = F.when(truthy(id_column, df.schema[id_column].dataType), given)
    return df.withColumn(id_column, F.coalesce(given, content_id(df, names)))
