"""String, truthiness and rendering columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# The code points a Python string treats as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same characters as a Java class, and runs of them that are not one blank.
_SPACE = r"[\s\x1c-\x1f]"
_SPACE_RUN = rf"(?U) {_SPACE}+|[\s\x1c-\x1f&&[^ ]]{_SPACE}*"

#: Extension of the last path part; dots that open the name do not count.
_EXTENSION = r"^(?:(?s:.*)/)?\.*[^/.][^/]*?(\.[^./]*)$"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once, however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def cut_between(text: Column | str, opening: str, closing: str) -> Column:
    """Struct of the text before, inside and after the first ``opening ... closing`` span.

    Null when there is no such span. Each mark is searched for once.
    """
    text = as_column(text)

    def cut(start: Column) -> Column:
        rest = F.substring(text, start + F.lit(len(opening)), F.length(text))

        def pieces(rest: Column) -> Column:
            def at(end: Column) -> Column:
                found = F.struct(
                    F.substring(text, F.lit(1), start - F.lit(1)).alias("before"),
                    F.substring(rest, F.lit(1), end - F.lit(1)).alias("inside"),
                    F.substring(rest, end + F.lit(len(closing)), F.length(rest)).alias("after"),
                )
                return F.when(end > 0, found)

            return bind(F.instr(rest, closing), at)

        return F.when(start > 0, bind(rest, pieces))

    return bind(F.instr(text, opening), cut)


def truthy(column: Column | str, dtype: T.DataType) -> Column:
    """True unless the value is null, empty, zero or false."""
    column = as_column(column)
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        test = column != ""
    elif isinstance(dtype, T.BooleanType):
        test = column
    elif isinstance(dtype, T.NumericType):
        test = column != 0
    elif isinstance(dtype, (T.ArrayType, T.MapType)):
        test = F.size(column) > 0
    elif isinstance(dtype, T.BinaryType):
        test = F.length(column) > 0
    elif isinstance(dtype, T.NullType):
        return F.lit(False)
    else:
        test = column.isNotNull()
    return F.coalesce(test, F.lit(False))


def render(column: Column | str, dtype: T.DataType) -> Column:
    """The value as text inside a prompt or a combined field.

    Null prints ``None`` and booleans ``True``/``False``; nested values print as
    JSON.
    """
    column = as_column(column)
    if isinstance(dtype, T.BooleanType):
        text = F.initcap(column.cast("string"))
    elif isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        text = F.to_json(column)
    else:
        text = column.cast("string")
    return F.coalesce(text, F.lit("None"))


def length_score(text: Column | str) -> Column:
    """Characters over 100, kept within 0 and 5; null scores 0."""
    chars = F.length(F.coalesce(as_column(text), F.lit("")))
    return F.least(F.lit(5.0), F.greatest(F.lit(0.0), chars / F.lit(100.0)))


def strip(text: Column | str) -> Column:
    """Remove white space (all of Unicode's) at both ends."""
    return F.trim(as_column(text), F.lit(WHITESPACE))


def collapse_whitespace(text: Column | str) -> Column:
    """Every run of white space becomes one space; none is left at the ends."""
    return F.trim(F.regexp_replace(as_column(text), _SPACE_RUN, " "))


def remove_literals(text: Column | str, literals: list[str]) -> Column:
    """Delete each listed substring, in list order. The strings are not patterns."""
    out = as_column(text)
    for literal in literals:
        out = F.replace(out, F.lit(literal), F.lit(""))
    return out


def unix_newlines(text: Column | str) -> Column:
    """``\\r\\n`` and lone ``\\r`` become ``\\n``."""
    return F.regexp_replace(as_column(text), "\r\n?", "\n")


def line_count(text: Column | str) -> Column:
    """Number of pieces between line breaks, so one more than the breaks."""
    text = as_column(text)
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + F.lit(1)


def average_line_length(text: Column | str) -> Column:
    return F.length(as_column(text)) / F.greatest(line_count(text), F.lit(1))


def path_extension(path: Column | str) -> Column:
    """Lower-case extension with its dot; empty when there is none."""
    return F.lower(F.regexp_extract(as_column(path), _EXTENSION, 1))


def contains_any(text: Column | str, words: list[str]) -> Column:
    """True if any word occurs in the text, case ignored. Words are not patterns."""
    lowered = F.lower(F.coalesce(as_column(text), F.lit("")))
    found = F.lit(False)
    for word in words:
        found = found | lowered.contains(word.lower())
    return found
