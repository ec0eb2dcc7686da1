"""Packaged repositories: one text with a ``<files>`` section per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.text import as_column, bind, cut_between, line_count, path_extension

# The layout of package texts and of their file names.
OPEN_TAG = r'<file path="[^"]+">'
_PATHS = r'<file path="([^"]+)">'
_ENTRIES = r'<file path="([^"]+)">([^<]*+(?:<(?!/file>)[^<]*+)*+)</file>'
NAME_PATTERN = r"^([^_]+)_([^_]+)_([a-f0-9]+)\.(xml|cxml)"
TOOLS = {"xml": "repomix", "cxml": "rendergit"}
UNKNOWN_TOOL = "unknown"


def files_section(content: Column | str) -> Column:
    """Text of the first files section; null when there is none."""
    return cut_between(content, "<files>", "</files>")["inside"]


def with_section(df: DataFrame, content: str = "content", section: str = "section") -> DataFrame:
    """Add the files section; rows without one are dropped.

    Exploding an array of at most one text does both in one evaluation; a filter
    would search every text a second time.
    """
    found = F.array_compact(F.array(files_section(content)))
    return df.select("*", F.explode(found).alias(section))


def file_paths(section: Column | str) -> Column:
    return F.regexp_extract_all(as_column(section), F.lit(_PATHS), F.lit(1))


def file_entries(section: Column | str) -> Column:
    """Array of (path, body) for the files that are closed.

    The pattern runs from ``<`` to ``<`` up to the first closing tag, without
    going back and without recursion.
    """
    section = as_column(section)
    paths, bodies = (F.regexp_extract_all(section, F.lit(_ENTRIES), F.lit(group)) for group in (1, 2))
    return F.arrays_zip(paths.alias("path"), bodies.alias("body"))


def mentions(paths: Column | str, word: str) -> Column:
    """True if any path contains the word, case ignored."""
    return F.exists(as_column(paths), lambda p: F.lower(p).contains(word))


def has_path(paths: Column | str, path: str) -> Column:
    return F.array_contains(as_column(paths), path)


def total_lines(entries: Column | str) -> Column:
    return F.aggregate(as_column(entries), F.lit(0), lambda acc, e: acc + line_count(e["body"]))


def extension_counts(entries: Column | str) -> Column:
    """Map of extension to number of files, in order of first appearance."""
    # Kinds are joined into one text and counted by their marked occurrences:
    # cheaper than comparing every file with every kind.
    def marked(kind: Column) -> Column:
        return F.concat(F.lit("\u0001"), kind, F.lit("\u0002"))

    def count_each(kinds: Column) -> Column:
        def count(joined: Column, kind: Column) -> Column:
            key = marked(kind)
            removed = F.length(joined) - F.length(F.replace(joined, key, F.lit("")))
            return (removed / F.length(key)).cast("int")

        return bind(
            F.array_join(F.transform(kinds, marked), ""),
            lambda joined: F.transform(
                F.array_distinct(kinds), lambda kind: F.struct(kind.alias("key"), count(joined, kind).alias("value"))
            ),
        )

    kinds = F.transform(as_column(entries), lambda e: path_extension(e["path"]))
    return F.map_from_entries(bind(kinds, count_each))


def counts_json(counts: Column | str) -> Column:
    """The map as JSON with blanks after colons and commas."""
    pairs = F.transform(
        F.map_entries(as_column(counts)),
        lambda e: F.concat(
            F.regexp_replace(F.to_json(F.array(e["key"])), r"^\[|\]$", ""),
            F.lit(": "),
            e["value"].cast("string"),
        ),
    )
    return F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}"))


def package_identity(file_name: Column | str) -> dict[str, Column]:
    """User, repository, commit and tool read off a package's file name."""
    file_name = as_column(file_name)
    user, repo, commit, kind = (F.regexp_extract(file_name, NAME_PATTERN, i) for i in (1, 2, 3, 4))
    tool = F.lit(UNKNOWN_TOOL)
    for extension, name in TOOLS.items():
        tool = F.when(kind == extension, F.lit(name)).otherwise(tool)
    return {
        "repo_user": user,
        "repo_name": repo,
        "repo_full_name": F.when(kind != "", F.concat(user, F.lit("/"), repo)).otherwise(F.lit("")),
        "commit_hash": commit,
        "packaging_tool": tool,
    }
