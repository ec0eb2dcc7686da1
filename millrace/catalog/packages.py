"""Queries for packaged repositories."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import Entry
from millrace.catalog.inputs import PACKAGES_SQL, packages
from millrace.functions import packages as pk
from millrace.plans.preprocess import packaged_repositories, rejected_packages

_SECTION_SQL = "regexp_extract(content, '(?s)<files>(.*?)</files>', 1)"
_PATHS_SQL = f"""regexp_extract_all({_SECTION_SQL}, '<file path="([^"]+)">', 1)"""
_FILES_SQL = f"""(SELECT *, {_PATHS_SQL} AS paths,
    regexp_extract_all({_SECTION_SQL}, '(?s)<file path="([^"]+)">(.*?)</file>', 1) AS names,
    regexp_extract_all({_SECTION_SQL}, '(?s)<file path="([^"]+)">(.*?)</file>', 2) AS bodies
    FROM {PACKAGES_SQL} WHERE contains(content, '</files>'))"""
_LINES_SQL = "list_sum(list_transform(bodies, lambda b: length(b) - length(replace(b, chr(10), '')) + 1))::BIGINT"
_EXTS_SQL = r"""list_transform(names, lambda p: lower(regexp_extract(p, '^(?:(?s:.*)/)?\.*[^/.][^/]*?(\.[^./]*)$', 1)))"""
_COUNTS_SQL = f"""(SELECT * EXCLUDE (exts), '{{' || array_to_string(list_transform(
        list_filter(exts, lambda x, i: list_position(exts, x) = i),
        lambda x: '"' || x || '": ' || len(list_filter(exts, lambda y: y = x))), ', ') || '}}' AS file_types
    FROM (SELECT *, {_EXTS_SQL} AS exts FROM {_FILES_SQL}))"""
_NAME = f"'{pk.NAME_PATTERN}'"
_FLAGS_SQL = """list_bool_or(list_transform(paths, lambda p: contains(lower(p), 'readme'))) AS has_readme,
    list_bool_or(list_transform(paths, lambda p: contains(lower(p), 'license'))) AS has_license,
    list_contains(paths, '.gitignore') AS has_gitignore"""
_IDENTITY_SQL = f"""regexp_extract(file_name, {_NAME}, 1) AS repo_user, regexp_extract(file_name, {_NAME}, 2) AS repo_name,
    CASE WHEN regexp_matches(file_name, {_NAME}) THEN regexp_extract(file_name, {_NAME}, 1) || '/'
         || regexp_extract(file_name, {_NAME}, 2) ELSE '' END AS repo_full_name,
    regexp_extract(file_name, {_NAME}, 3) AS commit_hash,
    CASE regexp_extract(file_name, {_NAME}, 4) WHEN 'xml' THEN 'repomix' WHEN 'cxml' THEN 'rendergit'
         ELSE 'unknown' END AS packaging_tool"""


def _sections(spark, sf):
    return pk.with_section(packages(spark, sf))


def _structure(spark, sf):
    return _sections(spark, sf).select(
        "doc_id",
        F.array_join(pk.file_paths("section"), "|").alias("paths"),
        F.array_join(F.transform(pk.file_entries("section"), lambda e: e["body"]), "|").alias("bodies"),
    )


def _flags(spark, sf):
    paths = pk.file_paths("section")
    return _sections(spark, sf).select(
        "doc_id",
        pk.mentions(paths, "readme").alias("has_readme"),
        pk.mentions(paths, "license").alias("has_license"),
        pk.has_path(paths, ".gitignore").alias("has_gitignore"),
    )


def _identity(spark, sf):
    return packages(spark, sf).select("doc_id", *[c.alias(n) for n, c in pk.package_identity("file_name").items()])


def _histogram(spark, sf):
    entries = pk.file_entries("section")
    return _sections(spark, sf).select("doc_id", pk.counts_json(pk.extension_counts(entries)).alias("file_types"))


def _totals(spark, sf):
    rows = _sections(spark, sf).withColumn("entries", pk.file_entries("section"))
    n, lines = F.size("entries").cast("bigint"), pk.total_lines("entries").cast("bigint")
    return rows.select(
        "doc_id", n.alias("n_files"), lines.alias("total_lines"), (lines / n).alias("avg_lines_per_file")
    )


def _rows(spark, sf):
    rows = packaged_repositories(packages(spark, sf))
    counts = ["files_with_content", "total_lines", "content_length", "content_lines"]
    return rows.drop("id", "source").withColumns({c: F.col(c).cast("bigint") for c in counts})


ENTRIES = {
    "st8": Entry(_flags, f"SELECT doc_id, {_FLAGS_SQL} FROM {_FILES_SQL}"),
    "st9": Entry(
        _structure,
        f"SELECT doc_id, array_to_string(paths, '|') AS paths, array_to_string(bodies, '|') AS bodies FROM {_FILES_SQL}",
    ),
    "st10": Entry(_identity, f"SELECT doc_id, {_IDENTITY_SQL} FROM {PACKAGES_SQL}"),
    "ag10": Entry(_histogram, f"SELECT doc_id, file_types FROM {_COUNTS_SQL}"),
    "ag11": Entry(
        _totals,
        f"""SELECT doc_id, len(bodies) AS n_files, {_LINES_SQL} AS total_lines,
                   {_LINES_SQL} / len(bodies)::DOUBLE AS avg_lines_per_file FROM {_FILES_SQL}""",
    ),
    "fl8": Entry(
        lambda spark, sf: rejected_packages(packages(spark, sf)),
        f"""SELECT language, count(*) AS n_rejected FROM {PACKAGES_SQL} WHERE NOT contains(content, '</files>')
            GROUP BY language""",
    ),
    "pr10": Entry(
        _rows,
        f"""SELECT content AS text, {_IDENTITY_SQL}, language, len(bodies) AS files_with_content,
                   {_LINES_SQL} AS total_lines, {_LINES_SQL} / len(bodies)::DOUBLE AS avg_lines_per_file, {_FLAGS_SQL},
                   length(content) AS content_length, len(string_split(content, chr(10))) AS content_lines,
                   length(content) / len(string_split(content, chr(10)))::DOUBLE AS avg_line_length, file_types,
                   path AS xml_file_path, string_split(file_name, '.')[-1] AS file_extension,
                   CASE WHEN length(content) > 20000 THEN array_to_string(list_slice(
                       regexp_extract_all(content, '[A-Za-z0-9_]+|[ \\t\\r\\n]+|[^A-Za-z0-9_ \\t\\r\\n]'), 1, 32768), '')
                       ELSE content END AS content_truncate_32k
            FROM {_COUNTS_SQL}""",
    ),
}
