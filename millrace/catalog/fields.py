"""Queries for field mapping, required fields and row filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import Entry
from millrace.catalog.inputs import TOKENS_SQL, by_value, table
from millrace.catalog.text import TOKEN_LIMIT
from millrace.functions.identity import ensure_id
from millrace.functions.tokens import GATE_CHARS, PatternTokenizer
from millrace.operators import fields, filters
from millrace.plans.preprocess import universal


def _docs(step, *columns):
    return lambda spark, sf: step(table(spark, sf, "documents")).select("doc_id", *columns)


def _spotty(spark, sf):
    """Documents as mixed raw rows: text missing or empty in some, other fields in its place."""
    docs = table(spark, sf, "documents")
    none = F.lit(None).cast("string")
    return docs.select(
        "doc_id",
        by_value("lang", {"de": F.col("source"), "es": F.lit("")}, none).alias("id"),
        by_value("lang", {"en": F.col("text")}, none).alias("text"),
        by_value("lang", {"de": F.col("text"), "fr": F.lit("")}, none).alias("content"),
        by_value("lang", {"fr": F.col("text")}, none).alias("message"),
        F.when(F.col("source") != "src1", F.col("source")).alias("source"),
        (F.col("lang") == "en").alias("flag"),
        F.when(F.col("lang") == "en", F.col("n_chars")).otherwise(F.lit(0)).alias("size"),
    )


_SPOTTY_SQL = """(
    SELECT doc_id, CASE lang WHEN 'de' THEN source WHEN 'es' THEN '' END AS id,
           CASE WHEN lang = 'en' THEN text END AS text,
           CASE lang WHEN 'de' THEN text WHEN 'fr' THEN '' END AS content,
           CASE WHEN lang = 'fr' THEN text END AS message,
           CASE WHEN source <> 'src1' THEN source END AS source,
           lang = 'en' AS flag, CASE WHEN lang = 'en' THEN n_chars ELSE 0 END AS size
    FROM documents)"""


def _ids(spark, sf):
    rows = ensure_id(_spotty(spark, sf), columns=["doc_id", "source"])
    made = F.col("id").rlike("^[0-9a-f]{64}$")
    return rows.select("doc_id", F.when(made, F.lit("made")).otherwise(F.col("id")).alias("id"))


def _usable(spark, sf):
    """Rows with gaps everywhere through the whole universal job: none fails, none is lost."""
    config = {
        "field_mapping": {"label": {"type": "combine", "fields": ["id", "content", "source"]}},
        "transformations": {"text_cleaning": {"remove_characters": ["###"]}, "computed_fields": {"n": {"type": "text_length"}}},
    }
    rows = universal(_spotty(spark, sf), config, max_tokens=1024)
    return rows.select("doc_id", "text", "label", F.col("n").cast("bigint").alias("n"))


ENTRIES = {
    "pr1": Entry(
        _docs(lambda d: fields.map_fields(d, {"body": "text", "nothing": "missing"}), "body", "text"),
        "SELECT doc_id, text AS body, text FROM documents",
    ),
    "pr2": Entry(
        lambda spark, sf: fields.map_fields(
            _spotty(spark, sf),
            {"joined": {"type": "combine", "fields": ["id", "content", "size", "flag", "none", "source"], "separator": " | "}},
        ).select("doc_id", "joined"),
        f"""SELECT doc_id, concat_ws(' | ', nullif(id, ''), nullif(content, ''), CASE WHEN size <> 0 THEN size END,
                   CASE WHEN flag THEN 'True' END, source) AS joined FROM {_SPOTTY_SQL}""",
    ),
    "pr3": Entry(
        _docs(lambda d: fields.map_fields(d, {"origin": {"type": "constant", "value": "web"}}), "origin"),
        "SELECT doc_id, 'web' AS origin FROM documents",
    ),
    "pr4": Entry(
        _ids,
        f"SELECT doc_id, CASE WHEN coalesce(id, '') = '' THEN 'made' ELSE id END AS id FROM {_SPOTTY_SQL}",
    ),
    "pr5": Entry(
        lambda spark, sf: fields.ensure_text(_spotty(spark, sf)).select("doc_id", "text"),
        f"SELECT doc_id, coalesce(text, nullif(content, ''), nullif(message, ''), '') AS text FROM {_SPOTTY_SQL}",
    ),
    "pr6": Entry(
        lambda spark, sf: fields.ensure_source(_spotty(spark, sf), "crawl").select("doc_id", "source"),
        f"SELECT doc_id, coalesce(source, 'crawl') AS source FROM {_SPOTTY_SQL}",
    ),
    "pr7": Entry(
        lambda spark, sf: fields.pick_text(
            table(spark, sf, "documents").select("doc_id", F.col("text").alias("body"), F.col("source").alias("description"))
        ).select("doc_id", "text"),
        "SELECT doc_id, text FROM documents",
    ),
    "pr8": Entry(
        _docs(lambda d: fields.add_truncated(d, PatternTokenizer(), TOKEN_LIMIT), "content_truncate_1k"),
        f"""SELECT doc_id, CASE WHEN length(text) > {GATE_CHARS}
            THEN array_to_string(list_slice({TOKENS_SQL}, 1, {TOKEN_LIMIT}), '') ELSE text END AS content_truncate_1k
            FROM documents""",
    ),
    "pr9": Entry(
        lambda spark, sf: fields.add_triplet_fields(
            _spotty(spark, sf).withColumn("lg", F.when(F.col("source") != "src2", F.lit("Python")))
        ).select("doc_id", "language", *fields.TRIPLET_PLACEHOLDERS),
        f"""SELECT doc_id, CASE WHEN ok THEN CASE WHEN source <> 'src2' THEN 'Python' ELSE 'Unknown' END END AS language,
                   CASE WHEN ok THEN 'Code Repository' END AS repo_full_name,
                   CASE WHEN ok THEN 'Multiple' END AS files_with_content, CASE WHEN ok THEN 'Large' END AS total_lines,
                   CASE WHEN ok THEN 'Unknown' END AS has_readme, CASE WHEN ok THEN 'Unknown' END AS has_license,
                   CASE WHEN ok THEN 'Unknown' END AS has_gitignore
            FROM (SELECT *, coalesce(text, '') <> '' AS ok FROM {_SPOTTY_SQL})""",
    ),
    "fl1": Entry(
        _docs(lambda d: filters.text_length_between(d, 200, 2000)),
        "SELECT doc_id FROM documents WHERE length(text) BETWEEN 200 AND 2000",
    ),
    "fl2": Entry(
        lambda spark, sf: filters.require_fields(_spotty(spark, sf), ["text", "source", "size", "flag"]).select("doc_id"),
        f"SELECT doc_id FROM {_SPOTTY_SQL} WHERE text <> '' AND source <> '' AND size <> 0 AND flag",
    ),
    "fl3": Entry(
        _docs(lambda d: filters.without_words(d, ["LICENSE", "the the"])),
        """SELECT doc_id FROM documents
           WHERE NOT contains(lower(text), 'license') AND NOT contains(lower(text), 'the the')""",
    ),
    "fl9": Entry(
        _usable,
        f"""SELECT doc_id, coalesce(replace(text, '###', ''), nullif(content, ''), nullif(message, ''), '') AS text,
                   concat_ws(' ', nullif(id, ''), nullif(content, ''), source) AS label,
                   length(replace(text, '###', '')) AS n FROM {_SPOTTY_SQL}""",
    ),
}
