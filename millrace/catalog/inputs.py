"""Tables the queries read, and inputs of other shapes derived from them.

Every derived input keeps all rows and whole texts of its table; which shape a
row takes depends on an attribute of the row. Each comes with the same
derivation in SQL.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions.chatml import message
from millrace.functions.tokens import WORD_PATTERN
from millrace.sources.tables import bytes_below


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pieces(spark: SparkSession, sf_dir: str, name: str, mb: int) -> int:
    """How many pieces of at most so many MB a table's files make."""
    return 1 + bytes_below(spark, f"{sf_dir}/{name}.parquet") // (mb << 20)


@contextmanager
def read_by_blocks(spark: SparkSession, folder: str, size: str, task_mb: int = 16):
    """Splits the files below a folder in blocks of ``size``; one task reads several, up to ``task_mb``."""
    tasks = max(spark.sparkContext.defaultParallelism, bytes_below(spark, folder) // (task_mb << 20))
    names = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.maxPartitionNum": str(tasks)}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def by_value(column: str, cases: dict[str, Column], otherwise: Column) -> Column:
    out = otherwise
    for value, result in cases.items():
        out = F.when(F.col(column) == value, result).otherwise(out)
    return out


# -- requests: documents with a uid, an id, or neither; one user message each -------------


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        F.when(F.col("lang") == "de", F.concat(F.lit("doc-"), F.col("doc_id"))).alias("uid"),
        F.when(F.col("lang") == "fr", F.col("doc_id").cast("string")).alias("id"),
        F.array(message("user", F.col("text"))).alias("messages"),
        "doc_id",
        "lang",
        "source",
    )


REQUESTS_SQL = """(
    SELECT doc_id, lang, source, text,
           CASE WHEN lang = 'de' THEN 'doc-' || doc_id WHEN lang = 'fr' THEN CAST(doc_id AS VARCHAR)
                ELSE md5(text) END AS uid
    FROM documents)"""


# -- finished: requests whose document has a label ------------------------------------------


def finished_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id")
    return requests(spark, sf_dir).join(labels, "doc_id", "left_semi")


FINISHED_SQL = f"(SELECT uid FROM {REQUESTS_SQL} r WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = r.doc_id))"


# -- run log: events as log entries ------------------------------------------------------------


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    status = by_value("event_type", {"error": F.lit("error"), "signup": F.lit(None)}, F.lit("success"))
    return events.select(
        "event_id",
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("file_"), F.col("user_id")).alias("file"),
        F.col("event_id").cast("string").alias("item_id"),
        status.alias("status"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("score"),
    )


LOG_SQL = """(
    SELECT event_id, ts AS timestamp, 'file_' || user_id AS file, CAST(event_id AS VARCHAR) AS item_id,
           CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN NULL ELSE 'success' END AS status,
           CASE WHEN event_type <> 'error' THEN value END AS score
    FROM events)"""


# -- replies: events as model replies of several forms -----------------------------------------


def model_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    props = F.col("props")
    rest = F.substring(props, F.lit(2), F.length(props))
    reply = by_value(
        "event_type",
        {
            "click": F.concat(F.lit('{"score": "4", "extra": [1, 2], '), rest),
            "view": F.concat(F.lit("Here it is: "), F.lit('{"score": null, '), rest, F.lit(" as asked.")),
            "signup": F.concat(F.lit("Note {a}.\n```json\n"), props, F.lit("\n```")),
            "purchase": F.concat(props, F.lit(" and "), props),
        },
        F.lit("no object here"),
    )
    return events.select("event_id", "event_type", reply.alias("reply"))


# -- conversations read off documents: one turn per line -----------------------------------------


def line_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a text as turns: human and gpt by turns, the first a system turn in some languages."""
    docs = table(spark, sf_dir, "documents")
    speaker = F.expr(
        "transform(split(text, '\\n'), (x, i) -> struct("
        "CASE WHEN i = 0 AND lang = 'fr' THEN 'system' WHEN i % 2 = 0 THEN 'human' ELSE 'gpt' END AS `from`, "
        "x AS value))"
    )
    return docs.select("doc_id", "lang", "source", speaker.alias("conversations"))


# Kept turns as text, with the roles they end up with; DuckDB lambdas count from 1.
TURNS_SQL = """list_filter(list_transform(string_split(text, chr(10)), lambda x, i:
    {'role': CASE WHEN i = 1 AND lang = 'fr' THEN 'system' WHEN i % 2 = 1 THEN 'user' ELSE 'assistant' END,
     'content': x}), lambda t: KEEP)"""


def rendered(messages: Column | str) -> Column:
    """Messages as one comparable text."""
    return F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n")


def rendered_sql(messages: str) -> str:
    return f"array_to_string(list_transform({messages}, lambda t: t.role || ': ' || t.content), chr(10))"


TOKENS_SQL = f"regexp_extract_all(text, '{WORD_PATTERN}')"


# -- package texts built from documents -----------------------------------------------------------


def packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    digest = F.substring(F.md5(F.col("text").cast("binary")), 1, 8)
    kind = F.when(F.col("lang") == "de", F.lit(".cxml")).otherwise(F.lit(".xml"))
    plain = F.concat(F.lit("plain"), F.col("doc_id"), F.lit(".xml"))
    named = F.concat("source", F.lit("_doc"), "doc_id", F.lit("_"), digest, kind)
    file_name = F.when(F.col("lang") == "es", plain).otherwise(named)
    extra = F.when(
        F.col("lang") == "de",
        F.lit('<file path=".gitignore">*.pyc</file>\n<file path="docs/LICENSE.txt">free\nfor all</file>\n'),
    ).otherwise(F.lit(""))
    section = F.concat(
        F.lit('<files>\n<file path="src/main.py">\n'), F.col("text"), F.lit('\n</file>\n<file path="README.MD">'),
        F.col("source"), F.lit("</file>\n"), extra, F.lit("</files>"),
    )
    content = F.concat(
        F.lit("Package of "), "source", F.lit("\n"), F.when(F.col("lang") == "fr", F.col("text")).otherwise(section)
    )
    return docs.select(
        "doc_id",
        F.concat(F.lit("/packages/"), "lang", F.lit("/"), file_name).alias("path"),
        file_name.alias("file_name"),
        F.col("lang").alias("language"),
        content.alias("content"),
    )


PACKAGES_SQL = """(
    SELECT doc_id, '/packages/' || lang || '/' || file_name AS path, file_name, lang AS language,
           'Package of ' || source || chr(10) || CASE WHEN lang = 'fr' THEN text ELSE
             '<files>' || chr(10) || '<file path="src/main.py">' || chr(10) || text || chr(10) || '</file>' || chr(10)
             || '<file path="README.MD">' || source || '</file>' || chr(10)
             || CASE WHEN lang = 'de' THEN '<file path=".gitignore">*.pyc</file>' || chr(10)
                || '<file path="docs/LICENSE.txt">free' || chr(10) || 'for all</file>' || chr(10) ELSE '' END
             || '</files>' END AS content
    FROM (SELECT *, CASE WHEN lang = 'es' THEN 'plain' || doc_id || '.xml' ELSE
              source || '_doc' || doc_id || '_' || substr(md5(text), 1, 8)
              || CASE WHEN lang = 'de' THEN '.cxml' ELSE '.xml' END END AS file_name FROM documents))"""
