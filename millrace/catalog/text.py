"""Queries for string, token, hash and reasoning-text columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import Entry
from millrace.catalog.inputs import REQUESTS_SQL, TOKENS_SQL, by_value, requests, table
from millrace.functions import text as tx, think
from millrace.functions.identity import stable_uid
from millrace.functions.tokens import GATE_CHARS, WORD_PATTERN, PatternTokenizer, RankTokenizer, truncate_text
from millrace.sources.naming import run_path

JUNK = ["%%%", "***", "###"]
TOKEN_LIMIT = 1024
#: A vocabulary that SQL can count with: each byte, and one pair.
_PAIR_RANKS = {bytes([b]): b for b in range(256)} | {b"th": 256}


def _docs(columns):
    return lambda spark, sf: table(spark, sf, "documents").select("doc_id", *columns())


def _pages(columns):
    return lambda spark, sf: table(spark, sf, "pages").select("page_id", *columns())


def _thinking(spark, sf):
    docs = table(spark, sf, "documents")
    reasoning = by_value("lang", {"en": F.col("source"), "de": F.lit(" \n\t")}, F.lit(None).cast("string"))
    content = by_value("lang", {"fr": F.lit(None).cast("string"), "de": F.lit("")}, F.col("text"))
    return docs.select("doc_id", think.join_reasoning(reasoning, content).alias("reply"))


def _blocks(spark, sf):
    docs = table(spark, sf, "documents")
    reply = F.concat(
        F.lit("<think>\n"), "source", F.lit("\n</think>\n\n"), "text", F.lit("<think>"), "lang", F.lit("</think>")
    )
    reply = by_value("lang", {"es": F.col("text"), "fr": F.concat(F.lit("<think>"), "text")}, reply)
    return docs.select("doc_id", reply.alias("reply")).select(
        "doc_id",
        F.size(think.think_blocks("reply")).cast("bigint").alias("n_blocks"),
        F.array_join(think.think_blocks("reply"), "|").alias("blocks"),
        think.has_think("reply").alias("has_think"),
        think.visible_text("reply").alias("visible"),
    )


def _run_paths(spark, sf):
    docs = table(spark, sf, "documents")
    template = F.lit("out/{task_name}/{timestamp}/run_{run_index}/{other}")
    path = run_path(template, F.col("source"), F.lit("20250101_000000"), F.col("doc_id"))
    return docs.select("doc_id", path.alias("path"))


_WS = "'[\\t\\n\\v\\f\\r\\x1c-\\x1f \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+'"

ENTRIES = {
    "st1": Entry(
        _docs(lambda: [tx.length_score("text").alias("score")]),
        "SELECT doc_id, least(5.0, greatest(0.0, length(text) / 100.0))::DOUBLE AS score FROM documents",
    ),
    "st2": Entry(
        _docs(lambda: [tx.collapse_whitespace("text").alias("text")]),
        f"SELECT doc_id, trim(regexp_replace(text, {_WS}, ' ', 'g')) AS text FROM documents",
    ),
    "st3": Entry(
        _pages(lambda: [tx.remove_literals("html", JUNK).alias("html")]),
        "SELECT page_id, replace(replace(replace(html, '%%%', ''), '***', ''), '###', '') AS html FROM pages",
    ),
    "st4": Entry(
        _docs(lambda: [F.length("text").cast("bigint").alias("text_length")]),
        "SELECT doc_id, length(text) AS text_length FROM documents",
    ),
    "st5": Entry(
        _docs(lambda: [truncate_text("text", PatternTokenizer(), TOKEN_LIMIT).alias("text")]),
        f"""SELECT doc_id, CASE WHEN length(text) > {GATE_CHARS}
            THEN array_to_string(list_slice({TOKENS_SQL}, 1, {TOKEN_LIMIT}), '') ELSE text END AS text FROM documents""",
    ),
    "st6": Entry(
        _docs(lambda: [PatternTokenizer().count("text").cast("bigint").alias("n_tokens")]),
        f"SELECT doc_id, len({TOKENS_SQL}) AS n_tokens FROM documents",
    ),
    "st6_ranks": Entry(
        _docs(lambda: [RankTokenizer(_PAIR_RANKS, WORD_PATTERN).count("text").cast("bigint").alias("n_tokens")]),
        """SELECT doc_id, octet_length(encode(text)) - (length(text) - length(replace(text, 'th', ''))) // 2 AS n_tokens
           FROM documents""",
    ),
    "st7": Entry(
        lambda spark, sf: (lambda r: r.select("doc_id", stable_uid(r).alias("uid")))(requests(spark, sf)),
        f"SELECT doc_id, uid FROM {REQUESTS_SQL}",
    ),
    "st11": Entry(
        _pages(lambda: [tx.path_extension("url").alias("extension")]),
        r"""SELECT page_id, lower(regexp_extract(url, '^(?:(?s:.*)/)?\.*[^/.][^/]*?(\.[^./]*)$', 1)) AS extension
            FROM pages""",
    ),
    "st12": Entry(
        _docs(
            lambda: [
                tx.line_count("text").cast("bigint").alias("n_lines"),
                tx.average_line_length("text").alias("avg_line_length"),
            ]
        ),
        """SELECT doc_id, len(string_split(text, chr(10))) AS n_lines,
                  length(text) / len(string_split(text, chr(10)))::DOUBLE AS avg_line_length FROM documents""",
    ),
    "st20": Entry(
        _thinking,
        """SELECT doc_id, CASE lang
               WHEN 'en' THEN '<think>' || chr(10) || source || chr(10) || '</think>' || chr(10) || chr(10) || text
               WHEN 'de' THEN ' ' || chr(10) || chr(9) WHEN 'fr' THEN '' ELSE text END AS reply FROM documents""",
    ),
    "st21": Entry(
        _blocks,
        """SELECT doc_id, CASE WHEN lang IN ('es', 'fr') THEN 0 ELSE 2 END::BIGINT AS n_blocks,
                  CASE WHEN lang IN ('es', 'fr') THEN '' ELSE source || '|' || lang END AS blocks,
                  lang NOT IN ('es', 'fr') AS has_think,
                  CASE lang WHEN 'es' THEN text WHEN 'fr' THEN '<think>' || text
                       ELSE ltrim(text, chr(10)) || '<think>' || lang || '</think>' END AS visible
           FROM documents""",
    ),
    "st30": Entry(
        _run_paths,
        "SELECT doc_id, 'out/' || source || '/20250101_000000/run_' || doc_id || '/{other}' AS path FROM documents",
    ),
}
