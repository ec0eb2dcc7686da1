"""Queries for chat records, prompts and messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import Entry
from millrace.catalog.inputs import TURNS_SQL, by_value, line_conversations, rendered, rendered_sql, table
from millrace.functions import chatml
from millrace.functions.templates import prompt_messages, render_prompt
from millrace.operators.filters import selected, with_messages
from millrace.plans.conversations import to_chat
from millrace.sources.naming import chat_file_name

SYSTEM = "You are careful."
_KEPT = TURNS_SQL.replace("KEEP", "t.content <> '' AND t.role <> 'system'")
_ALL = TURNS_SQL.replace("KEEP", "true")


def _rendered(frame, style, mapping, **options):
    records = to_chat(frame, style, mapping, keep_raw=False, keep=["doc_id"], **options)
    return records.select("doc_id", rendered("messages").alias("chat"))


def _instructions(spark, sf):
    docs = table(spark, sf, "documents")
    blank = F.concat(F.lit("  "), "source")
    return docs.select(
        "doc_id",
        by_value("lang", {"de": blank}, F.col("source")).alias("instruction"),
        by_value("lang", {"en": F.concat(F.col("lang"), F.lit(" \n ")), "fr": F.lit("")}, F.lit(None).cast("string")).alias("input"),
        by_value("lang", {"es": F.lit("")}, F.col("text")).alias("output"),
    )


def _as_messages(spark, sf):
    turns = F.transform(
        "conversations",
        lambda t: F.struct(
            by_role(t["from"]).alias("role"), t["value"].alias("content"), F.length(t["value"]).alias("weight")
        ),
    )
    return line_conversations(spark, sf).select("doc_id", "source", turns.alias("messages"))


def by_role(speaker):
    return F.when(speaker == "human", F.lit("user")).when(speaker == "gpt", F.lit("assistant")).otherwise(speaker)


def _with_system(spark, sf):
    records = _as_messages(spark, sf)
    return records.select("doc_id", rendered(chatml.add_system(F.col("messages"), SYSTEM)).alias("chat"))


def _asked(mode):
    def run(spark, sf):
        asked = chatml.request_messages(F.col("messages"), mode)
        return _as_messages(spark, sf).select("doc_id", rendered(asked).alias("chat"))

    return run


def _final(spark, sf):
    docs = table(spark, sf, "documents")
    turns = chatml.final_messages(F.col("text"), F.concat("source", F.lit("/"), "lang"))
    return docs.select("doc_id", rendered(turns).alias("chat"))


def _raw(spark, sf):
    docs = table(spark, sf, "documents")
    records = to_chat(docs, "prompt_response", {"prompt": "text", "response": "source"}, keep=["doc_id"])
    fields = ["text", "lang", "source", "n_chars"]
    return records.select("doc_id", "format", *[F.get_json_object("raw_data", f"$.{c}").alias(c) for c in fields])


TEMPLATE = "Rate {sample} from {source} in {lang}.\nIt has {n_chars} characters; {text} again. Reply {{\"score\": n}}"


def _prompt(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", render_prompt(docs, TEMPLATE, "text", "sample").alias("prompt"))


_PROMPT_SQL = """'Rate ' || text || ' from ' || source || ' in ' || lang || '.' || chr(10) || 'It has ' || n_chars
    || ' characters; ' || text || ' again. Reply {"score": n}'"""


def _messages(spark, sf):
    docs = table(spark, sf, "documents")
    turns = prompt_messages(render_prompt(docs, TEMPLATE, "text", "sample"), SYSTEM)
    return docs.select("doc_id", rendered(turns).alias("chat"))


def _datasets(spark, sf):
    names = table(spark, sf, "documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n_rows"))
    dataset = F.concat(F.lit("org/"), "source", F.when(F.col("lang") == "es", F.lit(".jsonl")).otherwise(F.lit("")))
    config = F.when(F.col("lang") == "de", F.col("lang"))
    return names.select(
        "lang",
        "source",
        chat_file_name(dataset, config, F.lit("train")).alias("name"),
        chat_file_name(dataset, config, F.lit("train"), True).alias("system_name"),
        "n_rows",
    )


ENTRIES = {
    "st13": Entry(_prompt, f"SELECT doc_id, {_PROMPT_SQL} AS prompt FROM documents"),
    "st14": Entry(
        _messages,
        f"""SELECT doc_id, 'system: {SYSTEM}' || chr(10) || 'user: ' || {_PROMPT_SQL} AS chat FROM documents""",
    ),
    "st22": Entry(
        lambda spark, sf: _rendered(
            _instructions(spark, sf), "prompt_response", {"prompt": "instruction", "response": "output"}
        ),
        """SELECT doc_id, 'user: ' || CASE WHEN lang = 'de' THEN '  ' ELSE '' END || source || chr(10)
                  || 'assistant: ' || text AS chat FROM documents WHERE lang <> 'es'""",
    ),
    "st23": Entry(
        lambda spark, sf: _rendered(
            _instructions(spark, sf),
            "instruction_input",
            {"prompt": "instruction", "input": "input", "response": "output"},
        ),
        """SELECT doc_id, 'user: ' || CASE lang WHEN 'de' THEN '  ' || source
                     WHEN 'en' THEN source || chr(10) || chr(10) || 'en' ELSE source END || chr(10)
                  || 'assistant: ' || text AS chat FROM documents WHERE lang <> 'es'""",
    ),
    "st24": Entry(
        lambda spark, sf: _rendered(line_conversations(spark, sf), "sharegpt", {"conversations": "conversations"}),
        f"SELECT doc_id, {rendered_sql('m')} AS chat FROM (SELECT doc_id, {_KEPT} AS m FROM documents) WHERE len(m) > 0",
    ),
    "st25": Entry(
        lambda spark, sf: _rendered(_as_messages(spark, sf), "messages", {"messages": "messages"}),
        f"SELECT doc_id, {rendered_sql('m')} AS chat FROM (SELECT doc_id, {_ALL} AS m FROM documents)",
    ),
    "st26": Entry(
        lambda spark, sf: _rendered(
            _as_messages(spark, sf), "input_output_messages", {"input": "messages", "output": "source"}
        ),
        f"""SELECT doc_id, {rendered_sql('m')} || chr(10) || 'assistant: ' || source AS chat
            FROM (SELECT doc_id, source, {_ALL} AS m FROM documents)""",
    ),
    "st27": Entry(
        lambda spark, sf: _rendered(table(spark, sf, "documents"), "prompt_text_only", {"prompt_text": "text"}),
        "SELECT doc_id, 'user: ' || text AS chat FROM documents",
    ),
    "st28": Entry(
        _with_system,
        f"""SELECT doc_id, CASE WHEN lang = 'fr' THEN '' ELSE 'system: {SYSTEM}' || chr(10) END
                  || {rendered_sql('m')} AS chat FROM (SELECT doc_id, lang, {_ALL} AS m FROM documents)""",
    ),
    "st29": Entry(
        _asked("first_message"),
        "SELECT doc_id, 'user: ' || string_split(text, chr(10))[1] AS chat FROM documents",
    ),
    "pr11": Entry(
        _raw,
        """SELECT doc_id, 'chatml' AS format, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars
           FROM documents""",
    ),
    "pr12": Entry(
        _final,
        """SELECT doc_id, 'user: ' || text || chr(10) || 'assistant: ' || source || '/' || lang AS chat
           FROM documents""",
    ),
    "fl4": Entry(
        lambda spark, sf: with_messages(
            line_conversations(spark, sf).withColumn(
                "messages", F.filter("conversations", lambda t: (F.length(t["value"]) > 120) & (t["from"] != "system"))
            )
        ).select("doc_id"),
        """SELECT doc_id FROM (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x, i:
               length(x) > 120 AND NOT (i = 1 AND lang = 'fr')) AS m FROM documents) WHERE len(m) > 0""",
    ),
    "fl7": Entry(
        lambda spark, sf: selected(table(spark, sf, "documents"), "source", ["src1", "src7", "nowhere"]).select("doc_id"),
        "SELECT doc_id FROM documents WHERE source IN ('src1', 'src7', 'nowhere')",
    ),
    "ud4": Entry(
        lambda spark, sf: to_chat(
            table(spark, sf, "conversations"),
            "prompt_response",
            {"prompt": "text", "response": "role"},
            keep_raw=False,
            keep=["conv_id", "turn"],
        ).select("conv_id", "turn", rendered("messages").alias("chat")),
        "SELECT conv_id, turn, 'user: ' || text || chr(10) || 'assistant: ' || role AS chat FROM conversations",
    ),
    "io12": Entry(
        _datasets,
        """SELECT lang, source, source || '/org_' || source || CASE WHEN lang = 'de' THEN '-de' ELSE '' END
                  || '-train.jsonl' AS name,
                  source || '/org_' || source || CASE WHEN lang = 'de' THEN '-de' ELSE '' END
                  || '-train-with_system.jsonl' AS system_name, count(*) AS n_rows
           FROM documents GROUP BY lang, source""",
    ),
}
