"""Queries that run whole jobs."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from millrace.catalog import Entry
from millrace.catalog.files import DOC_SCHEMA
from millrace.catalog.inputs import (
    FINISHED_SQL,
    LOG_SQL,
    PACKAGES_SQL,
    REQUESTS_SQL,
    TOKENS_SQL,
    finished_requests,
    packages,
    rendered,
    requests,
    run_log,
    table,
)
from millrace.catalog.replies import CONTRACT_SCORE, NO_WAIT, count_reply
from millrace.catalog.sets import CHUNKS, GROUPS, MODELS
from millrace.functions.chatml import message
from millrace.operators.filters import require_fields
from millrace.plans import conversations, generation, preprocess, reports as report_plans, scoring
from millrace.session import new_stage_path
from millrace.sources.jsonl import read_strict, read_tolerant, write_jsonl
from millrace.sources.listing import file_path, triplet_language

CONFIG = {
    "source_name": "crawl",
    "field_mapping": {
        "id": {"type": "combine", "fields": ["lang", "doc_id"], "separator": "-"},
        "origin": {"type": "constant", "value": "web"},
        "label": {"type": "combine", "fields": ["lang", "source"], "separator": "-"},
    },
    "filters": {"min_text_length": 50, "max_text_length": 100000, "required_fields": ["text", "source"],
                "blacklist_patterns": ["license"]},
    "transformations": {
        "text_cleaning": {"remove_extra_whitespace": True, "remove_characters": ["%%%", "***"]},
        "computed_fields": {
            "n_text": {"type": "text_length", "source_field": "text"},
            "n_tokens": {"type": "token_count", "source_field": "text"},
        },
    },
}
TASK = scoring.ScoringTask(template="{text}", contract=CONTRACT_SCORE)


def _docs(spark, sf):
    return table(spark, sf, "documents")


def _score_job(spark, sf):
    source, target = new_stage_path(spark, "in"), new_stage_path(spark, "out")
    write_jsonl(_docs(spark, sf), source)
    rows = preprocess.score_length(read_strict(spark, source, DOC_SCHEMA))
    write_jsonl(rows, target)
    return read_strict(spark, target, DOC_SCHEMA + ", score double").select("doc_id", "text", "score")


def _universal(spark, sf):
    rows = preprocess.universal(_docs(spark, sf), CONFIG, max_tokens=1024)
    return rows.select(
        "id", "text", "origin", "label", "source", "content_truncate_1k",
        *[F.col(c).cast("bigint").alias(c) for c in ("n_text", "n_tokens")],
    )


def _raw_code(spark, sf):
    rows = preprocess.raw_code(_docs(spark, sf).drop("source").withColumnRenamed("text", "code"), max_tokens=1024)
    return rows.select("doc_id", "text", "source", "content_truncate_1k", F.length("id").cast("bigint").alias("id_length"))


def _base_rows(spark, sf):
    rows = preprocess.base_rows(_docs(spark, sf).withColumnRenamed("text", "body"), max_tokens=1024)
    return rows.select("doc_id", "body_truncate_1k", F.length("id").cast("bigint").alias("id_length"))


def _by_kind(spark, sf):
    """The same rows through two preprocessors chosen by name."""
    parts = []
    for kind in ("universal", "github_raw_code"):
        options = {"config": {"source_name": "crawl"}} if kind == "universal" else {}
        rows = preprocess.preprocessor(kind)(_docs(spark, sf).drop("source"), max_tokens=1024, **options)
        parts.append(rows.select("doc_id", "source", F.length("text").cast("bigint").alias("n"), F.lit(kind).alias("kind")))
    return parts[0].unionByName(parts[1])


def _packages(spark, sf):
    rows = preprocess.packaged_repositories(packages(spark, sf))
    return rows.groupBy("language", "packaging_tool").agg(
        F.count(F.lit(1)).alias("n_repos"),
        F.sum("files_with_content").alias("n_files"),
        F.sum("total_lines").alias("n_lines"),
        F.count_if("has_license").alias("n_licensed"),
    )


def _triplets(spark, sf):
    """Triplet files by language, written, read with bad lines skipped, preprocessed."""
    path = new_stage_path(spark, "triplets")
    name = F.concat(F.lit("pt_data_"), "lang", F.lit("_part01.jsonl"))
    write_jsonl(_docs(spark, sf).select("doc_id", "text", F.col("lang").alias("lg"), name.alias("name")), path, ["name"])
    schema = T.StructType.fromDDL("doc_id bigint, text string, lg string")
    rows = read_tolerant(spark, f"{path}/*/*.json", schema, keep_file=True)
    file_language = triplet_language(F.regexp_extract("file_path", "/name=([^/]+)/", 1))
    rows = preprocess.triplets(rows.withColumn("file_language", file_language).drop("file_name", "file_path"), max_tokens=1024)
    return rows.select("doc_id", "file_language", "language", "repo_full_name", "has_readme", "content_truncate_1k")


def _rows_to_score(spark, sf):
    docs = _docs(spark, sf)
    return docs.select(F.col("doc_id").cast("string").alias("id"), "doc_id", "text", F.col("source").alias("source_file"))


def _done_scores(spark, sf):
    labels = table(spark, sf, "labels")
    status = F.when(F.col("quality") == 1, F.lit("success")).otherwise(F.lit("error"))
    return labels.select(
        F.col("doc_id").cast("string").alias("id"), "doc_id", status.alias("api_status"), F.lit(5).cast("bigint").alias("score")
    )


def _scored(spark, sf):
    rows = scoring.score_with_resume(_rows_to_score(spark, sf), TASK, count_reply, _done_scores(spark, sf), policy=NO_WAIT)
    reason = F.substring_index("api_fail_reason", ":", 1)
    return rows.select(
        "doc_id", "api_status", "score", "error_kind", F.nullif(reason, F.lit("")).alias("reason"),
    )


def _score_columns(spark, sf):
    rows = scoring.score_rows(_rows_to_score(spark, sf), TASK, count_reply, NO_WAIT)
    return rows.select("doc_id", "text", "api_status", "score", F.col("api_return"), F.col("api_attempts").cast("bigint").alias("api_attempts"))


def _file_rates(spark, sf):
    rows = scoring.scoring_stats(scoring.score_rows(_rows_to_score(spark, sf), TASK, count_reply, NO_WAIT))
    return rows.withColumn("success_rate", F.round("success_rate", 6))


def _chat(spark, sf):
    """Two dataset layouts read from files, converted in one table."""
    root = new_stage_path(spark, "chat")
    docs = _docs(spark, sf)
    docs.select("doc_id", F.col("source").alias("instruction"), F.col("text").alias("output")).write.parquet(
        f"{root}/org/pairs/web/train.parquet"
    )
    docs.select("doc_id", F.when(F.col("lang") != "es", F.col("text")).alias("prompt_text")).write.json(f"{root}/bare.jsonl")
    datasets = {
        "org/pairs": {
            "configs": ["web"],
            "format_style": "prompt_response",
            "column_mapping": {"prompt": "instruction", "response": "output"},
        },
        "bare.jsonl": {
            "configs": [None],
            "format_style": "prompt_text_only",
            "column_mapping": {"prompt_text": "prompt_text"},
        },
    }
    schemas = {
        "org/pairs": T.StructType.fromDDL("doc_id bigint, instruction string, output string"),
        "bare.jsonl": T.StructType.fromDDL("doc_id bigint, prompt_text string"),
    }
    rows = conversations.convert_datasets(spark, root, datasets, schemas=schemas, add_system_prompt=True, system_prompt="S")
    doc_id = F.get_json_object("raw_data", "$.doc_id").cast("bigint").alias("doc_id")
    return rows.select(doc_id, rendered("messages").alias("chat"), "output_file", "format")


def _all_splits(spark, sf):
    """One dataset: a split in shards of two formats, some below data/, and a second one whose name begins with the first one's."""
    root = new_stage_path(spark, "splits")
    docs = _docs(spark, sf).select("doc_id", "lang", F.col("text").alias("prompt_text"))
    lang = F.coalesce("lang", F.lit(""))
    docs.filter(lang == "en").write.parquet(f"{root}/org/docs/train-0.parquet")
    odd = F.coalesce(F.col("doc_id") % 2 != 0, F.lit(False))
    docs.filter((lang == "de") & odd).write.json(f"{root}/org/docs/train-1.jsonl")
    docs.filter((lang == "de") & ~odd).write.parquet(f"{root}/org/docs/data/train-00002-of-00003.parquet")
    docs.filter(~lang.isin("en", "de")).write.json(f"{root}/org/docs/data/train_extra-00000-of-00001.json")
    mapping = {"prompt_text": "prompt_text"}
    datasets = {"org/docs": {"configs": [None], "format_style": "prompt_text_only", "column_mapping": mapping}}
    schemas = {"org/docs": T.StructType.fromDDL("doc_id bigint, lang string, prompt_text string")}
    rows = conversations.convert_datasets(spark, root, datasets, schemas=schemas)
    doc_id = F.get_json_object("raw_data", "$.doc_id").cast("bigint").alias("doc_id")
    return rows.select(doc_id, "split", rendered("messages").alias("chat"))


def _in_two_runs(spark, sf):
    """The universal job on files: a run limited to one file, then a run that finds the others."""
    folder = new_stage_path(spark, "raw")
    _docs(spark, sf).repartition(4).write.parquet(folder)

    def read(paths):
        return spark.read.parquet(*paths).withColumn("source_path", file_path())

    def run(**options):
        job = lambda rows: preprocess.universal(rows, CONFIG, max_tokens=1024)
        return preprocess.preprocess_files(spark, folder, new_stage_path(spark, "ready"), read, job, **options)

    first, stats = run(limit=1)
    second, _ = run(stats=stats)
    return first.unionByName(second).select("id", "text", "source", "content_truncate_1k")


def _merged(spark, sf):
    """Merge groups of JSON-lines files written per source."""
    root = new_stage_path(spark, "collections")
    name = F.concat("source", F.lit(".jsonl"))
    write_jsonl(_docs(spark, sf).select("doc_id", "text", name.alias("name")), root, ["name"])
    groups = [{**g, "input_files": [f"name={f}" for f in g["input_files"]]} for g in GROUPS]
    schema = T.StructType.fromDDL("doc_id bigint, text string")
    return conversations.merge_collections(spark, root, groups, schema).select("doc_id", "text", "group", "output_file")


def _generated(spark, sf):
    rows = generation.generate(requests(spark, sf), count_reply, NO_WAIT, done=finished_requests(spark, sf))
    return rows.select(
        "doc_id", "uid", "status", "response", rendered("final_messages").alias("chat"), F.col("error_type").alias("kind")
    )


def _retried(spark, sf):
    """A first run with failures, then a retry that answers every row."""
    first = generation.generate(requests(spark, sf), count_reply_or_fail, NO_WAIT)
    merged, left = generation.retry_failed(
        generation.error_rows(first), generation.success_rows(first), count_reply_always, NO_WAIT, order=("doc_id",)
    )
    return merged.select("doc_id", "uid", "response").unionByName(left.select("doc_id", "uid", F.lit(None).cast("string").alias("response")))


def _failed(spark, sf):
    results = generation.generate(requests(spark, sf), count_reply_or_fail, NO_WAIT)
    rows = generation.error_rows(results)
    whole = F.col("traceback").contains("TimeoutError") & F.col("timestamp").isNotNull() & F.col("task_index").isNotNull()
    return rows.select("doc_id", "uid", rendered("messages").alias("chat"), "error", "error_type", whole.alias("whole"))


def _hooks(spark, sf):
    """A chain of row steps: one that drops rows, the plain preprocessor, one of the user's own."""
    rows = (
        _docs(spark, sf)
        .transform(require_fields, ["text", "source"])
        .transform(preprocess.base_rows, max_tokens=1024)
        .transform(lambda df: df.withColumn("shout", F.upper("lang")))
    )
    return rows.select("doc_id", "text_truncate_1k", "shout")


def count_reply_or_fail(messages, chat):
    text = messages[-1]["content"]
    if text.startswith("De"):
        raise TimeoutError("no answer")
    return f"first {len(text)}"


def count_reply_always(messages, chat):
    return f"again {len(messages[-1]['content'])}"


def model_reply(messages, chat):
    text = messages[-1]["content"]
    if chat["model"] == "beta" and text.startswith("De"):
        raise TimeoutError("no answer")
    return f"{chat['model']} {len(text)}"


def _fanned_out(spark, sf):
    work = generation.fan_out(requests(spark, sf), MODELS, ["doc_id"], CHUNKS, "docs")
    results = generation.generate(work, model_reply, NO_WAIT, model_column="model")
    out = generation.model_summary(results)
    return out.withColumn("success_rate", F.round("success_rate", 6))


def _report(spark, sf):
    parts = report_plans.log_report(run_log(spark, sf))
    scores = parts["scores"].select(F.lit("scores").alias("part"), F.lit("median").alias("name"), F.round("median", 6).alias("value"))
    statuses = parts["statuses"].select(F.lit("statuses").alias("part"), F.col("status").alias("name"), F.col("n").cast("double").alias("value"))
    files = parts["files"].select(F.lit("files").alias("part"), F.col("file").alias("name"), F.col("n").cast("double").alias("value"))
    totals = parts["totals"].select(F.lit("totals").alias("part"), F.lit("success_rate").alias("name"), F.round("success_rate", 6).alias("value"))
    return scores.unionByName(statuses).unionByName(files).unionByName(totals)


def _profile(spark, sf):
    """Fields of each event's JSON line, by type and event type."""
    events = table(spark, sf, "events")
    line = F.to_json(F.struct("event_id", "event_type", "value", F.from_json("props", "k int").alias("props")))
    return report_plans.field_profile(events.select(F.col("event_type").alias("file_name"), line.alias("line")))


_CUT = f"CASE WHEN length(text) > 20000 THEN array_to_string(list_slice({TOKENS_SQL}, 1, 1024), '') ELSE text END"
_PENDING_SQL = f"{REQUESTS_SQL} r WHERE NOT EXISTS (SELECT 1 FROM {FINISHED_SQL} f WHERE f.uid = r.uid)"
_FAILS = "(starts_with(text, 'De') OR starts_with(text, 'A'))"
_REPLY = """'{"score": "' || (length(text) % 5 + 1) || '", "length": ' || length(text) || '}'"""
_KIND = "CASE WHEN starts_with(text, 'De') THEN 'call' WHEN starts_with(text, 'A') THEN 'format' END"
_GROUP_VALUES = ", ".join(
    f"('{g['name']}', '{g['output_file']}', '{f[:-6]}')" for g in GROUPS for f in g["input_files"]
)

ENTRIES = {
    "jb1": Entry(
        _score_job,
        "SELECT doc_id, text, least(5.0, greatest(0.0, length(text) / 100.0))::DOUBLE AS score FROM documents",
    ),
    "jb2": Entry(
        _universal,
        f"""SELECT id, text, 'web' AS origin, label, source, {_CUT} AS content_truncate_1k, length(text) AS n_text,
                   len({TOKENS_SQL}) AS n_tokens
            FROM (SELECT lang || CASE WHEN doc_id <> 0 THEN '-' || doc_id ELSE '' END AS id, lang || '-' || source AS label,
                         source, replace(replace(trim(regexp_replace(text, '\\s+', ' ', 'g')), '%%%', ''), '***', '') AS text
                  FROM documents WHERE length(text) BETWEEN 50 AND 100000 AND NOT contains(lower(text), 'license'))""",
    ),
    "jb2_files": Entry(
        _in_two_runs,
        f"""SELECT lang || CASE WHEN doc_id <> 0 THEN '-' || doc_id ELSE '' END AS id, cleaned AS text, source,
                   {_CUT.replace("text", "cleaned")} AS content_truncate_1k
            FROM (SELECT *, replace(replace(trim(regexp_replace(text, '\\s+', ' ', 'g')), '%%%', ''), '***', '') AS cleaned
                  FROM documents WHERE length(text) BETWEEN 50 AND 100000 AND NOT contains(lower(text), 'license'))""",
    ),
    "jb3": Entry(
        _raw_code,
        f"""SELECT doc_id, text, 'github_raw_code' AS source, {_CUT} AS content_truncate_1k, 64::BIGINT AS id_length
            FROM documents""",
    ),
    "jb3_plain": Entry(
        _base_rows,
        f"SELECT doc_id, {_CUT} AS body_truncate_1k, 64::BIGINT AS id_length FROM documents",
    ),
    "jb4": Entry(
        _packages,
        f"""SELECT language, CASE language WHEN 'es' THEN 'unknown' WHEN 'de' THEN 'rendergit' ELSE 'repomix' END
                       AS packaging_tool, count(*) AS n_repos,
                   sum(CASE WHEN language = 'de' THEN 4 ELSE 2 END)::BIGINT AS n_files,
                   sum(lines)::BIGINT AS n_lines, count(*) FILTER (language = 'de') AS n_licensed
            FROM (SELECT p.language, len(string_split(d.text, chr(10))) + 2 + 1
                         + CASE WHEN p.language = 'de' THEN 3 ELSE 0 END AS lines
                  FROM {PACKAGES_SQL} p JOIN documents d USING (doc_id) WHERE p.language <> 'fr') GROUP BY 1, 2""",
    ),
    "jb5": Entry(
        _triplets,
        f"""SELECT doc_id, lang AS file_language, lang AS language, 'Code Repository' AS repo_full_name,
                   'Unknown' AS has_readme, {_CUT} AS content_truncate_1k FROM documents""",
    ),
    "jb6": Entry(
        _scored,
        f"""SELECT doc_id, 'success' AS api_status, 5::BIGINT AS score, NULL::VARCHAR AS error_kind, NULL::VARCHAR AS reason
            FROM labels WHERE quality = 1 UNION ALL
            SELECT doc_id, CASE WHEN {_FAILS} THEN 'error' ELSE 'success' END,
                   CASE WHEN {_FAILS} THEN 3 ELSE length(text) % 5 + 1 END::BIGINT, {_KIND},
                   CASE WHEN starts_with(text, 'De') THEN 'API call failed after all retries'
                        WHEN starts_with(text, 'A') THEN 'JSON format validation failed after all retries' END
            FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND quality = 1)""",
    ),
    "pr14": Entry(
        _score_columns,
        f"""SELECT doc_id, text, CASE WHEN {_FAILS} THEN 'error' ELSE 'success' END AS api_status,
                   CASE WHEN {_FAILS} THEN 3 ELSE length(text) % 5 + 1 END::BIGINT AS score,
                   CASE WHEN starts_with(text, 'De') THEN '' WHEN starts_with(text, 'A') THEN 'about ' || length(text)
                        ELSE {_REPLY} END AS api_return,
                   CASE WHEN {_FAILS} THEN 3 ELSE 1 END::BIGINT AS api_attempts FROM documents""",
    ),
    "jb6_stats": Entry(
        _file_rates,
        f"""SELECT source AS source_file, count(*) AS n_rows, count(*) FILTER (NOT {_FAILS}) AS n_success,
                   round(100.0 * count(*) FILTER (NOT {_FAILS}) / count(*), 6)::DOUBLE AS success_rate
            FROM documents GROUP BY source""",
    ),
    "jb7": Entry(
        _chat,
        """SELECT doc_id, 'system: S' || chr(10) || 'user: ' || source || chr(10) || 'assistant: ' || text AS chat,
                  'pairs/org_pairs-web-train-with_system.jsonl' AS output_file, 'chatml' AS format FROM documents
           UNION ALL SELECT doc_id, 'system: S' || chr(10) || 'user: ' || text,
                  'bare/bare-train-with_system.jsonl', 'chatml' FROM documents WHERE lang <> 'es'""",
    ),
    "jb7_splits": Entry(
        _all_splits,
        """SELECT doc_id, CASE WHEN lang IN ('en', 'de') THEN 'train' ELSE 'train_extra' END AS split, 'user: ' || text AS chat
           FROM documents""",
    ),
    "jb8": Entry(
        _merged,
        f"""SELECT doc_id, text, g AS "group", output_file FROM documents
            JOIN (VALUES {_GROUP_VALUES}) v(g, output_file, src) ON src = source""",
    ),
    "jb9": Entry(
        _generated,
        f"""SELECT doc_id, uid, CASE WHEN starts_with(text, 'De') THEN 'error' ELSE 'success' END AS status, response,
                   'user: ' || text || chr(10) || 'assistant: ' || response AS chat,
                   CASE WHEN starts_with(text, 'De') THEN 'call' END AS kind
            FROM (SELECT *, CASE WHEN starts_with(text, 'De') THEN NULL
                                 WHEN starts_with(text, 'A') THEN 'about ' || length(text) ELSE {_REPLY} END AS response
                  FROM {_PENDING_SQL})""",
    ),
    "jb10": Entry(
        _retried,
        f"""SELECT doc_id, uid, 'first ' || length(text) AS response FROM {REQUESTS_SQL} WHERE NOT starts_with(text, 'De')
            UNION ALL SELECT min(doc_id), uid, 'again ' || min(length(text)) FROM {REQUESTS_SQL}
            WHERE starts_with(text, 'De') GROUP BY uid""",
    ),
    "jb11": Entry(
        _fanned_out,
        """SELECT m AS model, least(7, ceil(n / ceil(n / 7.0)))::BIGINT AS total_files, n - bad AS success_count,
                  bad AS error_count, round(100.0 * (n - bad) / n, 6)::DOUBLE AS success_rate
           FROM (SELECT m, count(*) AS n, count(*) FILTER (m = 'beta' AND starts_with(text, 'De')) AS bad
                 FROM documents, (VALUES ('alpha'), ('beta'), ('gamma')) v(m) GROUP BY m)""",
    ),
    "jb12": Entry(
        _report,
        f"""SELECT 'scores' AS part, 'median' AS name, round(median(score), 6) AS value FROM {LOG_SQL}
            UNION ALL SELECT 'statuses', status, count(*) FROM {LOG_SQL} WHERE status IS NOT NULL GROUP BY status
            UNION ALL (SELECT 'files', file, count(*) AS n FROM {LOG_SQL} GROUP BY file ORDER BY n DESC, file LIMIT 10)
            UNION ALL SELECT 'totals', 'success_rate',
                round(100.0 * count(*) FILTER (status = 'success') / count(*), 6) FROM {LOG_SQL}""",
    ),
    "jb13": Entry(
        _profile,
        """SELECT event_type AS file_name, field, type, count(*) AS n_rows FROM events,
               (VALUES ('event_id', 'bigint'), ('event_type', 'string'), ('value', 'decimal'), ('props', 'object')) v(field, type)
           GROUP BY event_type, field, type""",
    ),
    "ud1": Entry(
        lambda spark, sf: _docs(spark, sf).transform(preprocess.score_length).select("doc_id", "score"),
        "SELECT doc_id, least(5.0, greatest(0.0, length(text) / 100.0))::DOUBLE AS score FROM documents",
    ),
    "pr13": Entry(
        _failed,
        f"""SELECT doc_id, uid, 'user: ' || text AS chat, 'TimeoutError: no answer' AS error, 'call' AS error_type,
                   true AS whole FROM {REQUESTS_SQL} WHERE starts_with(text, 'De')""",
    ),
    "ud2": Entry(
        _hooks,
        f"SELECT doc_id, {_CUT} AS text_truncate_1k, upper(lang) AS shout FROM documents WHERE text <> '' AND source <> ''",
    ),
    "ud3": Entry(
        _by_kind,
        """SELECT doc_id, 'crawl' AS source, length(text) AS n, 'universal' AS kind FROM documents UNION ALL
           SELECT doc_id, 'github_raw_code', length(text), 'github_raw_code' FROM documents""",
    ),
}
