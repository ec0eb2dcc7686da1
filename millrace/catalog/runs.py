"""Queries for runs that commit as they go, files that are held against their output, and packages read by blocks."""

from __future__ import annotations

from pyspark.sql import Window, functions as F, types as T

from millrace.catalog import Entry
from millrace.catalog.inputs import pieces, read_by_blocks, requests, table
from millrace.functions.packages import counts_json
from millrace.operators.calls import CallPolicy
from millrace.operators.unions import merge_shards
from millrace.plans import progress
from millrace.plans.committed import Flush, generate_committed
from millrace.plans.reports import nested_profile
from millrace.session import new_stage_path
from millrace.sources import listing
from millrace.sources.commits import CommitLog
from millrace.sources.package_scan import read_entries, repository_columns
from millrace.streaming import append_increments, read_increments, run_available

_DOC = T.StructType(
    [T.StructField("doc_id", T.LongType()), *[T.StructField(c, T.StringType()) for c in ("text", "lang", "source")], T.StructField("n_chars", T.LongType())]
)


def _docs(spark, sf):
    return table(spark, sf, "documents")


class _Killed(RuntimeError):
    """Ends a run in its middle."""


def _answer(messages, chat):
    text = messages[-1]["content"]
    if text.startswith("De"):
        raise ValueError("no")
    return f"{len(text)} characters"


def _committed(spark, sf):
    """Replies of a run that dies after its second commit and is started again."""
    rows = requests(spark, sf).withColumn("uid", F.concat(F.lit("row-"), "doc_id"))  # equal texts are rows of their own
    root = new_stage_path(spark, "committed")
    policy = CallPolicy(attempts=1, wait_factor=0.0, wait_min=0.0, total=64, adaptive=False)
    flush = Flush(rows=max(1, rows.count() // 5))
    left = [2]

    def die(entry):
        left[0] -= 1
        if not left[0]:
            raise _Killed

    try:
        generate_committed(rows, _answer, root, policy, flush, on_commit=die)
    except _Killed:
        pass
    replies = generate_committed(rows, _answer, root, policy, flush)
    return replies.select("doc_id", "uid", "response", "status")


def _by_language(spark, sf):
    """The documents in ranges of their language, as the files of a folder for each language: some 128 MB of the table a file."""
    n = pieces(spark, sf, "documents", 128)
    return _docs(spark, sf).repartitionByRange(n, "lang", "doc_id").write.partitionBy("lang")


def _batched(spark, sf, **options):
    """The documents as folders of files for each language, streamed a file at a time."""
    folder, out = new_stage_path(spark, "incoming"), new_stage_path(spark, "batches")
    _by_language(spark, sf).parquet(folder)
    schema = T.StructType([f for f in _DOC if f.name != "lang"])
    stream = read_increments(spark, f"{folder}/*", schema, "parquet", files_per_batch=1)
    return stream, out, new_stage_path(spark, "progress")


def _several_batches(spark, sf):
    """Every batch in a folder of its own, one for each file."""
    stream, out, kept = _batched(spark, sf)
    run_available(stream, out, kept)
    return spark.read.parquet(out).select("doc_id", "text")


def _timed_batches(spark, sf):
    """Flushed on a timer; successes and errors part from one computation."""
    stream, out, kept = _batched(spark, sf)

    def judge(df):
        status = F.when(F.col("source") == "src3", F.lit("error")).otherwise(F.lit("success"))
        return df.select("doc_id", F.length("text").cast("bigint").alias("n"), status.alias("api_status"))

    query = append_increments(stream, out, kept, judge, "api_status", every="200 milliseconds")
    query.processAllAvailable()
    query.stop()
    parts = [spark.read.parquet(f"{out}/{kept}").select("doc_id", "n", F.lit(kept).alias("kept")) for kept in ("success", "error")]
    return parts[0].unionByName(parts[1])


def _replayed(spark, sf):
    """Files of documents; the outputs of two languages are changed behind the log's back; then run again."""
    folder, root = new_stage_path(spark, "sources"), new_stage_path(spark, "progress")
    _by_language(spark, sf).json(folder)
    schema = T.StructType([f for f in _DOC if f.name != "lang"])

    def read(paths):
        return spark.read.schema(schema).json(paths).withColumn("source_path", listing.file_path())

    def measure(rows):
        return rows.select("doc_id", F.length("text").cast("bigint").alias("n"), "source_path")

    def run():
        return progress.process_files(spark, folder, root, read, measure, "*.json", recursive=True)

    run()
    known = {r.path: r for r in progress.progress(spark, root).collect()}
    lines = []
    for path, entry in known.items():
        out = f"{root}/files/run={entry.run:06d}/file={entry.file}"
        if "/lang=de/" in path:  # rows that were never logged
            spark.read.parquet(out).write.mode("append").parquet(out)
        if "/lang=fr/" in path:  # a log that says more than there is
            lines.append({"path": path, "length": entry.length, "modified": entry.modified, "run": 2, "file": entry.file, "n_rows": entry.n_rows + 1})
    if lines:
        CommitLog(spark, root, progress.ENTRY).enter_all("000002", lines)
    again = {r.path: r.reason for r in run().collect()}
    rows = progress.processed(spark, root)
    language = F.regexp_extract("source_path", "/lang=([^/]+)/", 1)
    replayed = F.col("source_path").isin(list(again)) if again else F.lit(False)
    return rows.select("doc_id", "n", language.alias("lang"), replayed.alias("replayed"))


def _share(spark, sf):
    """Deals documents to shares of some 128 MB of the table, by their ids."""
    return F.pmod(F.xxhash64("doc_id"), F.lit(pieces(spark, sf, "documents", 128)))


def _shards(spark, sf):
    """Result files of several models, those of one model and split broken in a last line."""
    base = new_stage_path(spark, "shards")
    split = F.concat(F.lit("docs_split_000"), F.col("doc_id") % 3)
    dealt = _docs(spark, sf).withColumn("share", _share(spark, sf))
    last = F.max("doc_id").over(Window.partitionBy("lang", F.col("doc_id") % 3, "share")) == F.col("doc_id")
    row = F.to_json(F.struct("doc_id", "text"))
    broken = (F.col("lang") == "de") & (F.col("doc_id") % 3 == 1) & last
    line = F.when(broken, F.substring(row, F.lit(1), F.length(row) - 1)).otherwise(row)
    lines = dealt.select("doc_id", line.alias("value"), F.col("lang").alias("model"), split.alias("split"), "share")
    lines = lines.repartition("model", "split", "share").sortWithinPartitions("model", "split", "share", "doc_id")
    lines.select("value", "model", "split").write.partitionBy("model", "split").text(base)
    rows = listing.read_shards(spark, base, T.StructType(_DOC.fields[:2]), "*/*split*/*.txt")
    return merge_shards(rows).select("doc_id", "text", F.replace("model", F.lit("model="), F.lit("")).alias("model"), "status")


def _large_packages(spark, sf):
    """A package for each language, with all its documents as files, written in parts of some 32 MB; read by blocks of 64 KB."""
    root = new_stage_path(spark, "large")
    docs = _docs(spark, sf)
    entry = F.concat(F.lit('<file path="'), "source", F.lit("/"), "doc_id", F.lit('.txt">\n'), "text", F.lit("\n</file>"))
    extra = F.when(F.col("lang") == "de", F.lit('\n<file path=".gitignore">*.pyc</file>')).otherwise(F.lit(""))
    bodies = docs.select("lang", F.lit(1).alias("at"), "doc_id", F.concat(entry, extra).alias("value"))
    frame = docs.select("lang").distinct()
    head = frame.select("lang", F.lit(0).alias("at"), F.lit(0).cast("long").alias("doc_id"), F.lit("All documents\n<files>\n<file path=\"README.md\">\nall\n</file>").alias("value"))
    tail = frame.select("lang", F.lit(2).alias("at"), F.lit(0).cast("long").alias("doc_id"), F.lit("</files>\n<file path=\"late.txt\">out</file>").alias("value"))
    n = max(8, pieces(spark, sf, "documents", 32))  # a small package has several parts too
    rows = bodies.unionByName(head).unionByName(tail).repartitionByRange(n, "lang", "at", "doc_id").sortWithinPartitions("lang", "at", "doc_id")
    # A task's number is its part's, so that parts stand in the order of the ranges.
    rows.select("value", "lang").write.option("maxRecordsPerFile", 0).partitionBy("lang").text(root)
    with read_by_blocks(spark, root, "64k"):
        return read_entries(spark, root, pattern="*.txt", in_parts=True)


def _entries(spark, sf):
    entries, _ = _large_packages(spark, sf)
    return entries.select(F.replace("language", F.lit("lang="), F.lit("")).alias("lang"), "entry", "path", "body")


def _repositories(spark, sf):
    entries, names = _large_packages(spark, sf)
    found = repository_columns(entries, names)
    language = F.regexp_extract("file", "/lang=([^/]+)/", 1).alias("lang")
    return found.select(language, "files_with_content", "total_lines", counts_json("file_types").alias("file_types"), "has_readme", "has_license", "has_gitignore")


def _list_files(spark, sf):
    """A dataset of two configs, the files of each split one JSON list each; read by blocks of 64 KB."""
    root = new_stage_path(spark, "lists")
    docs = _docs(spark, sf).withColumn("config", F.when(F.col("lang").isin("de", "fr"), "one").otherwise("two"))
    # One file for each config and share, below ``<config>/split=train-<share>.json``: the reader goes by the folder's name.
    docs = docs.withColumn("split", F.concat(F.lit("train-"), _share(spark, sf), F.lit(".json")))
    first = F.min("doc_id").over(Window.partitionBy("config", "split")) == F.col("doc_id")
    row = F.concat(F.when(first, F.lit("[")).otherwise(F.lit(", ")), F.to_json(F.struct("doc_id", "text", "lang")))
    frame = docs.select("config", "split").distinct().select("config", "split", F.lit(None).cast("long").alias("doc_id"), F.lit("]").alias("value"))
    lines = docs.select("config", "split", "doc_id", row.alias("value")).unionByName(frame)
    # By one text: by the two columns, as the parts of the union already lie, Spark leaves the exchange out and merges each part's tasks on its own.
    dealt = lines.repartition(F.concat("config", F.lit("/"), "split"))
    dealt = dealt.sortWithinPartitions("config", "split", F.col("value") == "]", F.asc_nulls_last("doc_id"))
    dealt.select("value", "config", "split").write.partitionBy("config", "split").text(root)
    schema = T.StructType([f for f in _DOC if f.name in ("doc_id", "text", "lang")])
    with read_by_blocks(spark, root, "64k"):
        parts = [listing.read_dataset(spark, root, f"config={c}", None, "split=train", schema).withColumn("config", F.lit(c)) for c in ("one", "two")]
    return parts[0].unionByName(parts[1]).select("doc_id", "text", "lang", "config")


def _nested(spark, sf):
    """Events as JSON lines: an object in an object, a list, a field of three types, and a map of users."""
    events = table(spark, sf, "events")
    mixed = F.when(F.col("event_type") == "click", F.lit("null")).when(F.col("event_type") == "view", F.lit('"seen"')).otherwise(F.col("user_id").cast("string"))
    line = F.concat(
        F.lit('{"props": '), "props", F.lit(', "mixed": '), mixed, F.lit(', "tags": ["a", {"b": true}], "by_user": {"u'), F.col("event_id").cast("string"), F.lit('": 1}}')
    )
    return nested_profile(events.select(F.col("event_type").alias("file_name"), line.alias("line")), map_keys=8)


_BODY_SQL = "replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
_ENTRIES_SQL = f"""(
    SELECT lang, 0 AS pos, 0 AS doc_id, 0 AS more, 'README.md' AS path, chr(10) || 'all' || chr(10) AS body FROM (SELECT DISTINCT lang FROM documents)
    UNION ALL SELECT lang, 1, doc_id, 0, source || '/' || doc_id || '.txt', chr(10) || {_BODY_SQL} || chr(10) FROM documents
    UNION ALL SELECT lang, 1, doc_id, 1, '.gitignore', '*.pyc' FROM documents WHERE lang = 'de')"""

ENTRIES = {
    "io16_commits": Entry(
        _committed,
        """SELECT doc_id, 'row-' || doc_id AS uid,
                  CASE WHEN NOT starts_with(text, 'De') THEN length(text) || ' characters' END AS response,
                  CASE WHEN starts_with(text, 'De') THEN 'error' ELSE 'success' END AS status FROM documents""",
    ),
    "io16_batches": Entry(_several_batches, "SELECT doc_id, text FROM documents"),
    "io17_timed": Entry(
        _timed_batches,
        "SELECT doc_id, length(text) AS n, CASE WHEN source = 'src3' THEN 'error' ELSE 'success' END AS kept FROM documents",
    ),
    "io18_mismatch": Entry(
        _replayed, "SELECT doc_id, length(text) AS n, lang, lang IN ('de', 'fr') AS replayed FROM documents"
    ),
    "se4_files": Entry(
        _shards,
        "SELECT doc_id, text, lang AS model, 'success' AS status FROM documents WHERE NOT (lang = 'de' AND doc_id % 3 = 1)",
    ),
    "io11_lists": Entry(
        _list_files,
        "SELECT doc_id, text, lang, CASE WHEN lang IN ('de', 'fr') THEN 'one' ELSE 'two' END AS config FROM documents",
    ),
    "jb13_nested": Entry(
        _nested,
        """WITH sized AS (SELECT event_type AS file_name, count(*) AS n FROM events GROUP BY event_type),
                fixed(path, type, times) AS (VALUES ('props', 'object', 1), ('props.k', 'bigint', 1), ('tags', 'array', 1),
                    ('tags[]', 'string', 1), ('tags[]', 'object', 1), ('tags[].b', 'boolean', 1), ('by_user.*', 'bigint', 1), ('by_user', 'map', 1))
           SELECT file_name, path, type, n * times AS n_values FROM sized, fixed UNION ALL
           SELECT file_name, 'mixed', CASE file_name WHEN 'click' THEN 'null' WHEN 'view' THEN 'string' ELSE 'bigint' END, n FROM sized""",
    ),
    "io9_entries": Entry(
        _entries,
        f"SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY pos, doc_id, more) AS entry, path, body FROM {_ENTRIES_SQL}",
    ),
    "jb4_repositories": Entry(
        _repositories,
        f"""SELECT lang, count(*) AS files_with_content,
                   CAST(sum(length(body) - length(replace(body, chr(10), '')) + 1) AS BIGINT) AS total_lines,
                   '{{"' || '.md": 1, ".txt": ' || count(*) FILTER (WHERE path LIKE '%.txt')
                   || CASE WHEN lang = 'de' THEN ', "": ' || count(*) FILTER (WHERE path = '.gitignore') ELSE '' END || '}}' AS file_types,
                   TRUE AS has_readme, FALSE AS has_license, lang = 'de' AS has_gitignore
            FROM {_ENTRIES_SQL} GROUP BY lang""",
    ),
}
