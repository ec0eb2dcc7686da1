"""Queries that write files, read them back, and stream over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import Entry
from millrace.catalog.inputs import run_log, table
from millrace.operators.filters import shard_file_kind, successes
from millrace.session import new_stage_path
from millrace.sources import listing, tables
from millrace.sources.jsonl import read_strict, read_tolerant, rejected_lines, write_jsonl
from millrace.streaming import read_increments, run_available

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _struct(ddl):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)


def _docs(spark, sf):
    return table(spark, sf, "documents")


def _written_lines(spark, sf):
    """Documents as JSON lines: some languages' lines broken, some followed by blank ones."""
    row = F.to_json(F.struct("doc_id", "text", "lang", "source", "n_chars"))
    line = (
        F.when(F.col("lang") == "de", F.concat(row, F.lit(" and more")))
        .when(F.col("lang") == "es", F.replace(row, F.lit('"doc_id"'), F.lit("'doc_id'")))
        .when(F.col("lang") == "fr", F.concat(F.lit("  "), row, F.lit("\t\n\n   ")))
        .otherwise(row)
    )
    path = new_stage_path(spark, "lines")
    _docs(spark, sf).select(line.alias("value")).write.text(path)
    return path


def _strict(spark, sf):
    path = new_stage_path(spark, "strict")
    write_jsonl(_docs(spark, sf), path)
    return read_strict(spark, path, DOC_SCHEMA)


def _nulls(spark, sf):
    """Null keys are written, and non-ASCII text stays as it is in the file."""
    docs = _docs(spark, sf).select("doc_id", F.when(F.col("lang") != "fr", F.col("text")).alias("text"), "lang")
    path = new_stage_path(spark, "nulls")
    write_jsonl(docs, path)
    lines = spark.read.text(path)
    keys = F.json_object_keys("value")
    return lines.select(
        F.get_json_object("value", "$.doc_id").cast("bigint").alias("doc_id"),
        F.get_json_object("value", "$.text").alias("text"),
        F.array_join(keys, ",").alias("keys"),
        F.contains("value", F.lit("\\u")).alias("escaped"),
    )


def _parquet(spark, sf):
    path = new_stage_path(spark, "table") + ".parquet"
    tables.save(_docs(spark, sf), path)
    tables.save(_docs(spark, sf).filter(F.col("lang") != "es"), path)
    return tables.load(spark, path)


def _by_extension(spark, sf):
    """Open orders as Parquet, the others as JSON lines, each read by its path's extension; any other extension is an error."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("double").alias("o_totalprice"))
    base, parts = new_stage_path(spark, "orders"), []
    for name, rows in ((".parquet", orders.filter("o_orderstatus = 'O'")), (".jsonl", orders.filter("o_orderstatus <> 'O'"))):
        tables.save(rows, base + name)
        parts.append(tables.load(spark, base + name, orders.schema).withColumn("kind", F.lit(name)))
    try:
        tables.load(spark, base + ".csv")
    except ValueError:
        return parts[0].unionByName(parts[1])
    raise AssertionError("a path of unknown format was read")


def _folder(spark, sf):
    """Some languages as Parquet, the others as JSON lines, in one folder."""
    path = new_stage_path(spark, "folder")
    docs = _docs(spark, sf)
    docs.filter(F.col("lang").isin("en", "fr")).write.parquet(path)
    docs.filter(~F.col("lang").isin("en", "fr")).write.mode("append").json(path)
    return path


def _both_formats(spark, sf):
    rows = listing.read_folder(spark, _folder(spark, sf), _struct(DOC_SCHEMA), lines="*.json")
    kind = F.when(F.col("source_file").endswith(".json"), F.lit("lines")).otherwise(F.lit("parquet"))
    return rows.select("doc_id", "text", kind.alias("kind"))


def _pattern(spark, sf):
    rows = listing.read_pattern(spark, _folder(spark, sf), "*.json", _struct(DOC_SCHEMA))
    return rows.select("doc_id", "text", "lang")


def _triplets(spark, sf):
    """One folder of triplet files, named by language and part."""
    path = new_stage_path(spark, "triplets")
    part = F.when(F.col("lang") == "en", F.lit("_part_a_part01")).when(F.col("lang") == "de", F.lit("_part02")).otherwise(F.lit(""))
    name = F.concat(F.lit("pt_data_"), "lang", part, F.lit(".jsonl"))
    write_jsonl(_docs(spark, sf).withColumn("name", name), path, partition_by=["name"])
    rows = read_tolerant(spark, f"{path}/*/*.json", _struct(DOC_SCHEMA), keep_file=True)
    name = F.regexp_extract("file_path", "/name=([^/]+)/", 1)
    return rows.select("doc_id", "text", listing.triplet_language(name).alias("language"))


def _package_texts(spark, sf):
    """Package files below one folder per language, each read as one text."""
    path = new_stage_path(spark, "packages")
    lines = F.concat(F.lit("doc "), "doc_id", F.lit(" of "), "source")
    _docs(spark, sf).select("lang", lines.alias("value")).write.partitionBy("lang").text(path)
    texts = listing.read_packages(spark, path, pattern="*.txt")
    n_docs = F.sum(F.regexp_count("content", F.lit("doc [0-9]+ of "))).cast("bigint")
    return texts.groupBy(F.replace("language", F.lit("lang="), F.lit("")).alias("lang")).agg(n_docs.alias("n_docs"))


def _datasets(spark, sf):
    root = new_stage_path(spark, "datasets")
    docs = _docs(spark, sf)
    docs.filter(F.col("lang") == "en").write.parquet(f"{root}/org/docs/web/train.parquet")
    docs.filter(F.col("lang") != "en").write.json(f"{root}/plain.jsonl")
    schema = _struct(DOC_SCHEMA)
    parts = [
        listing.read_dataset(spark, root, "org/docs", "web", "train", schema),
        listing.read_dataset(spark, root, "plain.jsonl", None, "train", schema),
    ]
    return parts[0].unionByName(parts[1]).select("doc_id", "text", "dataset", "config", "split")


def _increments(spark, sf, **options):
    """The documents as a stream. A glob, so that it may be one file or a folder of files."""
    return read_increments(spark, f"{sf}/documents.parque[t]", _struct(DOC_SCHEMA), "parquet", **options)


def _stream(spark, sf, out, **options):
    run_available(_increments(spark, sf, files_per_batch=1), out, new_stage_path(spark, "progress"), **options)


def _streamed(spark, sf):
    out = new_stage_path(spark, "appended")
    _stream(spark, sf, out)
    return spark.read.parquet(out).select("doc_id", "text")


def _score_batch(df):
    status = F.when(F.col("lang") == "de", F.lit("error")).otherwise(F.lit("success"))
    return df.select("doc_id", F.length("text").cast("bigint").alias("n"), status.alias("api_status"))


def _streamed_successes(spark, sf):
    out = new_stage_path(spark, "scored")
    _stream(spark, sf, out, transform=_score_batch, status="api_status")
    kept = spark.read.parquet(f"{out}/success").select("doc_id", "n", F.lit("success").alias("kept"))
    return kept.unionByName(spark.read.parquet(f"{out}/error").select("doc_id", "n", F.lit("error").alias("kept")))


def _restarted(spark, sf):
    """The same stream started twice: the second run finds nothing new."""
    out, progress = new_stage_path(spark, "restarted"), new_stage_path(spark, "progress")
    for _ in range(2):
        run_available(_increments(spark, sf), out, progress, transform=_score_batch)
    return spark.read.parquet(out).select("doc_id", "n")


def _republished(spark, sf):
    """A fresh run takes the place of an earlier one, which is moved aside."""
    docs, target = _docs(spark, sf), new_stage_path(spark, "published")
    for frame in (docs.select("doc_id"), docs.select("doc_id", "lang")):
        staged = new_stage_path(spark, "run")
        frame.write.parquet(staged)
        tables.publish(spark, staged, target)
    return spark.read.parquet(target)


def _kinds(spark, sf):
    name = F.concat("event_type", F.when(F.col("user_id") < 80, F.lit("_error_retry_1")).otherwise(F.lit("_split_0001")), F.lit(".jsonl"))
    events = table(spark, sf, "events").select("event_id", F.concat(F.lit("x_"), name).alias("name"))
    return events.select("event_id", shard_file_kind(F.col("name")).alias("kind"))


ENTRIES = {
    "io1": Entry(_strict, "SELECT doc_id, text, lang, source, n_chars FROM documents"),
    "io2": Entry(
        lambda spark, sf: read_tolerant(spark, _written_lines(spark, sf), _struct(DOC_SCHEMA)),
        "SELECT doc_id, text, lang, source, n_chars FROM documents WHERE lang NOT IN ('de', 'es')",
    ),
    "io2_rejected": Entry(
        lambda spark, sf: rejected_lines(spark, _written_lines(spark, sf)).agg(
            F.coalesce(F.sum("n_rejected"), F.lit(0)).cast("bigint").alias("n_rejected")
        ),
        "SELECT count(*) AS n_rejected FROM documents WHERE lang IN ('de', 'es')",
    ),
    "io3": Entry(
        lambda spark, sf: tables.load(spark, f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_returnflag"),
        "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem",
    ),
    "io4": Entry(
        _by_extension,
        """SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice,
                  CASE WHEN o_orderstatus = 'O' THEN '.parquet' ELSE '.jsonl' END AS kind FROM orders""",
    ),
    "io5": Entry(
        _nulls,
        """SELECT doc_id, CASE WHEN lang <> 'fr' THEN text END AS text, 'doc_id,text,lang' AS keys,
                  contains(text, '\\u') AND lang <> 'fr' AS escaped FROM documents""",
    ),
    "io6": Entry(_parquet, "SELECT doc_id, text, lang, source, n_chars FROM documents WHERE lang <> 'es'"),
    "io7": Entry(
        _both_formats,
        "SELECT doc_id, text, CASE WHEN lang IN ('en', 'fr') THEN 'parquet' ELSE 'lines' END AS kind FROM documents",
    ),
    "io8": Entry(_pattern, "SELECT doc_id, text, lang FROM documents WHERE lang NOT IN ('en', 'fr')"),
    "io9": Entry(_package_texts, "SELECT lang, count(*) AS n_docs FROM documents GROUP BY lang"),
    "io10": Entry(
        _triplets,
        "SELECT doc_id, text, CASE WHEN lang = 'en' THEN 'en_part_a' ELSE lang END AS language FROM documents",
    ),
    "io11": Entry(
        _datasets,
        """SELECT doc_id, text, CASE WHEN lang = 'en' THEN 'org/docs' ELSE 'plain.jsonl' END AS dataset,
                  CASE WHEN lang = 'en' THEN 'web' END AS config, 'train' AS split FROM documents""",
    ),
    "io16": Entry(_streamed, "SELECT doc_id, text FROM documents"),
    "io17": Entry(
        _streamed_successes,
        """SELECT doc_id, length(text) AS n, CASE WHEN lang = 'de' THEN 'error' ELSE 'success' END AS kept
           FROM documents""",
    ),
    "io18": Entry(_restarted, "SELECT doc_id, length(text) AS n FROM documents"),
    "io19": Entry(_republished, "SELECT doc_id, lang FROM documents"),
    "fl5": Entry(
        lambda spark, sf: successes(run_log(spark, sf), "status").select("event_id", "score"),
        "SELECT event_id, value AS score FROM events WHERE event_type NOT IN ('error', 'signup')",
    ),
    "fl6": Entry(
        _kinds,
        """SELECT event_id, CASE WHEN user_id < 80 THEN 'ignored' WHEN event_type = 'error' THEN 'error'
                  ELSE 'output' END AS kind FROM events""",
    ),
}
