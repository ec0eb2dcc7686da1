"""Queries for run reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import Entry
from millrace.catalog.inputs import FINISHED_SQL, LOG_SQL, REQUESTS_SQL, finished_requests, requests, run_log, table
from millrace.operators import reports, unions
from millrace.plans.generation import pending_requests
from millrace.catalog.sets import _shard_rows


def _round(frame, *names, digits=6):
    return frame.withColumns({n: F.round(n, digits) for n in names})


def _shards(spark, sf):
    rows = unions.merge_shards(_shard_rows(spark, sf)).withColumn(
        "model", F.when(F.col("user_id") < 75, F.lit("alpha")).otherwise(F.lit("beta"))
    )
    return _round(reports.shard_summary(rows, ["model"]), "success_rate")


def _times(spark, sf):
    out = reports.time_range(run_log(spark, sf))
    return out.withColumns({c: reports.epoch_micros(out, c) for c in ("first", "last")})


def _languages(spark, sf):
    docs = table(spark, sf, "documents")
    files = docs.groupBy("lang", "source").agg(F.count_if(F.length("text") > 500).alias("n_sample"))
    return files.withColumnRenamed("lang", "language")


def _file_stats(spark, sf):
    docs = table(spark, sf, "documents").select("source", F.col("_metadata.file_size").alias("size"))
    stats = reports.file_stats(docs.withColumnRenamed("source", "raw_file_path"), size="size")
    return stats.select("raw_file_path", "n_sample", "processing_complete", (F.col("input_file_size_bytes") > 0).alias("sized"))


def _resume_counts(spark, sf):
    source = requests(spark, sf)
    left = pending_requests(source, finished_requests(spark, sf))
    return reports.resume_counts(source, left, ["uid", "id"]).withColumns(
        {c: F.col(c).cast("bigint") for c in ("n_rows", "n_uid_made", "n_remaining", "n_skipped")}
    )


_SCORES = """count(score) AS n, round(avg(score), 6) AS mean, round(median(score), 6) AS median,
             min(score) AS minimum, max(score) AS maximum"""

ENTRIES = {
    "ag1": Entry(
        lambda spark, sf: _round(reports.file_summary(run_log(spark, sf)), "success_rate"),
        f"""SELECT file, count(*) AS n_rows, count(*) FILTER (status = 'success') AS n_success,
                   round(100.0 * count(*) FILTER (status = 'success') / count(*), 6)::DOUBLE AS success_rate
            FROM {LOG_SQL} GROUP BY file""",
    ),
    "ag2": Entry(
        lambda spark, sf: _round(reports.batch_summary(run_log(spark, sf), ["event_id"]), "success_rate"),
        f"""SELECT (rn - 1) // 100 AS batch, count(*) AS batch_size,
                   count(*) FILTER (status = 'success') AS success_count,
                   count(*) FILTER (status = 'error') AS error_count,
                   round(100.0 * count(*) FILTER (status = 'success') / count(*), 6)::DOUBLE AS success_rate
            FROM (SELECT *, row_number() OVER (ORDER BY event_id) AS rn FROM {LOG_SQL}) GROUP BY 1""",
    ),
    "ag3": Entry(
        lambda spark, sf: _round(
            reports.run_totals(run_log(spark, sf), time="timestamp"), "success_rate", "elapsed_time", "processing_speed"
        ),
        f"""SELECT count(DISTINCT file) AS total_files, count(*) AS processed_items,
                   count(*) FILTER (status = 'success') AS success_items, count(*) FILTER (status = 'error') AS failed_items,
                   round((epoch_us(max(timestamp)) - epoch_us(min(timestamp))) / 1e6, 6)::DOUBLE AS elapsed_time,
                   round(100.0 * count(*) FILTER (status = 'success') / count(*), 6)::DOUBLE AS success_rate,
                   round(count(*) * 60.0 / ((epoch_us(max(timestamp)) - epoch_us(min(timestamp))) / 1e6), 6)::DOUBLE
                       AS processing_speed FROM {LOG_SQL}""",
    ),
    "ag4": Entry(
        _shards,
        """SELECT CASE WHEN user_id < 75 THEN 'alpha' ELSE 'beta' END AS model,
                  count(DISTINCT CASE WHEN event_type <> 'error' THEN user_id END) AS total_files,
                  count(*) FILTER (event_type <> 'error') AS success_count,
                  count(*) FILTER (event_type = 'error') AS error_count,
                  round(100.0 * count(*) FILTER (event_type <> 'error') / count(*), 6)::DOUBLE AS success_rate
           FROM events WHERE event_type NOT IN ('signup', 'view') GROUP BY 1""",
    ),
    "ag5": Entry(
        lambda spark, sf: _round(reports.status_distribution(run_log(spark, sf)), "percentage"),
        f"""SELECT status, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM events), 6)::DOUBLE AS percentage
            FROM {LOG_SQL} WHERE status IS NOT NULL GROUP BY status""",
    ),
    "ag6": Entry(
        lambda spark, sf: _round(reports.score_statistics(run_log(spark, sf)), "mean", "median"),
        f"SELECT {_SCORES} FROM {LOG_SQL}",
    ),
    "ag6_by_status": Entry(
        lambda spark, sf: _round(
            reports.score_statistics(table(spark, sf, "events"), "value", ["event_type"]), "mean", "median"
        ),
        f"SELECT event_type, {_SCORES.replace('score', 'value')} FROM events GROUP BY event_type",
    ),
    "ag7": Entry(
        lambda spark, sf: reports.top_files(run_log(spark, sf)),
        f"SELECT file, count(*) AS n FROM {LOG_SQL} GROUP BY file ORDER BY n DESC, file LIMIT 10",
    ),
    "so3": Entry(
        lambda spark, sf: reports.top_files(table(spark, sf, "documents"), "source", 5),
        "SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 5",
    ),
    "ag8": Entry(
        _times,
        """SELECT count(*) AS n, epoch_us(min(ts)) AS first, epoch_us(max(ts)) AS last FROM events""",
    ),
    "ag9": Entry(
        lambda spark, sf: reports.duplicate_ids(
            table(spark, sf, "documents").select(F.md5(F.col("text").cast("binary")).alias("id"))
        ),
        "SELECT md5(text) AS id, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1",
    ),
    "ag12": Entry(
        lambda spark, sf: reports.language_summary(_languages(spark, sf)),
        """SELECT lang AS language, count(*) AS n_files, sum(k)::BIGINT AS n_items, count(*) FILTER (k > 0) AS n_done
           FROM (SELECT lang, source, count(*) FILTER (length(text) > 500) AS k FROM documents GROUP BY lang, source)
           GROUP BY lang""",
    ),
    "ag12_totals": Entry(
        lambda spark, sf: _round(
            reports.language_totals(reports.language_summary(_languages(spark, sf))), "success_rate"
        ),
        """SELECT count(*) AS n_languages, count(*) FILTER (k > 0) AS n_succeeded, sum(f)::BIGINT AS n_files,
                  sum(k)::BIGINT AS n_items, round(100.0 * count(*) FILTER (k > 0) / count(*), 6)::DOUBLE AS success_rate
           FROM (SELECT lang, count(DISTINCT source) AS f, count(*) FILTER (length(text) > 500) AS k
                 FROM documents GROUP BY lang)""",
    ),
    "ag13": Entry(
        _file_stats,
        """SELECT source AS raw_file_path, count(*) AS n_sample, true AS processing_complete, true AS sized
           FROM documents GROUP BY source""",
    ),
    "ag14": Entry(
        _resume_counts,
        f"""SELECT count(*) AS n_rows, count(*) FILTER (lang NOT IN ('de', 'fr')) AS n_uid_made,
                   count(*) FILTER (uid NOT IN (SELECT uid FROM {FINISHED_SQL})) AS n_remaining,
                   count(*) FILTER (uid IN (SELECT uid FROM {FINISHED_SQL})) AS n_skipped FROM {REQUESTS_SQL}""",
    ),
    "ag15": Entry(
        lambda spark, sf: _round(reports.generation_summary(run_log(spark, sf)), "success_rate"),
        f"""SELECT count(*) AS completed, count(*) FILTER (status = 'success') AS success,
                   count(*) FILTER (status = 'error') AS error,
                   round(100.0 * count(*) FILTER (status = 'success') / count(*), 6)::DOUBLE AS success_rate
            FROM {LOG_SQL}""",
    ),
}
