"""Run reports: counts, rates and distributions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from millrace.operators.ordinals import with_ordinal

# Fixed value: log entries per batch summary.
LOG_BATCH = 100


def _share(part: Column, whole: Column, empty: float) -> Column:
    """Percentage; ``empty`` when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(empty))


def _is(status: str, value: str) -> Column:
    return F.coalesce(F.col(status) == value, F.lit(False))


def epoch_micros(rows: DataFrame, time: str) -> Column:
    """Microseconds since 1970; times without a zone are taken as they stand, whatever the session's zone."""
    if isinstance(rows.schema[time].dataType, T.TimestampType):
        return F.unix_micros(time)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, F.col(time).cast("timestamp_ntz"))


def file_summary(rows: DataFrame, file: str = "file", status: str = "status") -> DataFrame:
    """Rows, successes and success rate per file."""
    counted = rows.groupBy(file).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(_is(status, "success")).alias("n_success")
    )
    return counted.withColumn("success_rate", _share(F.col("n_success"), F.col("n_rows"), 0.0))


def batch_summary(
    log: DataFrame, order: list[str], status: str = "status", size: int = LOG_BATCH
) -> DataFrame:
    """Size, successes, errors and rate per run of ``size`` entries in the given order."""
    numbered, _ = with_ordinal(log.select(*order, status), order)
    batch = F.floor((F.col("ord") - 1) / F.lit(size)).alias("batch")
    counted = numbered.groupBy(batch).agg(
        F.count(F.lit(1)).alias("batch_size"),
        F.count_if(_is(status, "success")).alias("success_count"),
        F.count_if(_is(status, "error")).alias("error_count"),
    )
    return counted.withColumn("success_rate", _share(F.col("success_count"), F.col("batch_size"), 0.0))


def run_totals(
    rows: DataFrame, file: str = "file", status: str = "status", time: str | None = None
) -> DataFrame:
    """One row: files, items, successes, failures, rate, and items per minute.

    With a time column the speed is over the span from the first row to the last.
    Files are counted after rows are reduced to one per file.
    """
    measures = [
        F.count(F.lit(1)).alias("items"),
        F.count_if(_is(status, "success")).alias("ok"),
        F.count_if(_is(status, "error")).alias("failed"),
    ]
    if time:
        micros = epoch_micros(rows, time)
        measures += [F.min(micros).alias("first"), F.max(micros).alias("last")]
    per_file = rows.groupBy(file).agg(*measures)
    totals = [
        F.count(F.lit(1)).alias("total_files"),
        F.coalesce(F.sum("items"), F.lit(0)).alias("processed_items"),
        F.coalesce(F.sum("ok"), F.lit(0)).alias("success_items"),
        F.coalesce(F.sum("failed"), F.lit(0)).alias("failed_items"),
    ]
    if time:
        totals.append(((F.max("last") - F.min("first")) / F.lit(1e6)).alias("elapsed_time"))
    out = per_file.agg(*totals).withColumn(
        "success_rate", _share(F.col("success_items"), F.col("processed_items"), 0.0)
    )
    if time:
        speed = F.try_divide(F.col("processed_items") * F.lit(60.0), F.col("elapsed_time"))
        out = out.withColumn("processing_speed", F.coalesce(speed, F.lit(0.0)))
    return out


def shard_summary(rows: DataFrame, by: list[str], file: str = "file_name", status: str = "status") -> DataFrame:
    """Output files, successes, errors and success rate; 100 when there are no rows."""
    ok = _is(status, "success")
    per_file = rows.groupBy(*by, file).agg(
        F.count_if(ok).alias("ok"), F.count_if(_is(status, "error")).alias("bad")
    )
    out = per_file.groupBy(*by).agg(
        F.count_if(F.col("ok") > 0).alias("total_files"),
        F.sum("ok").alias("success_count"),
        F.sum("bad").alias("error_count"),
    )
    return out.withColumn(
        "success_rate", _share(F.col("success_count"), F.col("success_count") + F.col("error_count"), 100.0)
    )


def status_distribution(rows: DataFrame, status: str = "status") -> DataFrame:
    """Rows per status and their percentage of all rows, most frequent first.

    Rows without a status count in the total only. The total is a window over the
    counts, one row per status.
    """
    counted = rows.groupBy(status).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    shares = counted.select(status, "n", _share(F.col("n"), total, 0.0).alias("percentage"))
    return shares.filter(F.col(status).isNotNull()).orderBy(F.desc("n"), status)


def score_statistics(
    rows: DataFrame, score: str = "score", by: list[str] | None = None, accuracy: int = 20_000
) -> DataFrame:
    """Mean, exact median, minimum and maximum of the scores that are there.

    An exact median in one aggregate keeps every distinct score of a group in
    one task. Here a rank sketch gives a narrow interval that must hold the
    median; scores below it are only counted, those above are left out, those
    inside are reduced to counts per value, and the median is read off the
    running counts.
    """
    by = by or []
    scores = rows.filter(F.col(score).isNotNull()).select(*by, F.col(score).cast("double").alias("_v"))
    margin = 4.0 / accuracy
    measures = [
        F.count(F.lit(1)).alias("n"),
        F.avg("_v").alias("mean"),
        F.min("_v").alias("minimum"),
        F.max("_v").alias("maximum"),
        F.percentile_approx("_v", F.array(F.lit(0.5 - margin), F.lit(0.5 + margin)), F.lit(accuracy)).alias("_ends"),
    ]
    known = ["n", "mean", "minimum", "maximum"]
    if by:
        # Null-safe: rows without a group are a group of their own.
        measured = scores.groupBy(*by).agg(*measures).withColumnsRenamed({c: f"_by_{c}" for c in by})
        same_group = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by])
        attached = scores.join(measured, same_group).drop(*(f"_by_{c}" for c in by))
    else:
        whole = scores.agg(*measures).first()
        ends = F.array(*[F.lit(e) for e in whole["_ends"] or [None, None]]).cast("array<double>")
        literals = {c: F.lit(whole[c]).cast("double") for c in known[1:]}
        attached = scores.withColumns({"n": F.lit(whole["n"]).cast("bigint"), "_ends": ends, **literals})
    low, high = F.col("_ends")[0], F.col("_ends")[1]
    inside = F.when(F.col("_v") >= low, F.col("_v")).alias("_v")
    # The group's measures ride along as grouping columns: they depend on the group.
    counts = attached.filter(F.col("_v") <= high).groupBy(*by, *known, inside).agg(F.count(F.lit(1)).alias("_c"))
    upwards = Window.partitionBy(*by).orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    running = counts.withColumn("_upto", F.sum("_c").over(upwards)).filter(F.col("_v").isNotNull())
    middles = [F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1]
    lower, upper = (F.min(F.when(F.col("_upto") >= rank, F.col("_v"))) for rank in middles)
    return (
        running.groupBy(*by, *known)
        .agg(((lower + upper) / 2).alias("median"))
        .select(*by, "n", "mean", "median", "minimum", "maximum")
    )


def top_files(rows: DataFrame, file: str = "file", k: int = 10) -> DataFrame:
    """The k files with most rows, ties by name."""
    return rows.groupBy(file).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), file).limit(k)


def time_range(rows: DataFrame, time: str = "timestamp") -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("n"), F.min(time).alias("first"), F.max(time).alias("last"))


def duplicate_ids(rows: DataFrame, id_column: str = "id") -> DataFrame:
    """Ids that occur more than once, missing ids included."""
    return rows.groupBy(id_column).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def language_summary(files: DataFrame, language: str = "language") -> DataFrame:
    """Files, items and files with items per language. ``files`` has one row per file."""
    return files.groupBy(language).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("n_sample").alias("n_items"),
        F.count_if(F.col("n_sample") > 0).alias("n_done"),
    )


def language_totals(languages: DataFrame) -> DataFrame:
    """Languages that gave items, out of all, and their percentage."""
    totals = languages.agg(
        F.count(F.lit(1)).alias("n_languages"),
        F.count_if(F.col("n_items") > 0).alias("n_succeeded"),
        F.coalesce(F.sum("n_files"), F.lit(0)).alias("n_files"),
        F.coalesce(F.sum("n_items"), F.lit(0)).alias("n_items"),
    )
    return totals.withColumn("success_rate", _share(F.col("n_succeeded"), F.col("n_languages"), 0.0))


def file_stats(rows: DataFrame, file: str = "raw_file_path", size: str | None = None) -> DataFrame:
    """Per-file stat rows of a finished preprocessing run."""
    measures = [F.count(F.lit(1)).alias("n_sample")]
    if size:
        measures.append(F.max(size).alias("input_file_size_bytes"))
    return rows.groupBy(file).agg(*measures).withColumn("processing_complete", F.lit(True))


def resume_counts(source: DataFrame, remaining: DataFrame, given: list[str]) -> DataFrame:
    """Rows, rows whose uid had to be made, rows skipped and rows left.

    ``given`` are the columns that may hold a row's own key.
    """
    own = [F.col(c).cast("string") for c in given if c in source.columns]
    made = F.coalesce(*own).isNull() if own else F.lit(True)
    first = source.select(made.cast("int").alias("made"), F.lit(0).alias("left"), F.lit(1).alias("row"))
    second = remaining.select(F.lit(0).alias("made"), F.lit(1).alias("left"), F.lit(0).alias("row"))
    counts = first.unionByName(second).agg(
        F.coalesce(F.sum("row"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("made"), F.lit(0)).alias("n_uid_made"),
        F.coalesce(F.sum("left"), F.lit(0)).alias("n_remaining"),
    )
    return counts.withColumn("n_skipped", F.col("n_rows") - F.col("n_remaining"))


def generation_summary(results: DataFrame, status: str = "status") -> DataFrame:
    """Successes, errors and success rate of a staged generation run."""
    counted = results.agg(
        F.count(F.lit(1)).alias("completed"),
        F.count_if(_is(status, "success")).alias("success"),
        F.count_if(_is(status, "error")).alias("error"),
    )
    return counted.withColumn("success_rate", _share(F.col("success"), F.col("completed"), 0.0))
