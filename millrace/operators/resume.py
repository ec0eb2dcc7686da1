"""Resume, retry and deduplication: key-set operators."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.filters import successes
from millrace.operators.ordinals import row_hash

Key = str | list[str]


def key_columns(key: Key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _has_key(key: Key) -> Column:
    """True where no part of the key is null."""
    present = F.lit(True)
    for name in key_columns(key):
        present = present & F.col(name).isNotNull()
    return present


def distinct_keys(done: DataFrame, key: Key, salts: int = 32) -> DataFrame:
    """The keys of a done table, each at most ``salts`` times.

    Counting by (key, salt) collapses a frequent key before it moves. A plain
    distinct would do so too, but the join would reuse its output partitioning,
    and AQE splits a skewed join side only if both sides are shuffles of the
    join's own.
    """
    names = key_columns(key)
    keys = done.filter(_has_key(key)).select(*names)
    salted = keys.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    return salted.groupBy(*names, "_salt").agg(F.count(F.lit(1)).alias("_n")).select(*names)


def pending(source: DataFrame, done: DataFrame, key: Key) -> DataFrame:
    """Source rows whose key is not among the done rows.

    Rows without a key are always pending. Both a frequent key and many rows
    without one make a skewed source partition, which AQE's skew join splits.
    """
    return source.join(distinct_keys(done, key), key_columns(key), "left_anti")


def carried(done: DataFrame, status: str = "api_status") -> DataFrame:
    """Earlier results that are kept: the successful ones."""
    return successes(done, status)


def resume_union(done: DataFrame, new: DataFrame, status: str = "api_status") -> DataFrame:
    """Earlier successes, whether or not their row is still in the source, plus new rows."""
    return carried(done, status).unionByName(new, allowMissingColumns=True)


def _one_per_key(df: DataFrame, key: Key, order: list[Column | str], pick) -> DataFrame:
    names = key_columns(key)
    ranks = [F.col(c) if isinstance(c, str) else c for c in order]
    rank = F.struct(*ranks, row_hash(df)).alias("_rank")
    whole = F.struct(*[F.col(c) for c in df.columns]).alias("_row")
    groups = [F.col(c).alias(f"_key{i}") for i, c in enumerate(names)]
    grouped = df.select(*groups, rank, whole).groupBy(*[f"_key{i}" for i in range(len(names))])
    return grouped.agg(pick("_row", "_rank").alias("_row")).select("_row.*")


def first_per_key(df: DataFrame, key: Key, order: list[Column | str]) -> DataFrame:
    """One row per key, the first by ``order``. Every row must have a key.

    An aggregate, not a window: each task reduces its rows to one per key before
    the shuffle, so a frequent key never meets in one task.
    """
    return _one_per_key(df, key, order, F.min_by)


def keep_first(df: DataFrame, key: Key, order: list[Column | str]) -> DataFrame:
    """One row per key, the first by ``order``; rows without a key are all kept."""
    return first_per_key(df.filter(_has_key(key)), key, order).unionByName(df.filter(~_has_key(key)))


def keep_latest(df: DataFrame, key: Key, order: list[Column | str]) -> DataFrame:
    """One row per key, the last by ``order``; rows without a key are all kept."""
    keyed = _one_per_key(df.filter(_has_key(key)), key, order, F.max_by)
    return keyed.unionByName(df.filter(~_has_key(key)))


def new_rows(existing: DataFrame, new: DataFrame, key: Key, order: list[Column | str]) -> DataFrame:
    """New rows whose key neither exists yet nor came earlier among the new ones.

    Rows without a key go past the join.
    """
    keyed = pending(new.filter(_has_key(key)), existing, key)
    return first_per_key(keyed, key, order).unionByName(new.filter(~_has_key(key)))


def retry_merge(prior: DataFrame, retried: DataFrame, key: Key, order: list[Column | str]) -> DataFrame:
    """Earlier successes plus the retried rows they do not have yet."""
    return prior.unionByName(new_rows(prior, retried, key, order), allowMissingColumns=True)


def pending_files(
    listing: DataFrame, stats: DataFrame, outputs: DataFrame | None = None, path: str = "path"
) -> DataFrame:
    """Files of a listing that still need work.

    ``stats`` has ``raw_file_path``, ``formatted_file_path`` and
    ``processing_complete``. A file is finished when its stat says so and, if
    ``outputs`` (a listing) is given, its output is still there.
    """
    finished = stats.filter(F.col("processing_complete") & (F.col("formatted_file_path") != ""))
    if outputs is not None:
        there = outputs.select(F.col(path).alias("formatted_file_path"))
        finished = finished.join(there, "formatted_file_path", "left_semi")
    return pending(listing, finished.select(F.col("raw_file_path").alias(path)), path)


