"""Resume against a huge done table: its keys are laid out once and never shuffled again.

The keys of finished rows are a table bucketed by key. A resume shuffles only source rows
that may be done to the buckets' layout; the done side is read where it lies. Two kinds of
rows skip the join. A Bloom filter over the keys, if its size is within bounds, says of most
pending rows that they are pending. And the source's most frequent keys, which would gather
in one bucket each, are looked up on their own: they are few, so their rows are kept or
dropped by a list.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.operators.resume import Key, _has_key, distinct_keys, key_columns
from millrace.session import new_stage_path

#: Bits for each key, and bits set by one: about one pending key in 120 goes through the join.
BITS_PER_KEY, HASHES = 10, 7
#: Bits of a filter's block, whose bits a key sets, and of the largest filter that is broadcast (32 MB).
BLOCK_BITS, MOST_BITS = 1 << 15, 1 << 28
#: Frequent source keys that are looked up on their own.
FREQUENT = 100


def write_done(done: DataFrame, key: Key, name: str, buckets: int) -> DataFrame:
    """The distinct keys of ``done`` as the table ``name``, bucketed and sorted by key; keys with a null part are left out.

    ``buckets`` fixes the layout that later resumes are shuffled to: take as many as a
    resume has tasks. Files go to the staging folder unless the table exists already.
    """
    spark, names = done.sparkSession, key_columns(key)
    keys = distinct_keys(done, key).distinct()
    # Each task writes one bucket.
    writer = keys.repartition(buckets, *names).write.format("parquet").option("path", new_stage_path(spark, "done-keys"))
    writer.bucketBy(buckets, *names).sortBy(*names).mode("errorifexists").saveAsTable(name)
    return spark.table(name)


@dataclass(frozen=True)
class KeyFilter:
    """A Bloom filter cut into blocks; a key's bits lie in one block, so blocks are built apart."""

    blocks: np.ndarray  # blocks x bytes

    @classmethod
    def of(cls, done: DataFrame, key: Key, most_bits: int = MOST_BITS) -> KeyFilter | None:
        """The filter over a table of distinct keys; None if it would pass ``most_bits``."""
        count = done.count()
        blocks = max(1, math.ceil(count * BITS_PER_KEY / BLOCK_BITS))
        if blocks * BLOCK_BITS > most_bits:
            return None

        def build(table: pa.Table) -> pa.Table:
            bits = np.zeros(BLOCK_BITS, np.uint8)
            bits[_places(table["hash"].to_numpy()).ravel()] = 1
            return pa.table({"block": table["block"][:1], "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

        hashed = done.select(_hash(key).alias("hash")).withColumn("block", _block(F.col("hash"), blocks))
        built = np.zeros((blocks, BLOCK_BITS // 8), np.uint8)
        for r in hashed.groupBy("block").applyInArrow(build, "block long, bits binary").collect():
            built[r.block] = np.frombuffer(r.bits, np.uint8)
        return cls(built)

    def may_hold(self, spark: SparkSession, key: Key) -> Column:
        """False only for keys that the table lacks."""
        shared = spark.sparkContext.broadcast(self.blocks)

        @F.pandas_udf(T.BooleanType())
        def look(blocks: pd.Series, hashes: pd.Series) -> pd.Series:
            places = _places(hashes.to_numpy(np.int64))
            held = shared.value[blocks.to_numpy(np.int64)[:, None], places >> 3]
            return pd.Series(((held >> (7 - (places & 7)).astype(np.uint8)) & 1).all(axis=1))

        return look(_block(_hash(key), len(self.blocks)), _hash(key))


def _hash(key: Key) -> Column:
    return F.xxhash64(*key_columns(key))


def _block(hashed: Column, blocks: int) -> Column:
    return F.pmod(F.shiftright(hashed, 40), F.lit(blocks).cast("long"))


def _places(hashes: np.ndarray) -> np.ndarray:
    """The bits of each hash in its block: two parts of it, added in turn."""
    low = hashes.astype(np.uint64)[:, None]
    step = (low >> np.uint64(20)) | np.uint64(1)
    return ((low + np.arange(HASHES, dtype=np.uint64) * step) % np.uint64(BLOCK_BITS)).astype(np.int64)


def frequent_keys(source: DataFrame, key: str, most: int = FREQUENT) -> list:
    """Up to ``most`` of the source's most frequent keys, by a sketch that merges in the aggregation."""
    sketch = F.call_function("approx_top_k", F.col(key), F.lit(most), F.lit(10 * most))
    found = source.where(F.col(key).isNotNull()).agg(sketch.alias("top")).first()
    return [r["item"] for r in found.top] if found and found.top else []


def pending_against(source: DataFrame, done: DataFrame, key: Key, bloom: KeyFilter | None = None, frequent: int = FREQUENT) -> DataFrame:
    """Source rows whose key is not in ``done``, a table of ``write_done``; rows without a key are always pending.

    The result equals that of ``operators.resume.pending``. ``frequent`` keys at most, of a key
    of one column, are looked up by value.
    """
    spark, names = source.sparkSession, key_columns(key)
    parts = [source.where(~_has_key(key))]
    rest = source.where(_has_key(key))
    if len(names) == 1 and frequent and (top := frequent_keys(source, names[0], frequent)):
        known = {r[0] for r in done.where(F.col(names[0]).isin(top)).collect()}
        parts.append(rest.where(F.col(names[0]).isin([k for k in top if k not in known])))
        rest = rest.where(~F.col(names[0]).isin(top))
    if bloom is not None:
        rest = rest.withColumn("_may", bloom.may_hold(spark, key))
        parts.append(rest.where("not _may").drop("_may"))
        rest = rest.where("_may").drop("_may")
    # A merge join reads both sides in the buckets' layout; a broadcast of the done side would be larger.
    found = rest.join(done.hint("merge"), names, "left_anti").select(source.columns)
    for part in parts:
        found = found.unionByName(part)
    return found
