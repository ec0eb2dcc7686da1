"""Row ordinals and the operators that rest on them: splits, shards, limits.

A window without partitions would send the whole table to one task. Rows are dealt
by ranges of the whole order instead and numbered inside each range; the number of
rows in the ranges before gives the rest.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from millrace.session import stage

#: Bits of ``monotonically_increasing_id`` that count rows inside a task; the task's number is above them.
_PLACE_BITS = 33


def with_ordinal(
    df: DataFrame, order: list[Column | str], name: str = "ord", ranges: int | None = None
) -> tuple[DataFrame, int]:
    """Number the rows 1, 2, ... by ``order``; also returns how many there are.

    ``order`` must be total and may be of any sortable types, nulls first. Rows are
    dealt by ranges of the whole order, so neither a frequent first value nor nulls
    gather in one task. ``ranges`` is the number of tasks; without it Spark takes
    ``spark.sql.shuffle.partitions`` and merges small ones.

    The full rows move once and are written in the staging folder with their place,
    so the numbers stay the same whatever is computed again. One count per range
    reaches the driver.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    dealt = df.repartitionByRange(ranges, *keys) if ranges else df.repartitionByRange(*keys)
    placed = dealt.sortWithinPartitions(*keys).withColumn("_place", F.monotonically_increasing_id())
    staged = stage(placed, "ordinals")
    span = F.shiftright("_place", _PLACE_BITS)
    inside = F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)) + 1
    spanned = staged.withColumns({"_span": span.cast("int"), name: inside})
    starts, total = _starts(spanned.groupBy("_span").agg(F.count(F.lit(1)).alias("_n")))
    return spanned.join(starts, "_span").withColumn(name, F.col(name) + F.col("_start")).drop("_span", "_start", "_place"), total


def _starts(sums: DataFrame) -> tuple[DataFrame, int]:
    """``_span`` and what the spans before it add up to (``_start``), from ``_span``, ``_n`` of each; and the sum of all.

    There are as many spans as tasks that wrote them: the table is broadcast.
    """
    total, rows = 0, []
    for r in sorted(sums.collect(), key=lambda r: r["_span"]):
        rows.append((r["_span"], total))
        total += r["_n"]
    return F.broadcast(sums.sparkSession.createDataFrame(rows, "_span int, _start bigint")), total


#: Blocks up to this number (some 100 bytes each) are broadcast to the rows that lie in them.
BROADCAST_BLOCKS = 200_000


def running_sums(df: DataFrame, order: list[Column | str], value: str, name: str) -> tuple[DataFrame, int]:
    """Adds ``name``: the sum of ``value`` over the rows before, by ``order``, which must be total; also returns the whole sum.

    A prefix scan in three steps: sums inside ranges of the order, one sum per range
    through the driver, and both added up. No window holds more than one range.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    staged = stage(df.repartitionByRange(*keys).withColumn("_span", F.spark_partition_id()), "sums")
    before = Window.partitionBy("_span").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    starts, total = _starts(staged.groupBy("_span").agg(F.sum(value).alias("_n")))
    summed = staged.withColumn(name, F.coalesce(F.sum(value).over(before), F.lit(0)))
    return summed.join(starts, "_span").withColumn(name, F.col(name) + F.col("_start")).drop("_span", "_start"), total


def number_in_blocks(df: DataFrame, block: list[str], order: list[Column | str], name: str = "ord") -> tuple[DataFrame, int]:
    """Number rows 1, 2, ... that already stand in order inside their blocks; also returns how many there are.

    ``block`` names a block, such as a part of a file that one task reads from its start to
    its end; ``order`` (columns, rising) puts blocks in order. No row moves: rows are written once
    with their place, blocks are counted, and a prefix scan over these counts gives each block's
    start: on the driver for up to ``BROADCAST_BLOCKS`` blocks, by ``running_sums`` and a join beyond.
    """
    staged = stage(df.withColumn("_place", F.monotonically_increasing_id()), "places")
    blocks = staged.groupBy(*block).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    keys = [(F.col(c) if isinstance(c, str) else c).alias(f"_key{i}") for i, c in enumerate(order)]
    few = blocks.select(*block, "_first", "_rows", *keys).limit(BROADCAST_BLOCKS + 1).collect()
    if len(few) <= BROADCAST_BLOCKS:
        total, rows = 0, []
        for r in sorted(few, key=lambda r: [r[f"_key{i}"] for i in range(len(order))]):
            rows.append((*(r[b] for b in block), total - r["_first"] + 1))
            total += r["_rows"]
        schema = T.StructType([*blocks.select(*block).schema, T.StructField("_shift", T.LongType())])
        shifts = F.broadcast(df.sparkSession.createDataFrame(rows, schema))
    else:
        starts, total = running_sums(blocks, order, "_rows", "_before")
        shifts = stage(starts.select(*block, (F.col("_before") - F.col("_first") + 1).alias("_shift")), "shifts")
    return staged.join(shifts, block).withColumn(name, F.col("_place") + F.col("_shift")).drop("_place", "_shift"), total


def split_rows(
    df: DataFrame,
    order: list[Column | str],
    chunks: int | None = None,
    rows_per_chunk: int | None = None,
    stem: str = "part",
) -> DataFrame:
    """Contiguous chunks of equal size; the last ones may be short or missing.

    Adds ``ord``, ``chunk`` (from 1) and ``chunk_name``.
    """
    if chunks is None and rows_per_chunk is None:
        raise ValueError("give chunks or rows_per_chunk")
    return in_chunks(*with_ordinal(df, order), chunks, rows_per_chunk, stem)


def in_chunks(numbered: DataFrame, total: int, chunks: int | None, rows_per_chunk: int | None, stem: str) -> DataFrame:
    """Rows numbered by ``ord`` with their ``chunk`` and ``chunk_name``."""
    size = math.ceil(total / chunks) if chunks is not None else rows_per_chunk
    chunk = F.expr(f"CAST((ord - 1) DIV {max(size, 1)} + 1 AS INT)")
    named = F.coalesce(chunk_name(stem, F.col("chunk")), F.lit(""))  # never null: a sorted write need not sort again
    return numbered.withColumn("chunk", chunk).withColumn("chunk_name", named)


def chunk_name(stem: str, chunk: Column) -> Column:
    number = F.when(chunk < 10_000, F.lpad(chunk.cast("string"), 4, "0")).otherwise(chunk.cast("string"))
    return F.concat(F.lit(f"{stem}_split_"), number)


def first_n_per_group(
    df: DataFrame, by: list[str], order: list[Column | str], n: int, parts: int = 64
) -> DataFrame:
    """The first n rows of each group.

    Each group is first cut in ``parts`` parts of which n rows each remain, so that
    no task sorts a whole group; for small n Spark also cuts ranks before rows move.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in order]

    def cut(frame: DataFrame, groups: list[str]) -> DataFrame:
        position = F.row_number().over(Window.partitionBy(*groups).orderBy(*keys))
        return frame.withColumn("_rn", position).filter(F.col("_rn") <= n).drop("_rn")

    parted = df.withColumn("_part", F.pmod(F.xxhash64(*keys), F.lit(parts)))
    return cut(cut(parted, [*by, "_part"]).drop("_part"), by)


def limit_files(listing: DataFrame, n: int, language: str | None = None, path: str = "path") -> DataFrame:
    """The first n files, or ``max(1, n // languages)`` per language; n < 1 keeps all."""
    if n < 1:
        return listing
    if language is None:
        return listing.orderBy(path).limit(n)
    languages = listing.select(language).distinct().count()
    return first_n_per_group(listing, [language], [path], max(1, n // max(languages, 1)))


def in_order(listing: DataFrame, path: str = "path") -> DataFrame:
    """The listing with each file's ``position`` (from 1) in the order of paths."""
    return with_ordinal(listing, [path], "position")[0]


def shard_files(listing: DataFrame, index: int, world: int, path: str = "path") -> DataFrame:
    """Block number ``index`` of ``world`` equal blocks of the sorted listing."""
    if world <= 1:
        return listing
    numbered, total = with_ordinal(listing, [path], "_pos")
    size = max(1, math.ceil(total / world))
    return numbered.filter((F.col("_pos") > index * size) & (F.col("_pos") <= (index + 1) * size)).drop("_pos")


def spread(df: DataFrame, key: str, seed: int = 0, tasks: int | None = None) -> DataFrame:
    """Rows in a reproducible random order, spread evenly over the tasks.

    Rows are dealt in turn, so that neither a frequent key nor equal rows end up in
    one task; Spark sorts before it deals, so a repeated task deals alike. The number
    of tasks is fixed: AQE would otherwise merge them by bytes, while the work that
    follows is a call per row.
    """
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return df.repartition(tasks).sortWithinPartitions(F.xxhash64(F.col(key), F.lit(seed)), row_hash(df, seed))


def row_hash(df: DataFrame, seed: int = 0) -> Column:
    """Hash over all columns that can be hashed."""
    columns = [F.col(f.name) for f in df.schema if not isinstance(f.dataType, T.MapType)]
    return F.xxhash64(F.lit(seed), *columns)
