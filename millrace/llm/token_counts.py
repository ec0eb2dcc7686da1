"""Token counts of documents in flat, unindexed token files.

A token file is a run of little-endian unsigned 16-bit ids; an end-of-document id
closes each document, and there is no index. Files follow one another in the
order of their names. Every block is searched for the end id in one vectorised
comparison. A prefix scan over blocks, first inside each file and then over
files, gives the number of documents before a block and the ids that its first
document already has, so documents may cross blocks and files.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.bpe import Encoder, with_encoder

#: Ids in a block.
BLOCK_IDS = 1 << 20
#: Bytes of encoded texts that leave Python at once.
BATCH_BYTES = 1 << 23


def write_token_files(documents: DataFrame, path: str, end_id: int, folder: str) -> None:
    """Write each text's ids, closed by ``end_id``, as token files with Spark's text writer.

    A row is the document's ids and the "line separator" is the end id. A null or
    empty text has no ids of its own. A text that spells the end token, such as
    "<|endoftext|>", has it encoded as ordinary text, so ``end_id`` closes documents and
    stands nowhere else; an ``end_id`` that texts could still get is refused with an error.
    A file holds what one input partition holds.
    """

    def work(encoder: Encoder, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for ids in encoder.encode(batch.column(0).to_pylist()):
                own = np.frombuffer(ids, "<u4")
                if (own == end_id).any():
                    raise ValueError(f"id {end_id} closes documents but occurs inside one")
                rows.append(own.astype("<u2").tobytes())
                size += len(ids)
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["value"])
                    rows, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["value"])

    rows = with_encoder(documents.select("text"), path, work, "value binary", plain=(end_id,))
    separator = np.array([end_id], "<u2").tobytes().decode("latin-1")
    writer = rows.select(F.col("value").cast("string").alias("value")).write.option("lineSep", separator)
    writer.option("encoding", "ISO-8859-1").text(folder)


def scan_blocks(files: DataFrame, end_id: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """One row per block of each file: its ids and the positions of its end ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.frombuffer(content.as_buffer(), "<u2")
                rows = []
                for block, start in enumerate(range(0, max(len(ids), 1), block_ids)):
                    part = ids[start : start + block_ids]
                    ends = np.flatnonzero(part == end_id)
                    rows.append((path.as_py(), block, len(part), len(ends), int(ends[-1]) + 1 if len(ends) else None, ends))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())), strict=True)],
                    names=["file", "block", "n_ids", "n_ends", "last_end", "ends"],
                )

    return files.select("path", "content").mapInArrow(
        run, "file string, block long, n_ids long, n_ends long, last_end long, ends array<long>"
    )


def count_tokens(spark: SparkSession, folder: str, end_id: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """One row per document of the token files in ``folder``: ``ordinal`` (from 0, in stream order),
    ``n_tokens`` without its end id, ``first_id`` (ids of the stream before it) and ``closed``.

    An end id right after another one makes a document of 0 tokens. Ids after the
    last end id make one more document, with ``closed`` false. Empty files and
    folders without ids give no rows. A file is read whole by one task, so writers
    keep files under 1 GB; files of other sizes may be mixed freely.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    blocks = scan_blocks(files, end_id, block_ids)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    blocks = blocks.withColumn("ends_before", F.coalesce(F.sum("n_ends").over(before), F.lit(0)))
    blocks = blocks.withColumn("last_before", F.max(F.col("start") + F.col("last_end")).over(before))
    # One row per file is scanned in one task: a few bytes for each file of up to 1 GB.
    totals = blocks.groupBy("file").agg(
        F.sum("n_ids").alias("file_ids"), F.sum("n_ends").alias("file_ends"), F.max(F.col("start") + F.col("last_end")).alias("file_last")
    )
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("file_start", F.coalesce(F.sum("file_ids").over(earlier), F.lit(0)))
    totals = totals.select(
        "file",
        "file_start",
        F.coalesce(F.sum("file_ends").over(earlier), F.lit(0)).alias("file_ends_before"),
        F.coalesce(F.max(F.col("file_start") + F.col("file_last")).over(earlier), F.lit(0)).alias("file_last_before"),
        F.lead("file").over(Window.orderBy("file")).isNull().alias("last_file"),
    )
    placed = blocks.join(totals, "file").select(
        (F.col("file_start") + F.col("start")).alias("start"),
        (F.col("file_ends_before") + F.col("ends_before")).alias("ordinal"),
        F.coalesce(F.col("file_start") + F.col("last_before"), "file_last_before").alias("open_since"),
        "n_ids",
        "n_ends",
        "last_end",
        "ends",
        (F.col("last_file") & (F.row_number().over(Window.partitionBy("file").orderBy(F.desc("block"))) == 1)).alias("last_block"),
    )
    first = F.when(F.col("k") == 0, F.col("open_since")).otherwise(F.col("start") + F.element_at("ends", F.col("k")) + 1)
    found = placed.select("*", F.posexplode("ends").alias("k", "end")).select(
        (F.col("ordinal") + F.col("k")).alias("ordinal"),
        (F.col("start") + F.col("end") - first).alias("n_tokens"),
        first.alias("first_id"),
        F.lit(True).alias("closed"),
    )
    stream_end = F.col("start") + F.col("n_ids")
    open_from = F.coalesce(F.col("start") + F.col("last_end"), F.col("open_since"))
    rest = placed.where(F.col("last_block") & (stream_end > open_from)).select(
        (F.col("ordinal") + F.col("n_ends")).alias("ordinal"), (stream_end - open_from).alias("n_tokens"), open_from.alias("first_id"), F.lit(False).alias("closed")
    )
    return found.unionByName(rest)
