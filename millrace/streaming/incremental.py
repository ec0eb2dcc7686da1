"""Growing folders: each new file is processed once, results are appended.

The stream's checkpoint is the progress record, so a restart goes on after the
last finished batch. A batch is written to a folder of its own, replaced if the
batch is repeated: a restart in mid-write neither loses nor doubles rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.filters import successes


def read_increments(
    spark: SparkSession, path: str, schema: T.StructType, file_format: str = "json", files_per_batch: int | None = None
) -> DataFrame:
    """A stream over a folder (or glob) of files."""
    reader = spark.readStream.schema(schema).format(file_format)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def append_increments(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    status: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Append each batch's result below ``out``, partitioned by batch.

    With a ``status`` column only successful rows go to ``out/success`` and
    failed ones to ``out/error``, both from the batch as written to ``out/all``.
    ``every`` is the flush interval; without it the stream ends once all files
    that are there have been read.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        result = transform(batch)
        if status is None:
            result.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
            return
        staged = f"{out}/all/batch={batch_id}"
        result.write.mode("overwrite").parquet(staged)
        rows = batch.sparkSession.read.schema(result.schema).parquet(staged)
        successes(rows, status).write.mode("overwrite").parquet(f"{out}/success/batch={batch_id}")
        rows.filter(~F.col(status).eqNullSafe("success")).write.mode("overwrite").parquet(f"{out}/error/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def run_available(stream: DataFrame, out: str, checkpoint: str, **options) -> None:
    """Process what is there now and stop."""
    query = append_increments(stream, out, checkpoint, **options)
    query.awaitTermination()
