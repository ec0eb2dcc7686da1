"""Bounded samples of labelled rows, and the split that keeps rows out of training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_column: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as remainder -1, in no fold."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % divisor, F.lit(-1))


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, training: Column, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """Up to ``per_class`` training texts of each label, the same at every run, and how many rows each label has.

    ``training`` is a condition on ``doc_id``. Rows of ``labels`` with another label than
    0 and 1 are left out; a doc_id with several labels counts with the largest. At most
    2 x ``per_class`` ids are broadcast; the result has ``doc_id``, ``text``, ``label``.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.where(training).groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}
    picked = None
    for value in (0, 1):
        some = known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = some if picked is None else picked.unionByName(some)
    texts = documents.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    return texts.select("doc_id", "text", "label"), counts
