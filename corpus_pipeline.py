"""A training corpus from ``documents``: quality, toxicity, line dedup, near duplicates, packing.

Each stage takes (spark, documents, sf_dir) and works on all that its predecessor kept; ``run``
writes a stage's result as Parquet in the shared folder and reads it back for the next one.
All stages but the last return the columns of ``documents``.

Odd rows, in every stage: a null text counts as empty and stays null; empty and blank
texts get a score like any other, share no line and are nobody's near copy; repeated rows
are judged alike, and of near or exact copies, repeated rows among them, one row stays; a
row without a doc_id is scored and packed, is no first holder of a line and ranks last
among copies; an empty table gives an empty one. Texts are read whole, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import jaccard, lines, packing, quality, toxicity
from millrace.llm.catalog import PACKED_END, VOCABULARY, table
from millrace.session import stage


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained outside its held-out fold, doesn't reject."""
    model = quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity scorer, trained outside its held-out fold, doesn't reject."""
    lexicon = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, lexicon)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many sources share stay only where they occur first; a document of which nothing is left goes."""
    cleaned = lines.remove_shared_lines(docs, unknown_sites=True)
    left = cleaned.where((F.col("lines_removed") == 0) | (F.btrim("text", F.lit(" \t\r\n")) != ""))
    text_length = F.when(F.col("lines_removed") > 0, F.length("text")).otherwise(F.col("n_chars")) if "n_chars" in docs.columns else None
    return left.select(*(text_length.cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 or more of five-word shingles, one row, that of the smallest doc_id."""
    return jaccard.keep_one(docs, percent=80, size=5)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path(VOCABULARY), PACKED_END)


STAGES = [
    ("quality", quality_filter),
    ("toxicity", toxicity_filter),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("packing", pack),
]

#: SQL can express neither the classifiers nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed corpus of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
