"""One input row, several runs or models."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def over_runs(df: DataFrame, runs: int) -> DataFrame:
    """Each row once per run, ``run_index`` from 1. Rows multiply where they are."""
    return df.withColumn("run_index", F.explode(F.sequence(F.lit(1), F.lit(runs))))


def over_models(df: DataFrame, models: list[str]) -> DataFrame:
    """Each row once per model name."""
    return df.withColumn("model", F.explode(F.array(*[F.lit(m) for m in models])))
