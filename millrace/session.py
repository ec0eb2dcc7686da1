"""Session settings and the shared staging folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings the operators count on. Skewed anti joins are split by AQE at run
#: time, and speculation stays off because a second attempt would repeat paid
#: model calls.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.speculation": "false",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with ``SETTINGS`` applied; ``conf`` overrides single keys."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for what runs inside, and the old ones after."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def staging_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    Only a local session without the setting gets a temporary folder; on a
    cluster a machine-local folder would be lost with its machine, so a missing
    setting is an error there.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-stage-"))
    return context.getCheckpointDir()


def new_stage_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the staging folder."""
    return f"{staging_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage", path: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet and go on from the written table.

    Used wherever a result must not be computed twice, above all model calls:
    splitting one lazy plan into success and error branches would repeat them.
    The written table survives lost executors and keeps column pruning.
    """
    spark = df.sparkSession
    path = path or new_stage_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
