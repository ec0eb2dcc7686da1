"""Response generation with resume and retry; splitting work over models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.functions.chatml import final_messages, request_messages
from millrace.functions.identity import with_uid
from millrace.operators.calls import CallPolicy, Transport, calling_tasks, with_calls
from millrace.operators.fanout import over_models
from millrace.operators.ordinals import split_rows, spread
from millrace.operators.reports import shard_summary
from millrace.operators.resume import first_per_key, pending, retry_merge
from millrace.operators.unions import merge_shards
from millrace.session import stage
from millrace.sources.listing import read_shards

ERROR_COLUMNS = ["error", "error_type", "traceback", "timestamp", "task_index"]
MISSING_MESSAGES = "The row has no message to send."


def request_key(model_column: str | None) -> list[str]:
    """What makes a request one and the same: its uid, and its model if there are several."""
    return ["uid", model_column] if model_column else ["uid"]


def pending_requests(
    df: DataFrame,
    done: DataFrame | None = None,
    dedupe: bool = False,
    seed: int = 0,
    tasks: int | None = None,
    model_column: str | None = None,
) -> DataFrame:
    """Rows to generate for: with uid, without finished ones, in random order.

    ``tasks`` is the number of tasks that will call the model. ``done`` rows
    count by their uid, made the same way if they have none, and by their model
    if there are several. On a first run rows with the same uid are all kept
    unless ``dedupe`` is set.
    """
    key = request_key(model_column)
    rows = with_uid(df)
    if done is not None:
        rows = pending(rows, done_keys(done, model_column), key)
    if dedupe:
        rows = first_per_key(rows, key, ["uid"])
    return spread(rows, "uid", seed, tasks)


def done_keys(done: DataFrame, model_column: str | None = None) -> DataFrame:
    """Keys of finished rows, without failed ones, leaving out what generation itself added."""
    if "status" in done.columns:
        done = done.where(F.coalesce(F.col("status") != "error", F.lit(True)))
    added = [c for c in ("response", "final_messages") if c in done.columns]
    return with_uid(done.drop(*added)).select(*request_key(model_column))


def generate(
    df: DataFrame,
    transport: Transport,
    policy: CallPolicy = CallPolicy(),
    done: DataFrame | None = None,
    mode: str = "first_message",
    dedupe: bool = False,
    seed: int = 0,
    tasks: int | None = None,
    model_column: str | None = None,
    staged_at: str | None = None,
) -> DataFrame:
    """Call the model for every pending row; returns successes and errors, staged.

    Columns added: ``response``, ``final_messages``, ``status``, the error
    columns, ``attempts``. Rows without a first message fail without a call.
    """
    policy = policy.for_tasks(tasks or calling_tasks(df.sparkSession))
    requests = pending_requests(df, done, dedupe, seed, policy.tasks, model_column)
    return with_outcome(stage(called_requests(requests, transport, policy, mode, model_column), "responses", staged_at), mode)


def called_requests(requests: DataFrame, transport: Transport, policy: CallPolicy, mode: str, model_column: str | None) -> DataFrame:
    """The requests with their ``call``, to be staged before anything else."""
    if "messages" not in requests.columns:
        requests = requests.withColumn("messages", F.lit(None).cast("array<struct<role:string,content:string>>"))
    model = F.col(model_column) if model_column else None
    called = with_calls(requests, asked(mode), transport, policy, model=model)
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return called.withColumns({"task_index": F.monotonically_increasing_id(), "_called_at": now})


def asked(mode: str) -> Column:
    """The messages to send; null for rows that have none."""
    return F.when(F.size("messages") > 0, request_messages(F.col("messages"), mode))


def with_outcome(called: DataFrame, mode: str = "first_message") -> DataFrame:
    """Expand a staged ``call`` column into the result and error columns."""
    lacking = asked(mode).isNull()
    kind = F.when(lacking, F.lit("input")).otherwise(F.col("call.error_kind"))
    ok = kind.isNull()
    prompt = F.element_at(asked(mode), -1)["content"]
    response = F.when(ok, F.col("call.response"))
    error = F.when(lacking, F.lit(MISSING_MESSAGES)).otherwise(F.col("call.error"))
    columns = {
        "response": response,
        "final_messages": F.when(ok, final_messages(prompt, response)),
        "status": F.when(ok, F.lit("success")).otherwise(F.lit("error")),
        "error": error,
        "error_type": kind,
        "traceback": F.col("call.traceback"),
        "timestamp": F.when(lacking, F.col("_called_at")).otherwise(F.col("call.timestamp")),
        "task_index": F.when(~ok, F.col("task_index")),
        "attempts": F.coalesce(F.col("call.attempts"), F.lit(0)),
    }
    return called.withColumns(columns).drop("call", "_called_at")


def success_rows(results: DataFrame) -> DataFrame:
    return results.filter(F.col("status") == "success").drop(*ERROR_COLUMNS, "status", "attempts")


def error_rows(results: DataFrame) -> DataFrame:
    return results.filter(F.col("status") == "error").drop("response", "final_messages", "status", "attempts")


def retry_failed(
    errors: DataFrame,
    prior: DataFrame,
    transport: Transport,
    policy: CallPolicy = CallPolicy(),
    order: tuple[str, ...] = ("uid",),
    model_column: str | None = None,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Generate again for failed rows; returns all successes and the remaining errors.

    Old error columns are dropped first. ``prior`` may be empty. Of several rows
    with one uid the first by ``order`` is kept.
    """
    results = generate(errors.drop(*ERROR_COLUMNS), transport, policy, model_column=model_column, **options)
    merged = retry_merge(prior, success_rows(results), request_key(model_column), list(order))
    return merged, error_rows(results)


def fan_out(df: DataFrame, models: list[str], order: list[str], chunks: int, stem: str = "part") -> DataFrame:
    """Chunked rows times models: the work table of a multi-model run.

    ``generate(..., model_column="model")`` then serves all models in one job.
    """
    return over_models(split_rows(df, order, chunks=chunks, stem=stem), models)


def model_summary(results: DataFrame) -> DataFrame:
    """Chunks, successes, errors and rate per model."""
    return shard_summary(results, ["model"], file="chunk_name")


def merge_results(spark: SparkSession, base: str, schema: T.StructType, merge_errors: bool = True) -> DataFrame:
    """Results of all models below ``base`` with their ``status``; retry files and broken files drop out.

    Write it partitioned by model and status; ``shard_summary`` gives the rates.
    """
    return merge_shards(read_shards(spark, base, schema), merge_errors)
