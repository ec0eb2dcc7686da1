"""Scoring rows with a model: prompt, call, contract, statuses."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, functions as F

from millrace.functions.identity import ensure_id
from millrace.functions.replies import OutputContract, with_reply_columns
from millrace.functions.templates import prompt_messages, render_prompt
from millrace.operators.calls import CallPolicy, Transport, calling_tasks, with_calls
from millrace.operators.ordinals import first_n_per_group, spread
from millrace.operators.reports import file_summary
from millrace.operators.resume import pending, resume_union
from millrace.session import stage


# How a failed row's reason begins.
CALL_FAILED = "API call failed after all retries: "
FORMAT_FAILED = "JSON format validation failed after all retries: "


@dataclass(frozen=True)
class ScoringTask:
    """What to ask and what the answer must look like."""

    template: str
    contract: OutputContract = field(default_factory=OutputContract)
    system_text: str | None = None
    input_column: str = "text"
    input_name: str = "text"

    @classmethod
    def from_config(cls, config: dict[str, Any], **options: Any) -> "ScoringTask":
        prompt = config["prompt_template"]
        return cls(
            template=prompt["prompt_text"],
            system_text=prompt.get("system_text"),
            contract=OutputContract.from_config(config.get("output_config", {})),
            **options,
        )


def request_rows(df: DataFrame, task: ScoringTask) -> DataFrame:
    """Rows with an id and the messages to send."""
    rows = ensure_id(df)
    prompt = render_prompt(rows, task.template, task.input_column, task.input_name)
    return rows.withColumn("_messages", prompt_messages(prompt, task.system_text))


def with_outcome(called: DataFrame, contract: OutputContract) -> DataFrame:
    """Turn a staged ``call`` column into contract columns and statuses.

    Failed rows stay in the table: ``api_status`` is ``error``, ``error_kind``
    says whether the call or the reply's form failed, and contract columns hold
    their defaults.
    """
    rows = called.withColumn("api_return", F.coalesce(F.col("call.response"), F.lit("")))
    if contract.require_json:
        rows = with_reply_columns(rows, "api_return", contract)
        bad_reply = F.when(F.col("reply_error").isNotNull(), F.lit("format"))
    else:
        defaults = {k: contract.default_column(k) for k in contract.columns if k in contract.defaults}
        rows = rows.withColumns(defaults) if defaults else rows
        rows = rows.withColumn("reply_error", F.lit(None).cast("string"))
        bad_reply = F.lit(None).cast("string")
    kind = F.coalesce(F.col("call.error_kind"), bad_reply)
    reason = F.coalesce(F.col("call.error"), F.col("reply_error"), F.lit(""))
    labelled = (
        F.when(kind == "call", F.concat(F.lit(CALL_FAILED), reason))
        .when(kind == "format", F.concat(F.lit(FORMAT_FAILED), reason))
        .otherwise(F.lit(""))
    )
    return (
        rows.withColumn("error_kind", kind)
        .withColumn("api_status", F.when(kind.isNull(), F.lit("success")).otherwise(F.lit("error")))
        .withColumn("api_fail_reason", labelled)
        .withColumn("api_attempts", F.col("call.attempts"))
        .drop("call", "reply_error", "_messages")
    )


def score_rows(
    df: DataFrame,
    task: ScoringTask,
    transport: Transport,
    policy: CallPolicy = CallPolicy(),
    done: DataFrame | None = None,
    debug_items: int | None = None,
    file_column: str = "source_file",
    tasks: int | None = None,
    validate: bool = True,
    staged_at: str | None = None,
) -> DataFrame:
    """Score the rows that have no success yet; returns these rows, staged.

    The resume join and the debug limit stand before the call. What is left is
    spread evenly over ``tasks`` callers, and the calls are written to a staging
    table before anything branches off them.
    """
    rows = ensure_id(df)
    if done is not None:
        rows = pending(rows, done.filter(F.col("api_status") == "success"), "id")
    if debug_items:
        rows = first_n_per_group(rows, [file_column], ["id"], debug_items)
    policy = policy.for_tasks(tasks or calling_tasks(df.sparkSession))
    requests = request_rows(spread(rows, "id", tasks=policy.tasks), task)
    check = task.contract.check if validate and task.contract.require_json else None
    called = with_calls(requests, F.col("_messages"), transport, policy, check).drop("_messages")
    return with_outcome(stage(called, "scores", staged_at), task.contract)


def score_with_resume(df: DataFrame, task: ScoringTask, transport: Transport, done: DataFrame, **options) -> DataFrame:
    """New scores together with the successes of earlier runs."""
    return resume_union(done, score_rows(df, task, transport, done=done, **options))


def scoring_stats(scored: DataFrame, file_column: str = "source_file") -> DataFrame:
    """Per-file row and success counts of a scored table."""
    return file_summary(scored, file_column, "api_status")
