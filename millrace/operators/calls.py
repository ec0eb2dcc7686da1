"""Model calls: batches through Python, bounded concurrency, retries, validation.

Only the messages (and a key) go to Python; the rest of the row stays in the
JVM. The transport is a function the user supplies: messages and chat parameters
in, reply text out.
"""

from __future__ import annotations

import json
import threading
import time
import traceback
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone
from typing import Any

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.functions.replies import without_surrogates
from millrace.operators.limits import Gate, share

Transport = Callable[[list[dict[str, str]], dict[str, Any]], str]

# Parameters a configuration may pass to the model.
CHAT_PARAMETERS = ("temperature", "max_tokens", "top_p", "frequency_penalty", "presence_penalty", "stop")

CALL_RESULT = T.StructType(
    [
        T.StructField("response", T.StringType()),
        T.StructField("attempts", T.IntegerType()),
        T.StructField("error_kind", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("traceback", T.StringType()),
        T.StructField("timestamp", T.StringType()),
    ]
)


def chat_parameters(config: dict[str, Any]) -> dict[str, Any]:
    """The entries of a chat configuration that may be passed on."""
    return {k: v for k, v in config.items() if k in CHAT_PARAMETERS}


#: ``error_kind`` of a row whose call had not begun when its task's time was up.
LATER = "later"
#: Replies handed on at once, at least, unless ``HAND_ON`` seconds have passed.
SLICE, HAND_ON = 2048, 5.0


@dataclass(frozen=True)
class CallPolicy:
    """Concurrency per task, retry waits, the deadline of one attempt (seconds; none by default), and limits over all tasks.

    ``total`` calls at most are open at once, and ``per_minute`` begin, in all tasks
    together; ``tasks`` says how many tasks call (``for_tasks`` sets it). ``adaptive`` lowers
    a task's concurrency when calls fail and raises it again. No call begins later than
    ``budget`` seconds after its task's first; rows left over come back with
    ``error_kind`` ``later``.
    """

    concurrency: int = 20
    attempts: int = 3
    wait_factor: float = 5.0
    wait_min: float = 4.0
    wait_max: float = 60.0
    deadline: float | None = None
    chat: dict[str, Any] = field(default_factory=dict)
    total: int | None = None
    per_minute: float | None = None
    tasks: int | None = None
    adaptive: bool = False
    budget: float | None = None

    def wait(self, attempt: int) -> float:
        return max(self.wait_min, min(self.wait_factor * 2 ** (attempt - 1), self.wait_max))

    def for_tasks(self, tasks: int) -> CallPolicy:
        """The policy of ``tasks`` calling tasks, or of fewer if the limit is smaller: each needs a permit."""
        return replace(self, tasks=max(1, min(tasks, self.total or tasks)))

    def gate(self, index: int) -> Gate:
        """The gate of task ``index``."""
        if (self.total or self.per_minute) and not self.tasks:
            raise ValueError("a limit over all tasks needs the number of tasks")
        most = self.concurrency if self.total is None else min(self.concurrency, int(share(self.total, self.tasks, index)))
        pace = None if self.per_minute is None else share(self.per_minute, self.tasks, index, whole=False)
        return Gate(most, pace, self.adaptive)


def answer_within(
    transport: Transport, messages: list[dict[str, str]], chat: dict[str, Any], deadline: float | None, gate: Gate | None = None
) -> str:
    """The transport's reply; a call that takes longer than ``deadline`` counts as failed.

    Such a call can't be stopped, but it keeps its permit until it ends: stuck calls leave
    fewer for others and never pile up.
    """
    gate = gate or Gate(1)
    if not gate.enter(deadline):
        raise TimeoutError(f"no call could begin within {deadline} s")
    if deadline is None:
        try:
            return transport(messages, chat)
        finally:
            gate.leave()
    answer: Future = Future()

    def run() -> None:
        try:
            result = transport(messages, chat)
        except BaseException as raised:
            gate.leave()
            answer.set_exception(raised)
        else:
            gate.leave()
            answer.set_result(result)

    threading.Thread(target=run, daemon=True).start()
    if not wait([answer], timeout=deadline).done:
        raise TimeoutError(f"no reply within {deadline} s")
    return answer.result()


def call_with_retry(
    transport: Transport, check: Callable[[str], str | None] | None, policy: CallPolicy, request: dict[str, Any], gate: Gate | None = None
) -> tuple:
    """One row's call; errors come back as data."""
    gate = gate or policy.gate(0)
    messages, chat = request["messages"], policy.chat
    if "model" in request:
        chat = {**chat, "model": request["model"]}
    kind = error = trace = reply = None
    for attempt in range(1, policy.attempts + 1):
        if attempt > 1:
            time.sleep(policy.wait(attempt - 1))
        try:
            reply = answer_within(transport, messages, chat, policy.deadline, gate)
        except Exception as raised:
            gate.report(False)
            kind, error, trace = "call", f"{type(raised).__name__}: {raised}", traceback.format_exc()
            continue
        gate.report(True)
        reply = without_surrogates(reply)
        try:
            problem = check(reply) if check else None
        except Exception as raised:
            problem = f"{type(raised).__name__}: {raised}"
        if problem is None:
            return reply, attempt, None, None, None, None
        kind, error, trace = "format", problem, None
    return reply, policy.attempts, kind, error, trace, datetime.now(timezone.utc).isoformat()


def model_call(
    transport: Transport, policy: CallPolicy = CallPolicy(), check: Callable[[str], str | None] | None = None
) -> Callable[..., Column]:
    """A column function from messages (and a model name) to ``CALL_RESULT``.

    Calls are kept in flight across batch borders, so one slow reply does not
    hold up a batch. Replies are handed on in slices, when there are enough or some
    time has passed, however large Spark's batches are. Calls open at once are running tasks x
    ``policy.concurrency``, or ``policy.total`` if that is less. A null message array is passed over. The
    function is marked non-deterministic: Spark then neither repeats nor moves it.
    """
    nothing = (None,) * len(CALL_RESULT)
    too_late = (None, 0, LATER, "The task's time was up.", None, None)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        gate = policy.gate(TaskContext.get().partitionId())
        waiting: deque[Future | None] = deque()
        ends = time.monotonic() + policy.budget if policy.budget is not None else None

        def one(request: str) -> tuple:
            if ends is not None and time.monotonic() >= ends:
                return too_late
            return call_with_retry(transport, check, policy, json.loads(request), gate)

        def finish(count: int) -> pd.DataFrame:
            futures = [waiting.popleft() for _ in range(count)]
            rows = [f.result() if f is not None else nothing for f in futures]
            return pd.DataFrame(rows, columns=CALL_RESULT.names, dtype=object).astype({"attempts": "Int32"})

        def ready() -> int:
            count = 0
            for f in waiting:
                if f is not None and not f.done():
                    break
                count += 1
            return count

        handed = time.monotonic()
        with ThreadPoolExecutor(max_workers=gate.most) as pool:
            for batch in batches:
                for request in batch:
                    waiting.append(None if request is None else pool.submit(one, request))
                    # What is in flight and what waits for its turn stays bounded.
                    if len(waiting) >= 2 * SLICE:
                        yield finish(max(SLICE, ready()))
                        handed = time.monotonic()
                    elif time.monotonic() - handed > HAND_ON and (count := ready()):
                        yield finish(count)
                        handed = time.monotonic()
            while waiting:
                yield finish(min(SLICE, len(waiting)))

    call = F.pandas_udf(run, CALL_RESULT).asNondeterministic()

    def column(messages: Column, model: Column | None = None) -> Column:
        parts = [messages.alias("messages")] + ([model.alias("model")] if model is not None else [])
        request = F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})
        return call(F.when(messages.isNotNull(), request))

    return column


def calling_tasks(spark: SparkSession) -> int:
    """How many tasks call unless a number is given."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def with_calls(
    df: DataFrame,
    messages: Column,
    transport: Transport,
    policy: CallPolicy = CallPolicy(),
    check: Callable[[str], str | None] | None = None,
    model: Column | None = None,
    result: str = "call",
) -> DataFrame:
    """Add the call's result as a struct column. Stage the frame before branching.

    With limits over all tasks ``policy.tasks`` must be the frame's number of partitions or more.
    """
    return df.withColumn(result, model_call(transport, policy, check)(messages, model))
