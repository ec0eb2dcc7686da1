"""Runs whose results are committed while they go on.

A run's rows are dealt out to slices. A slice is called, written and entered in the commit
log, by size (its number of rows) or by time (what had begun when its time was up; the rest
of the slice comes next). A run that dies loses the slices that were open. A rerun reads
the log, leaves out what committed parts hold and goes on with the rest.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from millrace.operators.calls import LATER, CallPolicy, Transport, calling_tasks
from millrace.operators.ordinals import spread
from millrace.operators.resume import Key, key_columns, pending
from millrace.plans.generation import called_requests, request_key, with_outcome
from millrace.functions.identity import with_uid
from millrace.sources.commits import CommitLog, read_parts
from millrace.sources.tables import bytes_below

ENTRY = "path string, run int, slice int, part int, n_rows long, n_later long"
#: One task deals about so many bytes of a slice, as written.
DEALT_BYTES = 32 << 20
#: Stands for a row's place in its run while its slice is called.
_PLACE = "_place"

#: Adds a ``call`` column (``CALL_RESULT``) to rows, within a policy.
Caller = Callable[[DataFrame, CallPolicy], DataFrame]


@dataclass(frozen=True)
class Flush:
    """When results are committed: after ``rows`` calls, or ``seconds`` after a slice began; ``at_once`` slices are open together."""

    rows: int = 10_000
    seconds: float | None = None
    at_once: int = 1


def committed(spark: SparkSession, root: str) -> DataFrame | None:
    """The rows of all committed parts, with their ``call``; None before the first commit."""
    paths = [r.path for r in CommitLog(spark, root, ENTRY).entries().select("path").collect()]  # one per commit
    if not paths:
        return None
    return read_parts(spark, sorted(paths), spark.read.parquet(paths[0]).schema)


def run_committed(
    rows: DataFrame,
    key: Key,
    caller: Caller,
    root: str,
    policy: CallPolicy = CallPolicy(),
    flush: Flush = Flush(),
    tasks: int | None = None,
    seed: int = 0,
    on_commit: Callable[[dict], None] | None = None,
) -> DataFrame | None:
    """Call every row that no committed part below ``root`` holds yet; returns all committed rows.

    Rows are known by ``key``; of a key that is committed no row is called again, rows
    without a key are called at every run. ``tasks`` tasks call for one slice. Limits of
    ``policy`` over all tasks hold over all open slices. ``on_commit`` gets each entry; what
    it raises ends the run. Schemas of all runs below one ``root`` must agree.
    """
    spark = rows.sparkSession
    log = CommitLog(spark, root, ENTRY)
    earlier = committed(spark, root)
    if earlier is not None:
        rows = pending(rows, earlier.select(*key_columns(key)), key)
    run = 1 + max((int(n.split("-")[0]) for n in log.names()), default=0)
    slices = _dealt(rows, key_columns(key)[0], f"{root}/_requests/run-{run:04d}-{uuid.uuid4().hex[:8]}", flush.rows, seed)
    if policy.total is not None:
        policy = replace(policy, total=max(1, policy.total // flush.at_once))
    if policy.per_minute is not None:
        policy = replace(policy, per_minute=policy.per_minute / flush.at_once)
    policy = replace(policy.for_tasks(tasks or calling_tasks(spark)), budget=flush.seconds)

    def one(number: int) -> None:
        for entry in _called_slice(slices.where(F.col("slice") == number).drop("slice"), caller, policy, root, run, number, seed):
            log.enter(f"{run:04d}-{number:06d}-{entry['part']:04d}", entry)
            if on_commit:
                on_commit(entry)

    numbers = [r.slice for r in slices.select("slice").distinct().orderBy("slice").collect()]  # one per commit to come
    with ThreadPoolExecutor(max_workers=flush.at_once) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(one), n) for n in numbers]
        try:
            for future in futures:
                future.result()
        except BaseException:
            for future in futures:
                future.cancel()
            raise
    return committed(spark, root)


def _dealt(rows: DataFrame, key: str, path: str, size: int, seed: int) -> DataFrame:
    """The rows in random order, written once: files for each slice of about ``size`` rows, so that a slice reads its own only.

    A slice of many bytes is dealt to several tasks, so that none holds a whole slice.
    """
    counted = Observation()
    spark = rows.sparkSession
    whole = f"{path}/whole"
    rows.observe(counted, F.count(F.lit(1)).alias("n")).write.parquet(whole)
    n = max(1, math.ceil(counted.get.get("n", 0) / size))
    tasks = max(1, math.ceil(bytes_below(spark, whole) / n / DEALT_BYTES))  # for one slice
    dealt = spread(spark.read.schema(rows.schema).parquet(whole), key, seed, n * tasks)
    dealt = dealt.withColumns({"slice": F.floor(F.spark_partition_id() / tasks).cast("int"), _PLACE: F.monotonically_increasing_id()})
    dealt.write.partitionBy("slice").parquet(f"{path}/slices")
    return spark.read.schema(dealt.schema).parquet(f"{path}/slices")


def _called_slice(rows: DataFrame, caller: Caller, policy: CallPolicy, root: str, run: int, number: int, seed: int):
    """Write a slice's parts one after the other; yields their entries, the last with nothing left for later."""
    spark, part, left, most = rows.sparkSession, 0, rows, policy
    done: DataFrame | None = None
    while True:
        if done is not None:
            left = rows.join(done, _PLACE, "left_anti")
        path = f"{root}/parts/run={run:04d}/slice={number:06d}/part={part:04d}"
        seen = Observation()
        later = F.col("call.error_kind").eqNullSafe(LATER)
        called = caller(spread(left, _PLACE, seed, most.tasks), most)
        called = called.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(later).alias("later"))
        # Parts that a killed run left without an entry are replaced.
        called.where(~later).write.mode("overwrite").parquet(path)
        n, waiting = seen.get.get("n", 0), seen.get.get("later", 0)
        yield {"path": path, "run": run, "slice": number, "part": part, "n_rows": n - waiting, "n_later": waiting}
        if not waiting:
            return
        if n == waiting:
            # Not one call could begin in time: go on without a limit rather than for ever.
            most = replace(most, budget=None)
        written = spark.read.parquet(path).select(_PLACE)
        done = written if done is None else done.unionByName(written)
        part += 1


def generate_committed(
    df: DataFrame,
    transport: Transport,
    root: str,
    policy: CallPolicy = CallPolicy(),
    flush: Flush = Flush(),
    mode: str = "first_message",
    tasks: int | None = None,
    seed: int = 0,
    model_column: str | None = None,
    on_commit: Callable[[dict], None] | None = None,
) -> DataFrame:
    """Call the model for every row that ``root`` has no committed reply of; returns all rows committed so far, with their outcome.

    As ``plans.generation.generate``, but results are committed as ``flush`` says and a rerun
    repeats only what was open. Failed rows are results too: ``retry_failed`` takes them up.
    """
    rows = with_uid(df)

    def caller(slice_: DataFrame, within: CallPolicy) -> DataFrame:
        return called_requests(slice_, transport, within, mode, model_column)

    found = run_committed(rows, request_key(model_column), caller, root, policy, flush, tasks, seed, on_commit)
    if found is None:  # nothing to call, now or ever
        found = called_requests(rows.limit(0), transport, policy.for_tasks(1), mode, model_column)
    return with_outcome(found, mode).drop(_PLACE)
