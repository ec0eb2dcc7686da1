"""Times headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (cores), BENCH_QUERIES (names,
comma separated; optional). All queries run once to warm the session up
and then once more, timed. Results go to Spark's no-op sink: all rows and columns
are worked out, none are kept.
"""

from __future__ import annotations

import json
import os
import platform
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pyspark  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from millrace import build_session  # noqa: E402
from millrace.catalog import entries  # noqa: E402
from millrace.catalog.inputs import requests, table  # noqa: E402
from millrace.functions.identity import stable_uid  # noqa: E402
from millrace.operators.calls import CallPolicy  # noqa: E402
from millrace.operators.resume import pending  # noqa: E402
from millrace.plans.generation import generate  # noqa: E402
from millrace.session import new_stage_path  # noqa: E402
from millrace.sources.jsonl import write_jsonl  # noqa: E402

HEADLINE = (
    "jb1 jb2 jb3 jb4 jb5 jb6 jb7 jb8 jb9 jb10 jb11 jb12 jn1 jn2 jn3 se3 se6 sp1 st2 st5 st6 st7 st9 st15 st19 st24 "
    "io2 ag2 ag5 ag6 ag9 ud5"
).split()


def instant(messages, chat):
    return "ok"


def generation_overhead(spark, sf):
    """Every document as a task, with a model that answers at once."""
    return generate(requests(spark, sf), instant, CallPolicy(concurrency=20)).select("uid", "response", "status")


def resume_filter(spark, sf):
    """Every event as a task, half of the users' events done."""
    events = table(spark, sf, "events").withColumn("uid", F.md5(F.col("event_id").cast("string").cast("binary")))
    return pending(events, events.filter(F.col("user_id") < 75), "uid")


def uid_hashing(spark, sf):
    rows = requests(spark, sf).drop("uid", "id")
    return rows.select(stable_uid(rows).alias("uid"))


def json_write(spark, sf):
    path = new_stage_path(spark, "bench")
    write_jsonl(table(spark, sf, "documents"), path)
    return spark.range(0)


EXTRA = {f.__name__: f for f in (generation_overhead, resume_filter, uid_hashing, json_write)}


def seconds(run, spark, sf) -> float:
    start = time.perf_counter()
    run(spark, sf).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    settings = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "12g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="millrace-bench-"),
    }
    spark = build_session("millrace-bench", f"local[{cpus}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    known = {**EXTRA, **{name: entry.run for name, entry in entries().items()}}
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or [*EXTRA, *HEADLINE]
    for name in names:
        seconds(known[name], spark, sf)
    times = {name: seconds(known[name], spark, sf) for name in names}
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf).removeprefix("sf"),
        "cpus": int(cpus),
        "spark": pyspark.__version__,
        "python": platform.python_version(),
        "run": "warm",
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
