"""Runs that commit as they go: kills, reruns, flushes by size and time, limits over all tasks."""

import glob
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from millrace.functions.chatml import message
from millrace.operators.calls import CallPolicy, call_with_retry
from millrace.operators.limits import Gate, share
from millrace.plans.committed import Flush, committed, generate_committed
from millrace.sources.commits import CommitLog

FAST = CallPolicy(concurrency=4, attempts=1, wait_factor=0.0, wait_min=0.0)


def asked(spark, n, first=0):
    rows = spark.range(first, first + n).select(F.col("id").cast("string").alias("uid"), F.col("id").alias("n"))
    return rows.withColumn("messages", F.array(message("user", F.col("uid"))))


def logged(folder):
    """A transport that notes each call in a file of its worker's own."""
    os.makedirs(folder, exist_ok=True)

    def transport(messages, chat):
        with open(f"{folder}/{os.getpid()}", "a") as out:
            out.write(messages[0]["content"] + "\n")
        if messages[0]["content"].endswith("7"):
            raise ValueError("no")
        return "ok " + messages[0]["content"]

    return transport


def calls(folder):
    return sorted(int(x) for name in os.listdir(folder) for x in open(f"{folder}/{name}").read().split())


class Killed(RuntimeError):
    pass


def killed_after(commits):
    left = [commits]

    def hook(entry):
        left[0] -= 1
        if not left[0]:
            raise Killed

    return hook


def test_no_row_is_called_twice_after_a_kill(spark, tmp_path):
    rows, root, log = asked(spark, 100), str(tmp_path / "run"), str(tmp_path / "calls")
    with pytest.raises(Killed):
        generate_committed(rows, logged(log), root, FAST, Flush(rows=15), on_commit=killed_after(3))
    begun = calls(log)
    assert committed(spark, root).count() == len(begun) and 30 <= len(begun) < 100
    found = generate_committed(rows, logged(log), root, FAST, Flush(rows=15)).collect()
    assert calls(log) == list(range(100))
    assert sorted(r.n for r in found) == list(range(100))
    assert {r.status for r in found if r.uid.endswith("7")} == {"error"}
    assert all(r.response == f"ok {r.n}" for r in found if not r.uid.endswith("7"))
    # A third run has nothing to do; new rows are called alone.
    generate_committed(rows, logged(log), root, FAST, Flush(rows=15))
    assert generate_committed(asked(spark, 110), logged(log), root, FAST, Flush(rows=15)).count() == 110
    assert calls(log) == list(range(110))


def test_what_was_written_but_not_committed_is_never_read(spark, tmp_path):
    rows, root, log = asked(spark, 40), str(tmp_path / "run"), str(tmp_path / "calls")
    generate_committed(rows, logged(log), root, FAST, Flush(rows=10))
    part = committed(spark, root).limit(5)
    part.write.parquet(f"{root}/parts/run=0002/slice=000000/part=0000")
    assert committed(spark, root).count() == 40
    assert generate_committed(asked(spark, 45), logged(log), root, FAST, Flush(rows=10)).count() == 45


def test_flush_by_time(spark, tmp_path):
    """A slice whose time is up is committed as far as it came; the rest follows in further parts."""
    rows, root = asked(spark, 60), str(tmp_path / "run")

    def slow(messages, chat):
        time.sleep(0.1)
        return "ok"

    found = generate_committed(rows, slow, root, CallPolicy(concurrency=1, attempts=1), Flush(rows=1000, seconds=0.7), tasks=2)
    entries = CommitLog(spark, root, "path string, part int, n_rows long, n_later long").entries().orderBy("part").collect()
    assert len(entries) > 1 and sum(e.n_rows for e in entries) == 60 and entries[-1].n_later == 0
    assert found.select("uid").distinct().count() == found.count() == 60


def test_slices_at_once_and_empty_input(spark, tmp_path):
    found = generate_committed(asked(spark, 50), lambda m, c: "ok", str(tmp_path / "a"), FAST, Flush(rows=10, at_once=3))
    assert found.where("response = 'ok'").count() == 50
    assert generate_committed(asked(spark, 0), lambda m, c: "ok", str(tmp_path / "b"), FAST).collect() == []


def test_limits_over_all_tasks(spark, tmp_path):
    """Workers note when calls begin and end; never more than the limit are open, stuck ones included."""
    folder = str(tmp_path / "spans")
    os.makedirs(folder)

    def noted(messages, chat):
        begin = time.time()
        time.sleep(0.5 if messages[0]["content"].endswith("3") else 0.05)
        with open(f"{folder}/{os.getpid()}-{threading.get_ident()}", "a") as out:
            out.write(f"{begin} {time.time()}\n")
        return "ok"

    policy = CallPolicy(concurrency=20, attempts=2, wait_factor=0.0, wait_min=0.0, deadline=0.2, total=5)
    rows = generate_committed(asked(spark, 80), noted, str(tmp_path / "run"), policy, tasks=3)
    assert {r.status for r in rows.collect() if not r.uid.endswith("3")} <= {"success", "error"}
    time.sleep(0.6)
    spans = [tuple(map(float, line.split())) for name in os.listdir(folder) for line in open(f"{folder}/{name}")]
    edges = sorted([(b, 1) for b, _ in spans] + [(e, -1) for _, e in spans])
    open_, most = 0, 0
    for _, step in edges:
        open_ += step
        most = max(most, open_)
    assert 1 < most <= 5


def test_shares_add_up():
    for total, tasks in ((7, 3), (3, 3), (100, 9)):
        assert sum(share(total, tasks, i) for i in range(tasks)) == total
    assert CallPolicy(total=3).for_tasks(200).tasks == 3 and CallPolicy().for_tasks(200).tasks == 200
    with pytest.raises(ValueError):
        CallPolicy(total=3).gate(0)


def test_gate_keeps_a_permit_until_the_call_ends():
    gate, ended = Gate(2), threading.Event()
    policy = CallPolicy(concurrency=2, attempts=4, wait_factor=0.0, wait_min=0.0, deadline=0.05)
    open_ = []

    def stuck(messages, chat):
        open_.append(1)
        ended.wait(5)
        return "late"

    _, attempts, kind, error, *_ = call_with_retry(stuck, None, policy, {"messages": []}, gate)
    assert (attempts, kind, error) == (4, "call", "TimeoutError: no call could begin within 0.05 s") and len(open_) == 2
    ended.set()
    time.sleep(0.2)
    assert gate.open == 0 and call_with_retry(lambda m, c: "good", None, policy, {"messages": []}, gate)[0] == "good"


def test_gate_slows_down_and_recovers():
    gate = Gate(8, adaptive=True)
    for _ in range(10):
        gate.report(False)
    assert gate.allowed == 1
    for _ in range(100):
        gate.report(True)
    assert gate.allowed == 8


def test_pace():
    gate, start = Gate(10, per_minute=1200), time.monotonic()
    for _ in range(6):
        gate.enter()
        gate.leave()
    assert 0.2 < time.monotonic() - start < 1.0


def test_an_entry_counts_once(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path), "a int, s string")
    assert log.entries().collect() == [] and log.names() == []
    log.enter("one", {"a": 1, "s": "ü\n"})
    with pytest.raises(FileExistsError):
        log.enter("one", {"a": 2, "s": "x"})
    assert [tuple(r) for r in log.entries().collect()] == [(1, "ü\n")] and log.names() == ["one"]


def test_a_large_slice_is_dealt_to_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("millrace.plans.committed.DEALT_BYTES", 300)
    root, log = str(tmp_path / "run"), str(tmp_path / "calls")
    found = generate_committed(asked(spark, 200), logged(log), root, FAST, Flush(rows=50))
    assert calls(log) == list(range(200)) and found.count() == 200
    (slices,) = glob.glob(f"{root}/_requests/*/slices")
    sizes = [(len(glob.glob(f"{s}/*.parquet")), spark.read.parquet(s).count()) for s in glob.glob(f"{slices}/slice=*")]
    assert len(sizes) == 4 and all(files > 1 and 40 <= n <= 60 for files, n in sizes)
