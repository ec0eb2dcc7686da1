import time

from pyspark.sql import functions as F

from conftest import executed_plan, optimized_plan
from millrace.functions.chatml import message
from millrace.operators.calls import CallPolicy, call_with_retry, chat_parameters, with_calls
from millrace.session import stage

FAST = CallPolicy(concurrency=4, wait_factor=0.0, wait_min=0.0)


def asked(frame):
    return F.array(message("user", F.col("text")))


def request(text):
    return {"messages": [{"role": "user", "content": text}]}


def scripted(*outcomes):
    """A transport that plays its outcomes in turn; exceptions are raised."""
    left = list(outcomes)

    def transport(messages, chat):
        value = left.pop(0)
        if isinstance(value, Exception):
            raise value
        return value

    return transport


def test_retries_and_kinds():
    def check(reply):
        return None if reply == "good" else "bad form"

    assert call_with_retry(scripted("good"), check, FAST, request("x"))[:3] == ("good", 1, None)
    assert call_with_retry(scripted(OSError(), "odd", "good"), check, FAST, request("x"))[:3] == ("good", 3, None)
    reply, attempts, kind, error, trace, stamp = call_with_retry(scripted(*[OSError("no")] * 3), check, FAST, request("x"))
    assert (reply, attempts, kind, error) == (None, 3, "call", "OSError: no") and "OSError" in trace and stamp
    assert call_with_retry(scripted("a", "b", "c"), check, FAST, request("x"))[:4] == ("c", 3, "format", "bad form")


def test_waits():
    policy = CallPolicy()
    assert [policy.wait(i) for i in range(1, 7)] == [5.0, 10.0, 20.0, 40.0, 60.0, 60.0]


def test_parameters():
    assert chat_parameters({"model": "m", "stream": True, "top_p": 1, "stop": "x"}) == {"top_p": 1, "stop": "x"}


def test_order_nulls_and_models(spark):
    frame = spark.range(5000).select("id", F.col("id").cast("string").alias("text"), (F.col("id") % 2).cast("string").alias("model"))

    def transport(messages, chat):
        return f"{chat['model']}/{chat['top_p']}/{messages[0]['content']}"

    turns = F.when(F.col("id") % 10 != 0, asked(frame))
    policy = CallPolicy(concurrency=4, chat={"top_p": 1})
    rows = with_calls(frame, turns, transport, policy, model=F.col("model")).collect()
    assert len(rows) == 5000
    for r in rows:
        assert r.call.response == (None if r.id % 10 == 0 else f"{r.id % 2}/1/{r.id}")


def test_calls_overlap(spark):
    frame = spark.range(0, 40, 1, 1).select(F.col("id").cast("string").alias("text"))

    def slow(messages, chat):
        time.sleep(0.2)
        return "ok"

    warm = with_calls(frame.limit(1), asked(frame), slow, CallPolicy(concurrency=20))
    warm.collect()
    start = time.time()
    assert with_calls(frame, asked(frame), slow, CallPolicy(concurrency=20)).count() == 40
    with_calls(frame, asked(frame), slow, CallPolicy(concurrency=20)).collect()
    assert time.time() - start < 4.0


def test_each_row_is_called_once_after_staging(spark, tmp_path):
    log = str(tmp_path / "log")
    frame = spark.range(20).select("id", F.col("id").cast("string").alias("text"))

    def logged(messages, chat):
        with open(log, "a") as out:
            out.write(messages[0]["content"] + "\n")
        if int(messages[0]["content"]) % 4 == 0:
            raise ValueError("no")
        return "ok"

    staged = stage(with_calls(frame, asked(frame), logged, CallPolicy(attempts=1)))
    good, bad = staged.filter("call.error is null"), staged.filter("call.error is not null")
    assert (good.count(), bad.count()) == (15, 5)
    assert sorted(map(int, open(log).read().split())) == list(range(20))


def test_only_messages_go_to_python(spark, tmp_path):
    frame = spark.range(10).select("id", F.col("id").cast("string").alias("text"), F.lit("wide").alias("wide"))
    frame.write.parquet(str(tmp_path / "t"))
    rows = with_calls(spark.read.parquet(str(tmp_path / "t")), F.array(message("user", F.col("text"))), scripted(), FAST)
    plan = executed_plan(rows.select("id", "call"))
    assert "wide" not in plan and "ArrowEvalPython" in plan and "MapInPandas" not in plan


def test_filters_written_first_stay_below_the_call(spark, tmp_path):
    from millrace.operators.resume import pending

    spark.range(100).select(F.col("id").cast("string").alias("id"), F.lit("x").alias("text")).write.parquet(str(tmp_path / "t"))
    rows, done = spark.read.parquet(str(tmp_path / "t")), spark.range(5).select(F.col("id").cast("string").alias("id"))
    plan = optimized_plan(with_calls(pending(rows, done, "id"), F.array(message("user", F.col("text"))), scripted(), FAST))
    assert plan.index("ArrowEvalPython") < plan.index("LeftAnti")


def test_deadline():
    policy = CallPolicy(wait_factor=0.0, wait_min=0.0, attempts=2, deadline=0.1)
    late = lambda messages, chat: time.sleep(1) or "late"
    reply, attempts, kind, error, *_ = call_with_retry(late, None, policy, request("x"))
    assert (reply, attempts, kind, error) == (None, 2, "call", "TimeoutError: no reply within 0.1 s")
    assert call_with_retry(scripted(OSError("no"), "good"), None, policy, request("x"))[:2] == ("good", 2)


def test_replies_are_handed_on_in_slices(spark):
    frame = spark.range(0, 1003, 1, 1).withColumn("text", F.col("id").cast("string"))
    rows = with_calls(frame, F.when(F.col("id") % 7 != 0, asked(frame)), lambda m, c: m[0]["content"], FAST).collect()
    assert [r.id for r in rows] == list(range(1003))
    assert all(r.call.response == (None if r.id % 7 == 0 else str(r.id)) for r in rows)
