"""Queries for model replies, output contracts and model calls."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import Entry
from millrace.catalog.inputs import model_replies, table
from millrace.functions import replies as rp
from millrace.functions.chatml import message
from millrace.operators.calls import CallPolicy, chat_parameters, with_calls
from millrace.session import stage

CONTRACT = rp.OutputContract(
    keys=("k", "score", "tags"), required=("k", "score"), defaults={"k": 0, "score": 3, "tags": ["none"]}
)
LENIENT = rp.OutputContract(keys=("k", "score", "tags"), required=("k",), defaults=CONTRACT.defaults)
NO_WAIT = CallPolicy(concurrency=8, wait_factor=0.0, wait_min=0.0)


def count_reply(messages: list[dict[str, str]], chat: dict) -> str:
    """Stand-in for a model: a pure function of the prompt. Some prompts fail, some get no JSON."""
    text = messages[-1]["content"]
    if text.startswith("De"):
        raise TimeoutError("no answer")
    if text.startswith("A"):
        return f"about {len(text)}"
    return '{"score": "%d", "length": %d}' % (len(text) % 5 + 1, len(text))


def _objects(spark, sf):
    parsed = rp.with_reply_object(model_replies(spark, sf), "reply")
    k = F.element_at("reply_values", "k").cast("bigint").alias("k")
    return parsed.select("event_id", k, F.col("reply_body").isNotNull().alias("ok"))


def _missing(spark, sf):
    parsed = rp.with_reply_object(model_replies(spark, sf), "reply").filter(F.col("reply_body").isNotNull())
    missing = rp.missing_keys("reply_values", ("score", "k", "length"))
    return parsed.select("event_id", F.array_join(missing, ",").alias("missing"))


def _digits(spark, sf):
    events = table(spark, sf, "events")
    score = F.when(F.col("event_type") == "view", F.col("value").cast("string")).otherwise(F.col("user_id").cast("string"))
    score = F.when(F.col("event_type") == "click", F.lit("four")).otherwise(score)
    return events.select("event_id", rp.digits_to_int(score).alias("score"))


def _projected(contract):
    def run(spark, sf):
        rows = rp.with_reply_columns(model_replies(spark, sf), "reply", contract)
        return rows.select("event_id", "k", "score", F.array_join("tags", ",").alias("tags"))

    return run


def _reasons(spark, sf):
    rows = rp.with_reply_columns(model_replies(spark, sf), "reply", CONTRACT)
    braces = F.col("event_type") == "purchase"
    reason = F.when(braces, F.lit("bad json")).otherwise(F.col("reply_error"))
    return rows.select("event_id", F.coalesce(reason, F.lit("")).alias("reason"))


def _calls(spark, sf):
    docs = table(spark, sf, "documents")
    asked = F.array(message("user", F.col("text")))
    called = stage(with_calls(docs.select("doc_id", "text"), asked, count_reply, NO_WAIT, CONTRACT_SCORE.check), "calls")
    return called.select(
        "doc_id",
        F.when(F.col("call.error_kind").isNull(), F.col("call.response")).alias("reply"),
        F.col("call.error_kind").alias("error_kind"),
        F.col("call.attempts").cast("bigint").alias("attempts"),
    )


CONTRACT_SCORE = rp.OutputContract(keys=("score",), required=("score",), defaults={"score": 3})


def _parameters(spark, sf):
    wanted = chat_parameters({"temperature": 0.5, "model": "m", "stream": True, "stop": "x", "top_p": 1})
    docs = table(spark, sf, "documents")
    asked = F.array(message("user", F.col("source")))

    def echo(messages, chat):
        return ",".join(sorted(chat)) + ":" + messages[0]["content"]

    called = with_calls(docs.select("doc_id", "source"), asked, echo, CallPolicy(chat=wanted))
    return stage(called, "parameters").select("doc_id", F.col("call.response").alias("reply"))


_K = "CAST(json_extract(props, '$.k') AS BIGINT)"

ENTRIES = {
    "st15": Entry(
        _objects,
        f"""SELECT event_id, CASE WHEN event_type IN ('click', 'view', 'signup') THEN {_K} END AS k,
                   event_type IN ('click', 'view', 'signup') AS ok FROM events""",
    ),
    "st16": Entry(
        _missing,
        """SELECT event_id, CASE WHEN event_type = 'signup' THEN 'length,score' ELSE 'length' END AS missing
           FROM events WHERE event_type IN ('click', 'view', 'signup')""",
    ),
    "st17": Entry(
        _digits,
        """SELECT event_id, CASE WHEN event_type NOT IN ('view', 'click') THEN user_id END AS score FROM events""",
    ),
    "st18": Entry(
        _projected(LENIENT),
        f"""SELECT event_id, CASE WHEN event_type IN ('click', 'view', 'signup') THEN {_K} ELSE 0 END AS k,
                   CASE event_type WHEN 'click' THEN 4 WHEN 'view' THEN NULL ELSE 3 END::BIGINT AS score,
                   'none' AS tags FROM events""",
    ),
    "st19": Entry(
        _projected(CONTRACT),
        f"""SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN {_K} ELSE 0 END AS k,
                   CASE event_type WHEN 'click' THEN 4 WHEN 'view' THEN NULL ELSE 3 END::BIGINT AS score,
                   'none' AS tags FROM events""",
    ),
    "st31": Entry(
        _reasons,
        """SELECT event_id, CASE event_type WHEN 'signup' THEN 'Missing required keys: score'
                  WHEN 'purchase' THEN 'bad json' WHEN 'error' THEN 'The reply holds no JSON object.'
                  ELSE '' END AS reason FROM events""",
    ),
    "ud5": Entry(
        _calls,
        """SELECT doc_id,
                  CASE WHEN starts_with(text, 'De') OR starts_with(text, 'A') THEN NULL ELSE
                      '{"score": "' || (length(text) % 5 + 1) || '", "length": ' || length(text) || '}' END AS reply,
                  CASE WHEN starts_with(text, 'De') THEN 'call' WHEN starts_with(text, 'A') THEN 'format' END AS error_kind,
                  CASE WHEN starts_with(text, 'De') OR starts_with(text, 'A') THEN 3 ELSE 1 END::BIGINT AS attempts
           FROM documents""",
    ),
    "ud6": Entry(
        _parameters,
        "SELECT doc_id, 'stop,temperature,top_p:' || source AS reply FROM documents",
    ),
}
