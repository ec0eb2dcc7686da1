import json
import math

import pytest

from conftest import column_values
from hypothesis import given, settings, strategies as st

from millrace.functions.replies import (
    OutputContract,
    ReplyError,
    digits_to_int,
    read_reply,
    with_reply_columns,
    with_reply_object,
)

RATING = OutputContract.from_config(
    {
        "require_json": True,
        "json_keys": ["score", "kind", "languages", "ratio"],
        "json_key_must_exists": ["score"],
        "json_default_values": {"score": 3, "kind": "general", "languages": ["en"], "ratio": 0.5},
    }
)

GOOD = {
    '{"score": 4}': {"score": 4},
    'Sure! {"score": 4} Bye.': {"score": 4},
    'a {b}\n```json\n{"score": 4}\n```': {"score": 4},
    '```json\n{"score": 4}\n``` and {more}': {"score": 4},
    '{"score": 1, "score": 2}': {"score": 2},
    '{"score": [1, {"a": 2}]}': {"score": [1, {"a": 2}]},
}
BAD = ['{"a": 1} text {"b": 2}', "{'score': 4}", '{"score": 4,}', '{"score": "a\nb"}', "[1, 2]", "", None, "none", '{"score"']


def test_read_reply():
    for text, value in GOOD.items():
        assert read_reply(text) == value
    for text in BAD:
        with pytest.raises(ReplyError):
            read_reply(text)
    assert math.isnan(read_reply('{"score": NaN}')["score"])


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet='{}[]",:ab1 \n`json'))
def test_read_reply_never_raises_anything_else(text):
    try:
        assert isinstance(read_reply(text), dict)
    except ReplyError:
        pass


def parsed(spark, replies, contract=RATING):
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(replies)], "i int, reply string")
    return with_reply_columns(frame, "reply", contract).orderBy("i").collect()


def test_objects_in_columns(spark):
    texts = [*GOOD, *BAD]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, reply string")
    rows = with_reply_object(frame, "reply").orderBy("i").collect()
    assert [json.loads(r.reply_body) if r.reply_body else None for r in rows] == [*GOOD.values(), *[None] * len(BAD)]
    assert [r.reply_error is None for r in rows] == [True] * len(GOOD) + [False] * len(BAD)


def test_contract_columns(spark):
    rows = parsed(
        spark,
        [
            '{"score": "4", "extra": 1}',
            '{"score": null, "kind": null}',
            '{"score": 4.0, "languages": ["de", "fr"], "ratio": 2}',
            '{"score": "four"}',
            '{"kind": "x"}',
            "nothing",
            '{"score": NaN, "kind": {"a": [1]}}',
        ],
    )
    values = [(r.score, r.kind, r.languages, r.ratio) for r in rows]
    assert values == [
        (4, "general", ["en"], 0.5),
        (None, None, ["en"], 0.5),
        (4, "general", ["de", "fr"], 2.0),
        (None, "general", ["en"], 0.5),
        (3, "general", ["en"], 0.5),
        (3, "general", ["en"], 0.5),
        (None, '{"a":[1]}', ["en"], 0.5),
    ]
    errors = [r.reply_error for r in rows]
    assert errors[:4] == [None] * 4 and errors[4] == "Missing required keys: score"
    assert errors[5] == "The reply holds no JSON object." and errors[6] is None


def test_contract_check_agrees_with_columns(spark):
    texts = [t for t in [*GOOD, *BAD, '{"kind": "x"}'] if t]
    rows = parsed(spark, texts)
    assert [RATING.check(t) for t in texts] == [r.reply_error for r in rows]
    assert OutputContract(require_json=False).check("anything") is None


def test_schema_from_defaults():
    assert RATING.schema.simpleString() == "struct<score:bigint,kind:string,languages:array<string>,ratio:double>"


def test_digits(spark):
    assert column_values(spark, ["4", "04", "", "-1", "²", "4.0", None, "4\n"], digits_to_int) == [
        4, 4, None, None, None, None, None, None]
