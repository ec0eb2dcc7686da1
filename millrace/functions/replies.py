"""Output contracts: what a model's JSON reply must hold, and its columns."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions.text import as_column

# Fixed value: what opens and closes a fenced JSON block.
_FENCE, _FENCE_END = "```json", "```"


class ReplyError(ValueError):
    """The reply does not meet its contract."""


def read_reply(text: str | None) -> dict[str, Any]:
    """The JSON object in a reply.

    Its places are tried in turn, each found by plain searches, so a run-away reply
    costs no more than its length; the first one that is JSON counts. JSON that is too
    deep or holds a number too long to read is as bad as broken JSON.
    """
    if not text:
        raise ReplyError("The reply is empty.")
    problem = "The reply holds no JSON object."
    for place in _places(text):
        try:
            value = json.loads(place)
        except (ValueError, RecursionError) as error:
            problem = f"{type(error).__name__}: {error}"
            continue
        if isinstance(value, dict):
            return value
        break
    raise ReplyError(problem)


def _places(text: str) -> Iterator[str]:
    """From the first brace to the last one; then the first fenced object or, without one, everything."""
    first, last = text.find("{"), text.rfind("}")
    if not 0 <= first < last:
        return
    yield text[first : last + 1]
    fence = text.find(_FENCE)
    inside, end, _ = text[fence + len(_FENCE) :].partition(_FENCE_END) if fence >= 0 else ("", "", "")
    yield inside.strip() if end and inside.strip().startswith("{") else text


def without_surrogates(text: str | None) -> str | None:
    """Half characters, as cut-off replies hold them, can't leave Python: they become question marks."""
    return text if text is None or text.isascii() else text.encode("utf-8", "replace").decode()


def _type_of(default: Any) -> T.DataType:
    if isinstance(default, bool):
        return T.BooleanType()
    if isinstance(default, int):
        return T.LongType()
    if isinstance(default, float):
        return T.DoubleType()
    if isinstance(default, list):
        return T.ArrayType(T.StringType())
    return T.StringType()


@dataclass(frozen=True)
class OutputContract:
    """Keys a reply is reduced to, those it must have, and their defaults.

    A key's column type is the type of its default; without one it is a string.
    """

    keys: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    defaults: dict[str, Any] = field(default_factory=dict)
    require_json: bool = True

    @classmethod
    def from_config(cls, config: dict[str, Any]) -> "OutputContract":
        return cls(
            keys=tuple(config.get("json_keys", ())),
            required=tuple(config.get("json_key_must_exists", ())),
            defaults=dict(config.get("json_default_values", {})),
            require_json=bool(config.get("require_json", False)),
        )

    @property
    def columns(self) -> list[str]:
        """Contract keys, then defaults that are no contract key."""
        return [*self.keys, *[k for k in self.defaults if k not in self.keys]]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(k, _type_of(self.defaults.get(k))) for k in self.columns])

    def check(self, reply: str) -> str | None:
        """Why the reply fails, or None. Plain Python: runs inside the call operator."""
        if not self.require_json:
            return None
        try:
            missing = set(self.required) - read_reply(reply).keys()
        except ReplyError as error:
            return str(error)
        return f"Missing required keys: {', '.join(sorted(missing))}" if missing else None

    def default_column(self, key: str) -> Column:
        value, dtype = self.defaults.get(key), _type_of(self.defaults.get(key))
        if isinstance(value, list):
            return F.array(*[F.lit(v) for v in value]).cast(dtype)
        return F.lit(value).cast(dtype)


@F.pandas_udf(T.StringType())
def _object_or_reason(replies: pd.Series) -> pd.Series:
    """The reply's JSON object as strict JSON text, or the reason there is none.

    One string per row keeps the transfer small; only an object starts with a
    brace.
    """

    def read(text: str | None) -> str:
        try:
            return without_surrogates(json.dumps(read_reply(text), ensure_ascii=False))
        except ReplyError as error:
            return str(error)

    return pd.Series([read(t) for t in replies], dtype=object)


def with_reply_object(df: DataFrame, reply: str) -> DataFrame:
    """Adds ``reply_body`` (JSON text), ``reply_values`` (its top-level map) and ``reply_error``."""
    read = df.withColumn("_read", _object_or_reason(F.col(reply)))
    is_object = F.startswith("_read", F.lit("{"))
    return read.withColumns(
        {
            "reply_body": F.when(is_object, F.col("_read")),
            "reply_values": F.when(is_object, F.from_json("_read", "map<string,string>")),
            "reply_error": F.when(~is_object, F.col("_read")),
        }
    ).drop("_read")


def missing_keys(values: Column | str, required: tuple[str, ...]) -> Column:
    """Required keys that are not there, sorted. A key with a null value is there."""
    wanted = F.array(*[F.lit(k) for k in required]).cast("array<string>")
    return F.array_sort(F.array_except(wanted, F.map_keys(as_column(values))))


def digits_to_int(value: Column | str) -> Column:
    """Integer value of a text of ASCII digits; null for anything else."""
    value = as_column(value).cast("string")
    return F.when(value.rlike(r"\A[0-9]+\z"), value.try_cast("bigint"))


def _typed(value: Column, dtype: T.DataType) -> Column:
    """A JSON value's text in the column's type; null where it does not fit."""
    if isinstance(dtype, T.ArrayType):
        return F.from_json(value, dtype)
    if isinstance(dtype, T.LongType):
        whole = F.regexp_extract(value, r"\A(-?[0-9]+)(\.0+)?\z", 1)
        return whole.try_cast("bigint")
    return value.try_cast(dtype)


def project_reply(values: Column, contract: OutputContract) -> list[Column]:
    """One column per contract key, from the reply's values (as text).

    A key that is absent takes its default; an explicit null stays null; keys
    outside the contract are dropped. All defaults apply when ``values`` is null.
    """
    columns = []
    for entry in contract.schema:
        column = contract.default_column(entry.name)
        if entry.name in contract.keys:
            value = _typed(F.element_at(values, F.lit(entry.name)), entry.dataType)
            column = F.when(F.map_contains_key(values, entry.name), value).otherwise(column)
        columns.append(column.alias(entry.name))
    return columns


def with_reply_columns(df: DataFrame, reply: str, contract: OutputContract) -> DataFrame:
    """Read ``reply`` by the contract; adds its columns and ``reply_error``."""
    missing = missing_keys("reply_values", contract.required)
    lacking = F.when(F.size(missing) > 0, F.concat(F.lit("Missing required keys: "), F.array_join(missing, ", ")))
    checked = with_reply_object(df, reply).withColumn("reply_error", F.coalesce(F.col("reply_error"), lacking))
    usable = F.when(F.col("reply_error").isNull(), F.col("reply_values"))
    kept = [c for c in df.columns if c not in contract.columns]
    return checked.select(*kept, "reply_error", *project_reply(usable, contract))
