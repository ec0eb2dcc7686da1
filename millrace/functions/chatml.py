"""Chat messages from instruction datasets of several layouts.

A layout is a function ``(df, mapping) -> Column`` giving an array of
``(role, content)``, or null when the row cannot be used. ``mapping`` names the
row's columns by their part in the layout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions.text import strip, truthy

MESSAGES = T.ArrayType(
    T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
)
FORMAT_NAME = "chatml"

# Speakers that are kept and the roles they become; the default system prompt.
SPEAKER_ROLES = {"human": "user", "gpt": "assistant", "user": "user", "assistant": "assistant"}
DEFAULT_SYSTEM_PROMPT = "You are a helpful assistant and an expert coder."


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.cast("string").alias("content"))


def _given(df: DataFrame, name: str | None) -> tuple[Column, Column]:
    """The named column and whether it holds something; null if it is not there."""
    if name is None or name not in df.columns:
        return F.lit(None).cast("string"), F.lit(False)
    return F.col(name), truthy(name, df.schema[name].dataType)


def _plain(messages: Column) -> Column:
    """Keep only role and content, so that all layouts share one type."""
    return F.transform(
        messages,
        lambda m: F.struct(m["role"].cast("string").alias("role"), m["content"].cast("string").alias("content")),
    )


def prompt_response(df: DataFrame, mapping: dict[str, str]) -> Column:
    prompt, has_prompt = _given(df, mapping["prompt"])
    response, has_response = _given(df, mapping["response"])
    return F.when(has_prompt & has_response, F.array(message("user", prompt), message("assistant", response)))


def instruction_input(df: DataFrame, mapping: dict[str, str]) -> Column:
    """The instruction, with the input below it if there is one."""
    instruction, has_instruction = _given(df, mapping["prompt"])
    extra, has_extra = _given(df, mapping["input"])
    response, has_response = _given(df, mapping["response"])
    joined = strip(F.concat(instruction, F.lit("\n\n"), extra.cast("string")))
    prompt = F.when(has_extra, joined).otherwise(instruction)
    return F.when(has_instruction & has_response, F.array(message("user", prompt), message("assistant", response)))


def sharegpt(df: DataFrame, mapping: dict[str, str]) -> Column:
    """Known speakers' non-empty turns, in order."""
    turns, has_turns = _given(df, mapping["conversations"])
    if mapping["conversations"] not in df.columns:
        return F.lit(None).cast(MESSAGES)
    roles = F.create_map(*[F.lit(part) for pair in SPEAKER_ROLES.items() for part in pair])
    renamed = F.transform(
        turns,
        lambda t: F.struct(F.element_at(roles, t["from"]).alias("role"), t["value"].cast("string").alias("content")),
    )
    kept = F.filter(renamed, lambda m: m["role"].isNotNull() & (m["content"] != ""))
    return F.when(has_turns, kept)


def messages(df: DataFrame, mapping: dict[str, str]) -> Column:
    if mapping["messages"] not in df.columns:
        return F.lit(None).cast(MESSAGES)
    return _plain(F.col(mapping["messages"]))


def input_output_messages(df: DataFrame, mapping: dict[str, str]) -> Column:
    """Input messages with the output added as the assistant's turn."""
    turns, has_turns = _given(df, mapping["input"])
    output, has_output = _given(df, mapping["output"])
    if mapping["input"] not in df.columns:
        return F.lit(None).cast(MESSAGES)
    return F.when(has_turns & has_output, F.concat(_plain(turns), F.array(message("assistant", output))))


def prompt_text_only(df: DataFrame, mapping: dict[str, str]) -> Column:
    prompt, has_prompt = _given(df, mapping["prompt_text"])
    return F.when(has_prompt, F.array(message("user", prompt)))


LAYOUTS = {
    "prompt_response": prompt_response,
    "instruction_input": instruction_input,
    "sharegpt": sharegpt,
    "messages": messages,
    "input_output_messages": input_output_messages,
    "prompt_text_only": prompt_text_only,
}


def add_system(turns: Column, prompt: str = DEFAULT_SYSTEM_PROMPT) -> Column:
    """Put a system message in front unless the conversation has one."""
    has_system = F.exists(turns, lambda m: F.coalesce(m["role"] == "system", F.lit(False)))
    plain = _plain(turns)
    return F.when(has_system, plain).otherwise(F.concat(F.array(message("system", F.lit(prompt))), plain))


def request_messages(turns: Column, mode: str = "first_message") -> Column:
    """Messages to send for a conversation.

    ``first_message`` sends the first message's content as the user, whatever its
    role; ``last_user`` the last user turn; ``full`` the conversation as it is.
    """
    if mode == "first_message":
        return F.array(message("user", F.get(turns, F.lit(0))["content"]))
    if mode == "last_user":
        asked = F.filter(turns, lambda m: m["role"] == "user")
        return F.array(message("user", F.get(asked, F.size(asked) - F.lit(1))["content"]))
    if mode == "full":
        return turns
    raise ValueError(f"unknown request mode: {mode}")


def final_messages(prompt: Column, response: Column) -> Column:
    return F.array(message("user", prompt), message("assistant", response))
