"""Prompt templates as columns."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.chatml import message
from millrace.functions.text import render


def template_fields(template: str) -> list[str]:
    """Placeholder names in the order they appear."""
    return [name for _, name, _, _ in Formatter().parse(template) if name is not None]


def render_prompt(df: DataFrame, template: str, input_column: str = "text", input_name: str = "text") -> Column:
    """``{name}`` placeholders filled from the row; doubled braces stand for one.

    ``input_name`` is the placeholder for ``input_column`` unless the row has a
    column of that name itself. The template is read once, here, into literals
    and columns, so braces inside the data are left alone.
    """
    if input_column not in df.columns:
        raise ValueError(f"input column {input_column!r} is not among {df.columns}")
    sources = {input_name: input_column, **{c: c for c in df.columns}}
    parts: list[Column] = []
    for literal, name, spec, conversion in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is None:
            continue
        if spec or conversion or not name or any(c in name for c in ".[]"):
            raise ValueError(f"placeholder {name!r}: only plain names are supported")
        if name not in sources:
            raise ValueError(f"placeholder {name!r} has no column in {df.columns}")
        column = sources[name]
        parts.append(render(column, df.schema[column].dataType))
    return F.concat(*parts) if parts else F.lit("")


def prompt_messages(prompt: Column, system_text: str | None = None) -> Column:
    """Optional system message, then the prompt as the user."""
    turns = [message("system", F.lit(system_text))] if system_text else []
    return F.array(*turns, message("user", prompt))
