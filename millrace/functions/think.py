"""Reasoning text inside model replies."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from millrace.functions.text import as_column, bind, cut_between, strip

# Fixed value: the tags around reasoning.
_BLOCK = r"(?s)<think>\n?(.*?)\n?</think>"


def join_reasoning(reasoning: Column | str, content: Column | str) -> Column:
    """Reply text with its reasoning in front, tagged, if there is any."""
    reasoning, content = as_column(reasoning), as_column(content)
    body = F.coalesce(content, F.lit(""))
    tagged = F.concat(F.lit("<think>\n"), reasoning, F.lit("\n</think>\n\n"), body)
    return (
        F.when(strip(F.coalesce(reasoning, F.lit(""))) != "", tagged)
        .when(body != "", body)
        .otherwise(F.coalesce(reasoning, F.lit("")))
    )


def think_blocks(text: Column | str) -> Column:
    """All reasoning texts, in order."""
    return F.regexp_extract_all(F.coalesce(as_column(text), F.lit("")), F.lit(_BLOCK), F.lit(1))


def has_think(text: Column | str) -> Column:
    return F.size(think_blocks(text)) > 0


def visible_text(text: Column | str) -> Column:
    """The text without its first reasoning block and the line breaks after it."""
    text = as_column(text)
    kept = bind(
        cut_between(text, "<think>", "</think>"),
        lambda span: F.concat(span["before"], F.ltrim(span["after"], F.lit("\n"))),
    )
    return F.coalesce(kept, text)
