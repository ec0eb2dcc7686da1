"""Registered queries over the given tables, each with its SQL where it has one."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

SECTIONS = ("text", "fields", "chat", "replies", "packages", "sets", "reports", "files", "jobs", "runs")


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None = None


def entries() -> dict[str, Entry]:
    found: dict[str, Entry] = {}
    for section in SECTIONS:
        for name, entry in import_module(f"millrace.catalog.{section}").ENTRIES.items():
            if name in found:
                raise ValueError(f"query {name} is registered twice")
            found[name] = entry
    return found
