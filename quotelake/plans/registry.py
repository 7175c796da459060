"""All registered queries over the reference operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

FAMILIES = ["q_book", "q_scalars", "q_tiering", "q_history", "q_keyed", "q_normalise", "q_archive", "q_streaming", "q_more", "q_sinks"]


def family() -> tuple[dict, dict, Callable]:
    """A family's queries, their SQL, and the decorator that adds to both."""
    found: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    sqls: dict[str, str] = {}

    def query(name: str, sql: str | None = None) -> Callable:
        def keep(f: Callable) -> Callable:
            found[name] = f
            if sql:
                sqls[name] = sql
            return f

        return keep

    return found, sqls, query


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict = {}
    for family in FAMILIES:
        out |= import_module(f"{__package__}.{family}").Q
    return out


def oracle_sql() -> dict[str, str]:
    out: dict = {}
    for family in FAMILIES:
        out |= import_module(f"{__package__}.{family}").SQL
    return out
