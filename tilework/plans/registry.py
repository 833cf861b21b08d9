"""Queries by name, each with its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, uses: str = "") -> Callable:
    """Registers a function of (spark, sf_dir) under its name; sql may name the views in uses."""

    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            head = ", ".join(views.SQL[v] for v in uses.split())
            ORACLES[f.__name__] = f"with {head + ', ' if head and sql.lstrip().startswith('with ') else head + ' ' if head else ''}{sql.lstrip().removeprefix('with ') if head else sql}" if head else sql
        return f

    return register
