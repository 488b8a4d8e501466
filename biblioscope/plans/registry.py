"""Collects the queries of the core library and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from biblioscope.plans import checked, counted, joined, lookups, nested, sourced, texts

MODULES = (lookups, joined, counted, texts, checked, sourced, nested)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for m in MODULES for name, fn in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
