"""The registered queries of the evidence operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import composite, endpoints, filed, items, relational, small, textual

MODULES = (relational, textual, composite, small, endpoints, items, filed)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: getattr(m, name) for m in MODULES for name in m.NAMES}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in m.SQL.items()}
