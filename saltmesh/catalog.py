"""Registered queries of the tidal operators and their SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixtures import Fixtures, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles to so many places, and no negative zero."""
    return df.select(*((F.round(F.col(f"`{c}`"), places) + F.lit(0.0)).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes))


def query(name: str, sql: str | None = None) -> Callable:
    """Registers a function of the fixtures under name, with its DuckDB SQL."""

    def register(f: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: rounded(f(Fixtures(spark, sf_dir)))
        if sql is not None:
            SQL[name] = with_views(sql)
        return f

    return register


def r6(expression: str) -> str:
    """A rounded double in SQL, as `rounded` gives it."""
    return f"(round({expression}, 6) + 0e0)"


def load() -> None:
    """Registers all queries."""
    for name in ("flow", "summaries", "tides", "time_checks", "lookups", "records", "reports", "sites", "tables"):
        importlib.import_module(f"saltmesh.plans.{name}_queries")
