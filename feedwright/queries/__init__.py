"""Registered driver queries: a Spark callable ``(spark, sf_dir) -> DataFrame``
per SURVEY §7.3 name, and where the operator is SQL-expressible its DuckDB twin.

Every query reads the driver tables (or data Spark derives from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn
    return deco


def load_all() -> None:
    from feedwright.queries import (  # noqa: F401
        dq, extracts, formats, jobstat, loads, metrics, misc, planning, profiles, reruns,
    )


def queries() -> dict[str, QueryFn]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLE)
