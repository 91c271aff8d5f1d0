"""Registered queries: one Spark callable per operator/job of the inventory,
each paired with its DuckDB oracle SQL (None when only rows can be checked).

Every query reads the driver's tables through `TestViews`, over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from keepsake.checks.oracle import build

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None = None, needs: tuple[str, ...] = ()):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, build(sql, needs) if sql is not None else None)
        return fn
    return deco


def _load_all() -> None:
    # Importing the modules fills REGISTRY.
    from keepsake.checks import (q_retention, q_catalog, q_sli, q_backup,  # noqa: F401
                                 q_restore, q_copy)


def queries() -> dict[str, QueryFn]:
    _load_all()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
