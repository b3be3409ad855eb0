"""Registry of named queries (``queries()``) and their DuckDB oracles (``oracle_sql()``).

A query is ``fn(spark, sf_dir) -> DataFrame`` over the given parquet tables.  Its
oracle, when SQL can express it, sits next to it so the two are kept in step;
queries without one (model fits, random samples, multi-pass searches checked
against brute force in the tests) get only a row-count check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql.strip()
        return fn
    return deco


def _load_all() -> None:
    # Importing the modules registers their queries.
    from colonnade.plans import (  # noqa: F401
        q_aggregates, q_io, q_ml, q_relational, q_sequences,
    )


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLES)
