"""Projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P1."""
    return df.select(*cols)


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Absent names are ignored."""
    return df.drop(*cols)


def with_columns(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Derived, literal and cast columns in one projection."""
    return df.withColumns(dict(exprs))


def with_literal(df: DataFrame, name: str, value) -> DataFrame:
    """P4."""
    return df.withColumn(name, F.lit(value))


def cast_columns(df: DataFrame, types: Mapping[str, str], safe: bool = True) -> DataFrame:
    """P5: ``try_cast`` by default so malformed values become null."""
    return df.withColumns({c: (F.col(c).try_cast(t) if safe else F.col(c).cast(t)) for c, t in types.items()})


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """P6."""
    return df.withColumnsRenamed(dict(names))


def schema_listing(df: DataFrame) -> list[tuple[str, str]]:
    """(column, type) pairs -- metadata only, no job."""
    return list(df.dtypes)
