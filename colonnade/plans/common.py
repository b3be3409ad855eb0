"""Helpers shared by the query modules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.sources.tables import load_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_table(spark, sf_dir, name)


def r6(col: Column | str, digits: int = 6) -> Column:
    """Round a floating result for engine-independent comparison."""
    return F.round(F.col(col) if isinstance(col, str) else col, digits)


# Fixed value: text layout of timestamps in query results (both engines print it alike).
TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
TS_TEXT_SQL = "%Y-%m-%d %H:%M:%S.%f"


def ts_text(col: Column | str) -> Column:
    return F.date_format(F.col(col) if isinstance(col, str) else col, TS_TEXT)
