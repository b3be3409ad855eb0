"""Row predicates (F1-F11).  Written as Catalyst expressions so that the simple
ones (ranges, equality, IN, not-null) are pushed into the parquet scan."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colonnade.functions.scalars import contains_ci  # noqa: F401  (F8 is X4 as a predicate)

# Fixed value: a valid year is 1-4 ASCII digits, or '-' followed by 1-3 digits (D3).
VALID_YEAR_PATTERN = r"^(?:[0-9]{1,4}|-[0-9]{1,3})$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def in_range(col: Column | str, lo, hi) -> Column:
    """Inclusive range (``lo <= col <= hi``); either bound may be None."""
    c = _c(col)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (c >= F.lit(lo))
    if hi is not None:
        cond = cond & (c <= F.lit(hi))
    return cond


def in_set(col: Column | str, values: Iterable) -> Column:
    """F3."""
    return _c(col).isin(list(values))


def year_spans(years: Iterable[int]) -> list[tuple[int, int]]:
    """Runs of consecutive years: {1996, 1997, 2000} -> [(1996, 1997), (2000, 2000)]."""
    spans: list[tuple[int, int]] = []
    for y in sorted(set(years)):
        if spans and y == spans[-1][1] + 1:
            spans[-1] = (spans[-1][0], y)
        else:
            spans.append((y, y))
    return spans


def in_years(df: DataFrame, date_col: str, years: Sequence[int]) -> Column:
    """F3 on the year of a date or timestamp column: half-open ranges of the column itself, which reach the scan (a
    comparison of ``year(column)`` does not).  The same rows as ``year(date_col).isin(years)``."""
    dtype = dict(df.dtypes)[date_col]
    if dtype not in ("date", "timestamp", "timestamp_ntz"):
        raise ValueError(f"{date_col} is {dtype}, not a date or timestamp")
    cond = F.lit(False)
    for lo, hi in year_spans(years):
        if not 1 <= lo <= hi < 9999:
            raise ValueError(f"years {lo} to {hi} are outside 1..9998")
        begin, end = (F.lit(f"{y:04d}-01-01" + ("" if dtype == "date" else " 00:00:00")).cast(dtype) for y in (lo, hi + 1))
        cond = cond | ((F.col(date_col) >= begin) & (F.col(date_col) < end))
    return cond


def in_year_range(df: DataFrame, date_col: str, lo: int, hi: int) -> Column:
    """F7 on the year of a date or timestamp column (inclusive), as a range of the column itself."""
    return in_years(df, date_col, range(lo, hi + 1))


def is_valid_year(col: Column | str) -> Column:
    """the year check of the n-gram and song jobs."""
    return _c(col).rlike(VALID_YEAR_PATTERN)


def non_zero(col: Column | str) -> Column:
    """F10."""
    return _c(col) != 0


def filter_sql(df: DataFrame, predicate: str) -> DataFrame:
    """a predicate written as SQL text (parsed once by Catalyst)."""
    return df.filter(predicate)


def drop_nulls(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """drop rows with a null in any (or any listed) column."""
    return df.na.drop(how="any", subset=subset)
