"""Scalar column expressions (X1-X19).  All are built-in Catalyst expressions,
so they stay inside whole-stage code generation; none needs a Python UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def regex_literal(text: str) -> str:
    """``text`` as a regular expression matching itself (``split`` takes a regex)."""
    return "".join("\\" + ch if ch in ".^$*+?()[]{}|\\" else ch for ch in text)


def nth_field(col: Column | str, sep: str, index: int) -> Column:
    """``split(col, sep)[index]`` (0-based), null when absent."""
    return F.get(F.split(_c(col), regex_literal(sep)), index)


def whitespace_tokens(col: Column | str) -> Column:
    """Tokens of a line as the MapReduce mapper sees them."""
    return F.split(F.rtrim(_c(col)), r"\s+")


def token_count(col: Column | str) -> Column:
    return F.size(whitespace_tokens(col))


def prefix(col: Column | str, n: int) -> Column:
    """First ``n`` characters (``s[:n]``)."""
    return F.substring(_c(col), 1, n)


def contains_ci(col: Column | str, needle: str) -> Column:
    """Case-insensitive substring test."""
    return F.lower(_c(col)).contains(needle.lower())


def concat_key(*cols: Column | str, sep: str = ",") -> Column:
    """Composite string key."""
    return F.concat_ws(sep, *[_c(c).cast("string") for c in cols])


def to_int(col: Column | str) -> Column:
    """Parse an integer; malformed text gives null instead of failing."""
    return _c(col).try_cast("int")


def to_long(col: Column | str) -> Column:
    return _c(col).try_cast("bigint")


def to_double(col: Column | str) -> Column:
    return _c(col).try_cast("double")


# The upper bounds of the five output ranges of the longest-duration
# job, compared in code-unit order: below "f", below "k", below "p", below "u", rest.
RANGE_BOUNDS = ("f", "k", "p", "u")


def string_order_bucket(col: Column | str, bounds: Sequence[str] = RANGE_BOUNDS,
                        case_insensitive: bool = False) -> Column:
    """Index of the first bound the string sorts below (code-unit order, D9)."""
    key = F.lower(_c(col)) if case_insensitive else _c(col)
    expr = F.lit(len(bounds))
    for i in reversed(range(len(bounds))):
        expr = F.when(key < F.lit(bounds[i]), F.lit(i)).otherwise(expr)
    return expr


def hour_of_day(col: Column | str) -> Column:
    """X8."""
    return F.hour(_c(col))


def day_of_week(col: Column | str) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(_c(col))


def month_of(col: Column | str) -> Column:
    return F.month(_c(col))


def to_date(col: Column | str) -> Column:
    """Truncate a timestamp to its date."""
    return _c(col).cast("date")


# The two periods of the before/after comparison, inclusive year ranges.
PERIODS = (("Daly", 1989, 2010), ("Emanuel", 2011, 2019))


def period_label(year: Column | str, periods: Sequence[tuple[str, int, int]] = PERIODS,
                 unknown: str = "Unknown", other: str = "Other", year_width: int = 4) -> Column:
    """Label a year given as text.

    Empty, null or not exactly ``year_width`` characters -> ``unknown``; a
    ``year_width``-character value that is not a number is also ``unknown``
    (D23); otherwise the first period whose inclusive range holds the year,
    else ``other``.
    """
    text = _c(year).cast("string")
    value = text.try_cast("int")
    expr = F.lit(other)
    for label, lo, hi in reversed(list(periods)):
        expr = F.when(value.between(lo, hi), F.lit(label)).otherwise(expr)
    return (
        F.when(text.isNull() | (F.length(text) != year_width), F.lit(unknown))
        .when(value.isNull(), F.lit(unknown))
        .otherwise(expr)
    )


def flag(cond: Column) -> Column:
    """X11: 1 when the condition holds, else 0 (null counts as false)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def block_cutoff(ordinal: Column | str, width: int = 10) -> Column:
    """Last ordinal of the previous complete block: 10*floor((b-1)/10)."""
    b = _c(ordinal).cast("bigint")
    return F.floor((b - 1) / F.lit(width)).cast("bigint") * width


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """Division that yields null for a zero denominator."""
    return F.try_divide(_c(num), _c(den))


def ewma_fold(values: Column | str, alpha: float) -> Column:
    """sum_i alpha*(1-alpha)^i * x_i over an array, i = 0 for the first element."""
    arr = _c(values)
    acc = F.aggregate(
        arr,
        F.struct(F.lit(0.0).alias("s"), F.lit(alpha).alias("w")),
        lambda a, x: F.struct((a["s"] + a["w"] * x.cast("double")).alias("s"),
                              (a["w"] * F.lit(1.0 - alpha)).alias("w")),
    )
    return acc["s"]


def weight_mass(n_terms: Column | str | int, alpha: float) -> Column:
    """Total weight of an n-term EWMA, 1 - (1-alpha)^n."""
    n = F.lit(n_terms) if isinstance(n_terms, int) else _c(n_terms)
    return F.lit(1.0) - F.pow(F.lit(1.0 - alpha), n.cast("double"))


def percent_text(col: Column | str, digits: int = 6) -> Column:
    """``format(x, '%')`` style text, e.g. 0.5 -> '50.000000%'."""
    return F.format_string(f"%.{digits}f%%", _c(col) * 100.0)
