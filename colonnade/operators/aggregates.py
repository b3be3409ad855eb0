"""Aggregations (A1-A26).  All use Spark's built-in aggregate functions, which
run as partial (map-side) plus final aggregation, so a hot key is combined on
every mapper before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colonnade.functions.scalars import regex_literal
from colonnade.operators.sequences import dense_ordinal, descending_keys


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def group_count(df: DataFrame, keys: Sequence[str | Column], out: str = "count") -> DataFrame:
    """A1 / A5: rows per key combination."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def average_of_counts(df: DataFrame, outer: Sequence[str], inner: Sequence[str],
                      out: str = "avg_count") -> DataFrame:
    """A2: count per (outer, inner) then the mean of those counts per outer key."""
    counts = group_count(df, [*outer, *inner], "_n")
    return counts.groupBy(*outer).agg(F.avg("_n").alias(out))


def keyed_sum(df: DataFrame, keys: Sequence[str], value: str | Column, out: str = "sum") -> DataFrame:
    """A3 / A16."""
    return df.groupBy(*keys).agg(F.sum(_c(value)).alias(out))


def conditional_count(df: DataFrame, keys: Sequence[str], cond: Column, out: str = "n") -> DataFrame:
    """A4: rows meeting ``cond`` per key; keys with no such row stay with 0."""
    return df.groupBy(*keys).agg(F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint").alias(out))


def collect_series(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                   chunk_rows: int = 1024, out: str = "values") -> DataFrame:
    """Ordered values per key, as arrays of at most ``chunk_rows`` values.

    One row per (keys, chunk); chunk ``c`` holds ordinals ``c*chunk_rows+1 ..``.
    A long series is therefore split over several rows instead of one
    unbounded array in one task.
    """
    numbered = dense_ordinal(df.select(*keys, *order, value), keys, order, "_ord")
    chunked = numbered.withColumn("chunk", F.floor((F.col("_ord") - 1) / F.lit(chunk_rows)).cast("bigint"))
    return (chunked.groupBy(*keys, "chunk")
            .agg(F.array_sort(F.collect_list(F.struct("_ord", value))).alias("_s"))
            .select(*keys, "chunk", F.transform("_s", lambda s: s[value]).alias(out)))


def argmax_per_key(df: DataFrame, key: str, score: str, candidate: str,
                   prefer_smaller: bool = True) -> DataFrame:
    """Candidate with the highest score per key (ties: smaller candidate, of any ordered type)."""
    c = F.col(candidate)
    tie = descending_keys(c, dict(df.dtypes)[candidate]) if prefer_smaller else [c]
    best = F.max(F.struct(F.col(score).alias("s"), *[t.alias(f"t{i}") for i, t in enumerate(tie)], c.alias("c")))
    return df.groupBy(key).agg(best.alias("_m")).select(key, F.col("_m.c").alias(candidate),
                                                         F.col("_m.s").alias(score))


def max_per_key(df: DataFrame, keys: Sequence[str], value: str, out: str = "max_value") -> DataFrame:
    """A8."""
    return df.groupBy(*keys).agg(F.max(value).alias(out))


def max_floor_zero(df: DataFrame, keys: Sequence[str], value: str, out: str = "max_value") -> DataFrame:
    """A running maximum that starts at 0: negative-only groups give 0 and
    NaN never wins (D6)."""
    v = F.col(value).cast("double")
    clean = F.when(~F.isnan(v), v)
    return df.groupBy(*keys).agg(F.coalesce(F.greatest(F.max(clean), F.lit(0.0)), F.lit(0.0)).alias(out))


def global_extremes(df: DataFrame, cols: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row of min/max aggregates, e.g. ``{"ts": ["min", "max"]}``."""
    fns = {"min": F.min, "max": F.max}
    return df.agg(*[fns[f](c).alias(f"{f}_{c}") for c, fs in cols.items() for f in fs])


def row_counts(df: DataFrame) -> DataFrame:
    """Total rows and rows without any null."""
    no_null = F.lit(True)
    for c in df.columns:
        no_null = no_null & F.col(c).isNotNull()
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(no_null).alias("n_complete"))


def _as_text(name: str, dtype: str) -> Column:
    """Text that is equal exactly when the values are (null for null)."""
    c = F.col(name)
    if dtype in ("float", "double"):
        return F.when(c == 0, F.lit("0")).otherwise(c.cast("string"))  # 0.0 and -0.0 are one value
    if dtype == "binary":
        return F.hex(c)
    return F.to_json(F.struct(c)) if dtype.startswith(("struct", "array", "map")) else c.cast("string")


def distinct_counts(df: DataFrame) -> DataFrame:
    """A12 in long form, (column_name, n_distinct): rows become (column, value) pairs, which every task deduplicates before
    one shuffle of distinct values."""
    types = dict(df.dtypes)
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), _as_text(c, types[c]).alias("v")) for c in df.columns])
    pairs = df.select(F.explode(cells).alias("_p")).select("_p.column_name", "_p.v").groupBy("column_name", "v").agg(F.lit(1).alias("_one"))
    return pairs.groupBy("column_name").agg(F.count("v").alias("n_distinct"))


def distinct_per_column(df: DataFrame, approx: bool = False, rsd: float = 0.05) -> DataFrame:
    """Distinct values of every column, one row with a column each."""
    if approx:
        return df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in df.columns])
    n = distinct_counts(df)
    return n.agg(*[F.coalesce(F.max(F.when(F.col("column_name") == c, F.col("n_distinct"))), F.lit(0)).alias(c) for c in df.columns])


def first_last_row(df: DataFrame, order: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Values of the first and last row by ``order`` (plain ``first``/``last``
    depend on partition order; ``min_by``/``max_by`` do not)."""
    cols = list(cols or df.columns)
    return df.agg(*[F.min_by(c, order).alias(f"first_{c}") for c in cols],
                  *[F.max_by(c, order).alias(f"last_{c}") for c in cols])


def profile_table(df: DataFrame, order: str) -> DataFrame:
    """A14 (+P7, A10-A13): one row per column: type, rows, nulls, distinct,
    min, max, first, last (values as text).

    Two passes, joined on the column name: exact distinct counts
    (:func:`distinct_counts`) and everything else in a single aggregation.
    """
    cols = list(df.columns)
    types = dict(df.dtypes)

    def unpivot(wide: DataFrame, fields: list[str], lead: list[str]) -> DataFrame:
        args = ", ".join(f"'{c}', " + ", ".join(f"`{c}__{f}`" for f in fields) for c in cols)
        return wide.selectExpr(*lead, f"stack({len(cols)}, {args}) AS (column_name, {', '.join(fields)})")

    stats = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[a for c in cols for a in (
            F.count_if(F.col(c).isNull()).alias(f"{c}__n_null"),
            F.min(c).cast("string").alias(f"{c}__min_value"),
            F.max(c).cast("string").alias(f"{c}__max_value"),
            F.min_by(c, order).cast("string").alias(f"{c}__first_value"),
            F.max_by(c, order).cast("string").alias(f"{c}__last_value"))])
    long_stats = unpivot(stats, ["n_null", "min_value", "max_value", "first_value", "last_value"], ["n_rows"])
    type_col = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(types[c]))])
    out = long_stats.join(distinct_counts(df), "column_name", "left").withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0)))
    return out.select("n_rows", "column_name", type_col[F.col("column_name")].alias("data_type"),
                      "n_null", "n_distinct", "min_value", "max_value", "first_value", "last_value")


def population_stddev(df: DataFrame, keys: Sequence[str], value: str, out: str = "stddev") -> DataFrame:
    """A19 (D7, D8): population standard deviation; partial/final merge of
    (count, mean, M2) is done by Spark and is numerically stable."""
    return df.groupBy(*keys).agg(F.stddev_pop(F.col(value).cast("double")).alias(out))


def pivot_scaled(df: DataFrame, row_key: str, category: str, divisors: Mapping[str, float]) -> DataFrame:
    """Count per (row_key, category) pivoted to one column per category,
    each divided by its own divisor (e.g. years in the period)."""
    cats = list(divisors)
    wide = df.groupBy(row_key).pivot(category, cats).agg(F.count(F.lit(1)))
    return wide.select(row_key, *[F.try_divide(F.col(c), F.lit(float(divisors[c]))).alias(c) for c in cats])


def observed_divisors(df: DataFrame, category: str, year: Column | str, categories: Sequence[str]) -> dict[str, float]:
    """D22 alternative: divisor per category = number of distinct years seen in
    it (one small aggregate; at most ``len(categories)`` numbers reach the driver)."""
    y = F.col(year) if isinstance(year, str) else year
    rows = (df.filter(F.col(category).isin(list(categories)))
            .groupBy(category).agg(F.count_distinct(y).alias("_n")).collect())
    found = {r[category]: float(r["_n"]) for r in rows}
    return {c: found.get(c, 0.0) for c in categories}


def word_count(df: DataFrame, text: str, sep: str = " ", out: str = "count") -> DataFrame:
    """Occurrences of every token of ``split(text, sep)``."""
    words = df.select(F.explode(F.split(F.col(text), regex_literal(sep))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias(out))


def two_sample_t(df: DataFrame, a: str, b: str, pooled: bool = True) -> DataFrame:
    """Two-sample t statistic of columns ``a`` and ``b`` (nulls ignored),
    pooled variance by default (Welch otherwise).  One row: t, n_a, n_b."""
    stats = df.agg(F.avg(a).alias("ma"), F.avg(b).alias("mb"), F.var_samp(a).alias("va"),
                   F.var_samp(b).alias("vb"), F.count(a).alias("na"), F.count(b).alias("nb"))
    na, nb = F.col("na").cast("double"), F.col("nb").cast("double")
    inv_a, inv_b = F.try_divide(F.lit(1.0), na), F.try_divide(F.lit(1.0), nb)
    if pooled:
        sp = F.try_divide((na - 1) * F.col("va") + (nb - 1) * F.col("vb"), na + nb - 2)
        se = F.sqrt(sp * (inv_a + inv_b))
    else:
        se = F.sqrt(F.col("va") * inv_a + F.col("vb") * inv_b)
    return stats.select(F.try_divide(F.col("ma") - F.col("mb"), se).alias("t_stat"),
                        F.col("na").alias("n_a"), F.col("nb").alias("n_b"))


def ratio_of_sums(df: DataFrame, keys: Sequence[str], num: str, den: str, out: str = "ratio") -> DataFrame:
    """sum(num) / sum(den) per key (null when the denominator sums to 0)."""
    return df.groupBy(*keys).agg(F.try_divide(F.sum(num).cast("double"), F.sum(den).cast("double")).alias(out))
