"""Time windows and per-entity window operators.

The lag and latest-row operators run on per-entity *aggregated* series (one row
per entity and week), whose length is bounded by the calendar, not by the raw
row count.  ``latest_per_group`` is planned with a partial ``WindowGroupLimit``
before the shuffle; ``all_but_latest`` uses an aggregate + anti-join so that no
group has to fit in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def tumbling_count(df: DataFrame, ts: str, keys: Sequence[str], count_col: str | None = None,
                   duration: str = "1 week", out: str = "event_count") -> DataFrame:
    """Rows (non-null ``count_col`` values) per tumbling window and keys.

    Windows are aligned to the epoch (1970-01-01 is a Thursday, so weeks run
    Thursday to Thursday, D11).  Returns ``window`` (struct start/end), keys, count.
    """
    counted = F.count(count_col) if count_col else F.count(F.lit(1))
    return df.groupBy(F.window(ts, duration).alias("window"), *keys).agg(counted.alias(out))


def densify_periods(series: DataFrame, entity: Sequence[str], start: str, value: str,
                    step: str = "7 days", fill=0) -> DataFrame:
    """D12 option: give every entity a row for each period between its first
    and last one (``start`` timestamps ``step`` apart), ``fill`` where absent,
    so that row lags become calendar lags.

    One row per entity and period is generated with ``sequence`` + ``explode``
    from the entity's own first/last period (bounded by its time span), then
    joined with the observed rows on (entity, period).
    """
    span = series.groupBy(*entity).agg(F.min(start).alias("_lo"), F.max(start).alias("_hi"))
    grid = span.select(*entity, F.explode(F.sequence("_lo", "_hi", F.expr(f"INTERVAL {step}"))).alias(start))
    return (grid.join(series, on=[*entity, start], how="left")
            .withColumn(value, F.coalesce(F.col(value), F.lit(fill))))


def lag_features(series: DataFrame, entity: Sequence[str], order: Sequence[str | Column],
                 value: str, lags: Mapping[str, int]) -> DataFrame:
    """``lag(value, n)`` per entity following ``order`` (row lags, D12).

    ``order`` should be total within an entity (D13: add the remaining group
    keys as tie-breakers).
    """
    w = Window.partitionBy(*entity).orderBy(*order)
    out = series
    for name, n in lags.items():
        out = out.withColumn(name, F.lag(F.col(value), n).over(w))
    return out


def latest_per_group(df: DataFrame, entity: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The latest row per entity (``order`` ascending; latest = last)."""
    desc = [(F.col(c) if isinstance(c, str) else c).desc() for c in order]
    w = Window.partitionBy(*entity).orderBy(*desc)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def all_but_latest(df: DataFrame, entity: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Every row except the latest one per entity (``order`` must be unique per entity)."""
    latest = df.groupBy(*entity).agg(F.max(F.struct(*order)).alias("_m"))
    latest = latest.select(*entity, *[F.col(f"_m.{c}").alias(c) for c in order])
    cond = F.lit(True)
    for c in [*entity, *order]:  # null-safe: a null key is a group of its own
        cond = cond & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return df.alias("l").join(latest.alias("r"), cond, "left_anti")


def mark_last_per_entity(df: DataFrame, entity: Sequence[str], order: Sequence[str], out: str = "is_last") -> DataFrame:
    """M14 as a column: whether the row is the latest of its entity (``order`` must be unique per entity).  One aggregate
    per entity, joined back, so no entity has to fit a task."""
    latest = df.groupBy(*entity).agg(F.max(F.struct(*order)).alias("_m"))
    cond = F.lit(True)
    for c in entity:
        cond = cond & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    joined = df.alias("l").join(latest.alias("r"), cond)
    return joined.select("l.*", F.struct(*[F.col(f"l.{c}") for c in order]).eqNullSafe(F.col("r._m")).alias(out))


def split_last_per_entity(df: DataFrame, entity: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(train, test) where test is the latest row of each entity.  Both read one marked frame; persist it
    (:func:`mark_last_per_entity`) where several actions follow."""
    marked = mark_last_per_entity(df, entity, order, "_last")
    return marked.filter(~F.col("_last")).drop("_last"), marked.filter("_last").drop("_last")


def calendar_lags(series: DataFrame, entity: Sequence[str], start: str, value: str, lags: Mapping[str, int],
                  step_days: int = 7, fill=0) -> DataFrame:
    """W2 by the calendar: for every period of an entity (absent ones between its first and last get ``fill``) the value n
    periods before; null before the entity's first period.

    Each value is sent to the periods that look back at it and one aggregation by (entity, period) collects them, so
    lags of any length cost one shuffle and no entity is a window partition.
    """
    dense = densify_periods(series.select(*entity, start, value), entity, start, value, f"{step_days} days", fill)
    names = {"_now": 0, **lags}
    sent = F.array(*[F.struct(F.lit(name).alias("name"), F.expr(f"{start} + INTERVAL {n * step_days} days").alias("at")) for name, n in names.items()])
    spread = dense.select(*entity, value, F.explode(sent).alias("_s")).select(*entity, F.col("_s.at").alias(start), F.col("_s.name").alias("_name"), value)
    got = spread.groupBy(*entity, start).agg(
        F.count_if(F.col("_name") == "_now").alias("_here"),
        *[F.max(F.when(F.col("_name") == name, F.col(value))).alias(value if name == "_now" else name) for name in names])
    return got.filter("_here > 0").drop("_here")
