"""Joins (J1, J2, J5).  The level-to-level join (J4) is the running product in
:func:`colonnade.operators.sequences.level_chained_discount` and the bar range
join (J6) is the block decomposition in
:func:`colonnade.operators.sequences.block_delayed_ewma`.

Strategy is left to Catalyst and AQE: a side is broadcast only when its size is
known (statistics or runtime size below ``autoBroadcastJoinThreshold``), and
sort-merge joins with a hot key are split by AQE's skew-join handling.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on identically named key columns (kept once)."""
    return left.join(right, on=list(keys), how=how)


def attach_group_aggregate(df: DataFrame, keys: Sequence[str], value: str, out: str = "group_mean",
                           fn: str = "avg") -> DataFrame:
    """A per-group aggregate attached to every row of the group.

    Aggregate-then-join rather than ``avg().over(partitionBy(keys))``: the
    aggregate combines a hot group map-side, and the join back has one row per
    key on the aggregated side, which AQE can split for a hot key.  (A window
    partitioned by the key would put a hot group into a single task.)
    """
    agg = getattr(F, fn)
    stats = df.groupBy(*keys).agg(agg(value).alias(out))
    # Null-safe on the keys: rows with a null key form a group, as in a window.
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    joined = df.alias("l").join(stats.alias("r"), cond, "inner")
    return joined.select(*[F.col(f"l.{c}") for c in df.columns], F.col(f"r.{out}"))
