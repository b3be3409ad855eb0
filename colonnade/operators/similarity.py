"""Correlation operators: keyed Pearson correlation (A21) and the best-correlated
partner per entity (C3) without enumerating all pairs.

For series of equal length ``n`` the Pearson correlation of ``x`` and ``y`` is the
dot product of their centred, unit-normalised versions ``z``.  Those lie on the
unit sphere of the (n-1)-dimensional sum-zero subspace, so the most correlated
partner is the nearest neighbour: ``|z_a - z_b|^2 = 2 - 2 r``.

The search works on distinct vectors, each with its number of entities and largest key.  Grids over at most three coordinates
(those that vary most) have sides 2, 1/2, 1/8, ...; a query meets the vectors of its own and the 26 adjacent
cells by an equi-join on (level, cell).  All points within one side are among them, so a query is final once everything
that could round to its best value, ties included, is within the side; else it goes on to the next coarser grid.  At side 2
the adjacent cells hold every point, so the result is exact and does not depend on where a query started.  Which entity of a vector is the partner
is a look-up of the next larger key in that vector's members.
"""

from __future__ import annotations

import itertools
import math
from functools import reduce
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colonnade.operators.sequences import dense_ordinal, running_total
from colonnade.session import checkpoint_root


def keyed_correlation(df: DataFrame, keys: Sequence[str], x: str, y: str, out: str = "corr") -> DataFrame:
    """Pearson correlation of two columns per key (a partial aggregate,
    so hot keys are combined map-side).  A group in which either column is
    constant has no correlation: null, instead of the division-by-zero error
    ``corr`` raises under ANSI mode (D21)."""
    r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    return df.groupBy(*keys).agg(r.alias(out))


def _helmert_rows(n: int) -> list[list[float]]:
    """Orthonormal basis of the sum-zero subspace of R^n (n-1 rows)."""
    rows = []
    for k in range(1, n):
        norm = math.sqrt(k * (k + 1))
        rows.append([1.0 / norm] * k + [-k / norm] + [0.0] * (n - k - 1))
    return rows


def unit_series(wide: DataFrame, entity: str, value_cols: Sequence[str]) -> DataFrame:
    """Centre and normalise each row's values; drop constant series.

    Returns ``entity`` plus ``u`` (array of n-1 Helmert coordinates, unit norm).
    """
    n = len(value_cols)
    vals = [F.col(c).cast("double") for c in value_cols]
    mean = sum(vals[1:], vals[0]) / F.lit(float(n))
    staged = wide.select(entity, *[v.alias(f"_x{i}") for i, v in enumerate(vals)], mean.alias("_mean"))
    cen = [F.col(f"_x{i}") - F.col("_mean") for i in range(n)]
    norm = F.sqrt(sum([c * c for c in cen[1:]], cen[0] * cen[0]))
    staged = staged.select(entity, *[c.alias(f"_y{i}") for i, c in enumerate(cen)], norm.alias("_norm"))
    staged = staged.filter(F.col("_norm") > 0)
    coords = []
    for row in _helmert_rows(n):
        terms = [F.col(f"_y{i}") * F.lit(w) for i, w in enumerate(row) if w != 0.0]
        coords.append(sum(terms[1:], terms[0]) / F.col("_norm"))
    return staged.select(entity, F.array(*coords).alias("u"))


# A query starts on the coarsest grid where its own cell holds at most this many distinct vectors.
DENSE_CELL = 64
# Coordinates that make up a cell.
_CELL_DIMS = 3


def _side(level: int) -> float:
    return 2.0 * 4.0 ** -level


def _dot(a: Column, b: Column, dims: int) -> Column:
    return reduce(lambda x, y: x + y, [a[i] * b[i] for i in range(dims)])


def _at_levels(df: DataFrame, level: Column | None, levels: Sequence[int], axes: Sequence[int], around: bool) -> DataFrame:
    """Add ``_level`` and ``_cell`` of vector ``u``: one row per level (``level`` None: all of ``levels``) and, with
    ``around``, per adjacent cell."""
    chosen = F.array(*[F.lit(k) for k in levels])
    out = df.withColumn("_level", F.explode(chosen) if level is None else level)
    side = F.lit(2.0) * F.pow(F.lit(4.0), -F.col("_level"))
    home = [F.floor(F.col("u")[i] / side).cast("bigint") for i in axes]
    if not around:
        return out.withColumn("_cell", F.array(*home))
    shifts = F.array(*[F.array(*[F.lit(v).cast("bigint") for v in o]) for o in itertools.product((-1, 0, 1), repeat=len(axes))])
    out = out.withColumns({"_home": F.array(*home), "_shift": F.explode(shifts)})
    return out.withColumn("_cell", F.zip_with("_home", "_shift", lambda h, s: h + s)).drop("_home", "_shift")


def _next_keys(members: DataFrame, asks: DataFrame) -> DataFrame:
    """Per ask (``_list``, ``_key``, ``_r``) the next larger key in that list: (``_key``, ``_partner``, ``_r``).

    ``members``: (``_vid``, ``_member``, ``_ord``).  Asks are sorted in among the members of their list; the running count of members
    gives the position, a join the key there.  Linear in members and asks; large lists are split like any sequence."""
    listed = members.join(asks.select(F.col("_list").alias("_vid")).distinct(), "_vid", "left_semi")
    rows = (listed.select(F.col("_vid").alias("_list"), F.col("_member").alias("_key"), F.lit(None).cast("double").alias("_r"), F.lit(1).alias("_is"))
            .unionByName(asks.select("_list", "_key", "_r", F.lit(0).alias("_is"))))
    # A key asked for in its own list comes after itself.
    placed = running_total(rows, ["_list"], ["_key", "-_is"], "_is", "_c").where("_is = 0")
    there = members.select(F.col("_vid").alias("_list"), (F.col("_ord") - 1).alias("_c"), F.col("_member").alias("_partner"))
    return placed.join(there, ["_list", "_c"]).select("_key", "_partner", "_r")


def _near_copies(vectors: DataFrame, axes: Sequence[int], dims: int, digits: int) -> DataFrame:
    """Ordered pairs of distinct vectors whose dot product rounds to 1 at ``digits`` digits."""
    level = max(0, math.floor(math.log(2.0 / (math.sqrt(2.0 * 10.0 ** -digits) * 1.01), 4)))
    right = _at_levels(vectors, F.lit(level), [], axes, False).select(
        "_cell", F.col("_vid").alias("_w"), F.col("u").alias("_uw"), F.col("_n").alias("_nw"))
    left = _at_levels(vectors, F.lit(level), [], axes, True).select("_cell", F.col("_vid").alias("_v"), F.col("u").alias("_uv"), F.col("_n").alias("_nv"))
    pairs = left.join(right, "_cell").where(F.col("_v") != F.col("_w"))
    return pairs.select("_v", "_w", "_nv", "_nw", _dot(F.col("_uv"), F.col("_uw"), dims).alias("_r")).where(F.round("_r", digits) >= 1.0)


def _partners_at_one(members: DataFrame, vectors: DataFrame, axes: Sequence[int], dims: int, digits: int) -> DataFrame:
    """Candidates (``_key``, ``_partner``, ``_r``) of all entities that are not the largest of their vector: the next entity
    of the same vector, and of vectors whose correlation with it rounds to 1.

    Of two such vectors the shorter list is looked up in the longer: its keys ask for their next larger key there, or for
    the key before them, whose next larger one they are."""
    self_r = _dot(F.col("u"), F.col("u"), dims)
    size = vectors.select("_vid", "u", "_n")
    following = members.select("_vid", (F.col("_ord") - 1).alias("_ord"), F.col("_member").alias("_partner"))
    own = members.join(following, ["_vid", "_ord"]).join(size, "_vid").select(F.col("_member").alias("_key"), "_partner", self_r.alias("_r"))

    pairs = _near_copies(vectors, axes, dims, digits)
    keys = members.select(F.col("_vid").alias("_from"), F.col("_member").alias("_key"), "_ord")
    # v's entities ask in the longer list of w ...
    up = pairs.where("_nw > _nv").join(keys, pairs["_v"] == keys["_from"]).where(F.col("_ord") < F.col("_nv"))
    above = _next_keys(members, up.select(F.col("_w").alias("_list"), "_key", "_r"))
    # ... or w's entities look for the one before them in the longer list of v.
    down = pairs.where("_nw <= _nv").join(keys, pairs["_w"] == keys["_from"])
    rows = (members.join(down.select(F.col("_v").alias("_vid")).distinct(), "_vid", "left_semi")
            .select(F.col("_vid").alias("_list"), F.col("_member").alias("_partner"), F.lit(None).cast("double").alias("_r"), F.lit(1).alias("_is"))
            .unionByName(down.select(F.col("_v").alias("_list"), F.col("_key").alias("_partner"), "_r", F.lit(0).alias("_is"))))
    placed = running_total(rows, ["_list"], ["_partner"], "_is", "_c").where("_is = 0")
    before = members.join(size.select("_vid", "_n"), "_vid").where(F.col("_ord") < F.col("_n")).select(
        F.col("_vid").alias("_list"), F.col("_ord").alias("_c"), F.col("_member").alias("_key"))
    below = placed.join(before, ["_list", "_c"]).select("_key", "_partner", "_r")
    return own.unionByName(above).unionByName(below)


def _best_vectors(vectors: DataFrame, axes: Sequence[int], dims: int, digits: int) -> DataFrame:
    """For the largest key of each vector, the vectors with a larger key and the greatest rounded correlation: (``_list``,
    ``_key``, ``_r``)."""
    finest = max(0, math.floor(math.log(2.0 / math.sqrt(4.0 * 10.0 ** -digits), 4)))  # finer ones can settle nothing
    levels = list(range(finest + 1))
    crowd = _at_levels(vectors, None, levels, axes, False)
    crowd = crowd.join(crowd.groupBy("_level", "_cell").agg(F.count(F.lit(1)).alias("_k")), ["_level", "_cell"])
    start = crowd.groupBy("_vid").agg(F.coalesce(F.min(F.when(F.col("_k") <= DENSE_CELL, F.col("_level"))), F.lit(finest)).alias("_at"))
    active = vectors.select("_vid", F.col("_last").alias("_key"), "u").join(start, "_vid").checkpoint(eager=True)

    def meet(queries: DataFrame, used: Sequence[int]) -> DataFrame:
        points = _at_levels(vectors, None, used, axes, False).select("_level", "_cell", F.col("_vid").alias("_list"), F.col("u").alias("_uw"), "_last")
        asked = _at_levels(queries, F.col("_at"), [], axes, True).withColumnRenamed("u", "_uv")
        return asked.join(points, ["_level", "_cell"]).where(F.col("_last") > F.col("_key")).withColumn("_r", _dot(F.col("_uv"), F.col("_uw"), dims))

    done: list[DataFrame] = []
    while used := [r[0] for r in active.select("_at").distinct().collect()]:  # one entry a level
        best = meet(active, used).groupBy("_vid").agg(F.max(F.round("_r", digits)).alias("_rr"))
        # All that could round to the best value lies within this distance.
        reach = F.sqrt(F.greatest(F.lit(0.0), F.lit(2.0) - F.lit(2.0) * (F.col("_rr") - F.lit(10.0 ** -digits))))
        side = F.lit(2.0) * F.pow(F.lit(4.0), -F.col("_at"))
        final = (F.col("_at") == 0) | (F.col("_rr").isNotNull() & (reach <= side * (1.0 - 1e-9)))
        state = active.join(best, "_vid", "left").withColumn("_final", final).checkpoint(eager=True)
        done.append(state.where(F.col("_final") & F.col("_rr").isNotNull()).drop("_final"))
        active = state.where(~F.col("_final")).select("_vid", "_key", "u", (F.col("_at") - 1).alias("_at"))
    if not done:
        return vectors.select(F.col("_vid").alias("_list"), F.col("_last").alias("_key"), F.lit(0.0).alias("_r")).limit(0)
    settled = reduce(DataFrame.unionByName, done)
    ties = meet(settled, levels).where(F.round("_r", digits) == F.col("_rr"))
    return ties.select("_list", "_key", "_r")


def best_correlated_partner(long: DataFrame, entity: str, period: str, value: str,
                            periods: Sequence, digits: int = 9) -> DataFrame:
    """For each entity with a value in every one of ``periods``, the entity
    with a larger key whose series correlates best (to ``digits`` digits; ties: smaller key).

    ``long`` has one row per (entity, period); keys may be of any ordered type.  Returns (entity, partner, corr); the largest
    key has no partner.  Entities with one series (copies) are never paired with each other, and only the largest of
    them searches for other series.
    """
    checkpoint_root(long.sparkSession)
    wide = (long.filter(F.col(period).isin(list(periods)))
            .groupBy(entity).pivot(period, list(periods)).agg(F.first(value)))
    cols = [str(p) for p in periods]
    points = unit_series(wide.dropna(subset=cols), entity, cols).withColumnRenamed(entity, "_member").checkpoint(eager=True)
    dims = len(periods) - 1
    vectors = points.groupBy("u").agg(F.min("_member").alias("_vid"), F.max("_member").alias("_last"), F.count(F.lit(1)).alias("_n")).checkpoint(eager=True)
    spread = vectors.agg(*[F.var_pop(F.col("u")[i]).alias(str(i)) for i in range(dims)]).first()
    axes = sorted(range(dims), key=lambda i: -(spread[i] or 0.0))[:_CELL_DIMS]
    members = dense_ordinal(points.join(vectors, "u").select("_vid", "_member"), ["_vid"], ["_member"], "_ord").checkpoint(eager=True)
    found = _partners_at_one(members, vectors, axes, dims, digits)
    found = found.unionByName(_next_keys(members, _best_vectors(vectors, axes, dims, digits)))
    best = found.groupBy("_key").agg(F.min(F.struct((-F.round("_r", digits)).alias("n"), F.col("_partner").alias("p"), F.col("_r").alias("r"))).alias("_m"))
    return best.select(F.col("_key").alias(entity), F.col("_m.p").alias("partner"), F.col("_m.r").alias("corr"))
