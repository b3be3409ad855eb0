"""Per-entity sequence operators (W6-W9) and the skew-safe building blocks they share.

A single entity may hold a large share of all rows, so nothing here partitions a window by the entity alone:

* :func:`dense_ordinal` and :func:`running_total` cut groups above ``split_rows`` rows into contiguous pieces of about
  that many rows (equi-depth splitters from a row sample, compared on all order columns and at last on a row hash, so
  ties, crowded values, strings and descending columns split alike).  Pieces are worked on alone; their sizes or totals
  give the offsets.
* :func:`decayed_prefix_sum` evaluates ``sum_{j<=i} v_j * d^(i-j)`` as a tree: windows over chunks of bounded
  length, then the same over the chunks' end values, until what a chunk passes on vanishes in double precision.  The depth follows from
  ``d`` alone.

Plans are fixed when they are built: no action runs, nothing depends on size hints.  Where no group is large the splitters
are an empty (broadcast) table and adaptive execution drops the branches that need them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colonnade.functions.scalars import block_cutoff, weight_mass


def _null_safe_on(left: str, right: str, keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return cond


# Groups up to this many rows are numbered in one task; larger ("hot") groups are cut into pieces of about this size.
SPLIT_ROWS = 2_000_000
# At most this many pieces (hence hot groups) over the whole table, whatever its size: beyond SPLIT_ROWS * MAX_PIECES rows
# the pieces grow instead.  This bounds what is broadcast.
MAX_PIECES = 100_000
# Sampled rows per piece: the standard deviation of a piece's size is about an eighth.
_SAMPLE_PER_PIECE = 64


def descending_keys(c: Column, dtype: str) -> list[Column]:
    """Ascending keys that order like ``c`` descending (nulls last)."""
    if dtype in ("tinyint", "smallint", "int", "bigint"):
        keys = [F.bitwise_not(c)]
    elif dtype == "boolean":
        keys = [~c]
    elif dtype == "date":
        keys = [F.bitwise_not(F.unix_date(c))]
    elif dtype == "timestamp":
        keys = [F.bitwise_not(F.unix_micros(c))]
    elif dtype == "timestamp_ntz":
        keys = [F.bitwise_not(F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), c))]
    elif dtype in ("float", "double"):
        keys = [~F.isnan(c), -c]
    elif dtype.startswith("decimal"):
        keys = [-c]
    elif dtype in ("string", "binary"):
        # Complementary hex digits turn the byte order round; a last sign above all digits puts prefixes last.
        keys = [F.concat(F.translate(F.hex(c), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))]
    else:
        raise ValueError(f"no descending order for {dtype}")
    return [c.isNull(), *keys]


def _ordering(df: DataFrame, order: Sequence[str | Column]) -> tuple[list[Column], list[Column]]:
    """Sort expressions, and ascending keys of the same order.  A column is a name, ``-name`` for descending, or an
    expression (ascending)."""
    types, sorts, keys = dict(df.dtypes), [], []
    for item in order:
        if isinstance(item, str) and item.startswith("-") and item not in types:
            c = F.col(item[1:])
            sorts.append(c.desc())
            keys += descending_keys(c, types[item[1:]])
        else:
            c = F.col(item) if isinstance(item, str) else item
            sorts.append(c.asc())
            keys.append(c)
    return sorts, keys


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[c for c, t in df.dtypes if not t.startswith("map")])


def _splitters(df: DataFrame, keys: Sequence[str], place: Column, split_rows: int) -> DataFrame:
    """Per hot group (``keys``) the sorted array ``_sp`` of places where its pieces begin, at most ``MAX_PIECES`` in all."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cnt"))
    total = sizes.agg(F.coalesce(F.sum("_cnt"), F.lit(0))).scalar()
    limit = F.greatest(F.lit(split_rows), F.ceil(total / F.lit(MAX_PIECES)))
    hot = sizes.withColumn("_limit", limit).where(F.col("_cnt") > F.col("_limit")).select(
        *keys, F.least(F.lit(_SAMPLE_PER_PIECE), "_limit").alias("_per"), F.greatest(F.lit(1), F.floor(F.col("_limit") / F.lit(_SAMPLE_PER_PIECE))).alias("_every"))
    staged = df.select(*keys, place.alias("_t"), _row_hash(df).alias("_h"))
    sample = staged.alias("l").join(F.broadcast(hot).alias("r"), _null_safe_on("l", "r", keys)).select("l.*", "_per", "_every")
    sample = sample.where(F.pmod(F.col("_h"), F.col("_every")) == 0)
    ranked = sample.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy("_t")))
    return ranked.where(F.col("_rn") % F.col("_per") == 0).groupBy(*keys).agg(F.sort_array(F.collect_set("_t")).alias("_sp"))


def _piece(spot: Column) -> Column:
    """How many of ``_sp`` are not above ``spot``, by binary search."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(MAX_PIECES.bit_length()))])
    found = F.aggregate(steps, F.lit(0), lambda low, step: F.when(F.get("_sp", low + step - 1) <= spot, low + step).otherwise(low))
    return F.when(F.col("_sp").isNull(), F.lit(0)).otherwise(found)


def _pieces(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], split_rows: int) -> tuple[DataFrame, DataFrame, list[Column]]:
    """(rows with ``_piece``, rows of split groups only, sort expressions).

    ``_piece`` is 0 in ordinary groups; a group above ``split_rows`` rows is cut where the splitters say.  Everything is a
    function of the rows (hash sample, not a random one), so all branches of a plan, and tasks run again after a lost executor,
    agree.  Rows equal in every column are not parted.
    """
    sorts, ascending = _ordering(df, order)
    # Ties in all order columns are parted by a hash of the row.
    place = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(ascending)], _row_hash(df).alias("h"))
    splitters = F.broadcast(_splitters(df, keys, place, split_rows)).alias("r")
    on = _null_safe_on("l", "r", keys)
    tagged, hot = (df.alias("l").join(splitters, on, how).select("l.*", "r._sp").withColumn("_piece", _piece(place)).drop("_sp")
                   for how in ("left", "inner"))
    return tagged, hot, sorts


def _grouped(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The rows with a key: for ``keys=[]`` a column that is 0 everywhere, which the optimiser does not know, so
    that joins on it stay hash joins."""
    return (df, list(keys)) if keys else (df.withColumn("_all", F.pmod(_row_hash(df), F.lit(1))), ["_all"])


def _with_offsets(local: DataFrame, per_piece: DataFrame, keys: Sequence[str], columns: Sequence[str], mine: str, total: str, out: Column) -> DataFrame:
    """Add to ``mine`` of every row what the earlier pieces of its group hold in ``total`` (column ``_off`` in ``out``)."""
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_piece.select(*keys, "_piece", F.sum(total).over(before).alias("_off")).where(F.col("_off").isNotNull())
    on = _null_safe_on("l", "r", keys) & (F.col("l._piece") == F.col("r._piece"))
    joined = local.alias("l").join(F.broadcast(offsets).alias("r"), on, "left")  # at most MAX_PIECES and a few rows
    return joined.select(*[F.col(f"l.{c}") for c in columns], out)


def dense_ordinal(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                  out: str = "ordinal", split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Add ``out`` = 1, 2, ... per ``keys`` group following ``order`` (``-name``: descending).

    Same result as ``row_number().over(partitionBy(keys).orderBy(order))``, but no group larger than about ``split_rows``
    rows is numbered in one task.  ``order`` should make rows unique inside a group (add an id column); ties are numbered
    arbitrarily.
    """
    rows, keys = _grouped(df, keys)
    tagged, hot, sorts = _pieces(rows, keys, order, split_rows)
    local = tagged.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys, "_piece").orderBy(*sorts)))
    sizes = hot.groupBy(*keys, "_piece").agg(F.count(F.lit(1)).alias("_n"))
    number = (F.coalesce(F.col("r._off"), F.lit(0)) + F.col("l._rn")).cast("bigint").alias(out)
    return _with_offsets(local, sizes, keys, df.columns, "_rn", "_n", number)


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str,
                  out: str = "running_total", split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Add ``out`` = sum of ``value`` over rows up to and including this one (by ``order``) within ``keys`` (``keys=[]``:
    over the whole table).  Split like :func:`dense_ordinal`: each piece sums its own rows, the piece totals give the offsets."""
    rows, keys = _grouped(df, keys)
    tagged, hot, sorts = _pieces(rows, keys, order, split_rows)
    inside = Window.partitionBy(*keys, "_piece").orderBy(*sorts).rowsBetween(Window.unboundedPreceding, 0)
    local = tagged.withColumn("_loc", F.sum(value).over(inside))
    totals = hot.groupBy(*keys, "_piece").agg(F.sum(value).alias("_tot"))
    summed = F.when(F.col("r._off").isNull(), F.col("l._loc")).otherwise(F.col("r._off") + F.coalesce(F.col("l._loc"), F.lit(0))).alias(out)
    return _with_offsets(local, totals, keys, df.columns, "_loc", "_tot", summed)


# Chunks hold at most this many ordinals.
MAX_CHUNK = 1_000_000
# A factor below this turns every double into zero (the greatest is below 1e309, the least above 1e-324).
_VANISHED = 635.0
# A chunk's end value is handed on to the next ones in copies if at most this many of them can notice it.
_MAX_COPIES = 16


def _chunk_size(decay: float, cap: int) -> int:
    """Largest chunk with ``decay^-chunk`` below 1e150 (no overflow in the rescaled window sum), at most ``cap``."""
    return cap if decay >= 1.0 else max(1, min(cap, int(150.0 / -math.log10(decay))))


def decayed_prefix_sum(df: DataFrame, keys: Sequence[str], ordinal: str, value: str | Column,
                       decay: float, out: str, chunk: int | None = None) -> DataFrame:
    """Add ``out`` = sum over j <= i of ``value_j * decay^(i - j)`` per ``keys``.

    ``ordinal`` must be dense (1..n) inside each group.  The pairs (decay^n, sum) of stretches of n rows combine
    associatively, so the sum is a tree: inside a chunk of ``G`` ordinals it is ``d^p * sum(v_j * d^-p_j)``, a
    running window sum; the end values of full chunks are again such a series with decay ``d^G``, whose own prefix sums are what each chunk
    gets from the earlier ones.  The tree ends where ``d^G`` is so small that a value vanishes within a few chunks (it
    is then handed on in copies), or where the chunks span all 64-bit ordinals.  ``chunk`` (``G`` of the first level; a
    test hook) does not change the result.
    """
    if not 0.0 <= decay <= 1.0:
        raise ValueError("decay must lie in [0, 1]")
    val = (F.col(value) if isinstance(value, str) else value).cast("double")
    if decay == 0.0:
        return df.withColumn(out, val)
    staged = df.withColumns({"_b": F.col(ordinal).cast("bigint") - 1, "_v": val})
    return _prefix(staged, list(keys), float(decay), chunk, 1, out).drop("_b", "_v")


def _prefix(df: DataFrame, keys: list[str], d: float, chunk: int | None, span: int, out: str) -> DataFrame:
    """``out`` = decayed prefix sum of ``_v`` by the dense 0-based ``_b``; each row stands for ``span`` ordinals."""
    g = chunk or _chunk_size(d, MAX_CHUNK)
    staged = df.withColumns({"_c": F.floor(F.col("_b") / F.lit(g)).cast("bigint"), "_p": F.pmod("_b", F.lit(g))})
    running = Window.partitionBy(*keys, "_c").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    scaled = F.col("_v") * F.pow(F.lit(d), -F.col("_p"))
    local = staged.withColumn("_loc", F.pow(F.lit(d), F.col("_p")) * F.sum(scaled).over(running))
    if g * span >= 1 << 62:
        return local.withColumn(out, F.col("_loc")).drop("_c", "_p", "_loc")
    # Only a full chunk has a successor; its last row holds what it passes on.
    ends = local.where(F.col("_p") == g - 1).select(*keys, F.col("_c").alias("_b"), F.col("_loc").alias("_v"))
    step = d ** g
    copies = math.ceil(_VANISHED / -math.log10(step)) if 0.0 < step < 1.0 else 1 if step == 0.0 else math.inf
    if copies <= _MAX_COPIES:
        weights = F.array(*[F.struct(F.lit(j + 1).alias("k"), F.lit(step ** j).alias("w")) for j in range(copies)])
        spread = ends.select(*keys, "_b", "_v", F.explode(weights).alias("_s"))
        carry = (spread.groupBy(*keys, (F.col("_b") + F.col("_s.k")).alias("_c"))
                 .agg(F.sum(F.col("_s.w") * F.col("_v")).alias("_carry")))
    else:
        sums = _prefix(ends, keys, step, chunk, g * span, "_carry")
        carry = sums.select(*keys, (F.col("_b") + 1).alias("_c"), "_carry")
    joined = local.alias("l").join(carry.alias("r"), _null_safe_on("l", "r", keys) & (F.col("l._c") == F.col("r._c")), "left")
    total = F.col("l._loc") + F.pow(F.lit(d), F.col("l._p") + 1) * F.coalesce(F.col("r._carry"), F.lit(0.0))
    return joined.select(*[F.col(f"l.{c}") for c in df.columns], total.alias(out))


def block_delayed_ewma(bars: DataFrame, entity: Sequence[str], ordinal: str, value: str,
                       alpha: float = 0.2, block: int = 10, out: str = "ewma", how: str = "left") -> DataFrame:
    """For ordinal ``b`` the EWMA of the values at ordinals up to
    ``cutoff(b) = block * floor((b - 1) / block)``, newest first:

        ewma(b) = sum_{j <= c} alpha * (1 - alpha)^(c - j) * value_j     (D14, D15)

    Bars in the first block have no value (``how='left'`` keeps them with null;
    ``how='inner'`` drops them, D16).  Also adds ``weight_mass`` = 1-(1-alpha)^c (W9).

    Plan: per-block sums ``S_k`` (partial aggregation), a decayed prefix over
    blocks with decay ``(1-alpha)^block`` and one join back on (entity, block);
    the number of exchanges does not depend on the number of bars.
    """
    keys = list(entity)
    # Blocks are named by the cutoff of the bars that follow them.
    cutoff = block_cutoff(ordinal, block)
    weight = F.lit(alpha) * F.pow(F.lit(1.0 - alpha), cutoff + block - F.col(ordinal)) * F.col(value).cast("double")
    sums = bars.groupBy(*keys, (F.floor(cutoff / block) + 1).alias("_k")).agg(F.sum(weight).alias("_sum"))
    ewma = decayed_prefix_sum(sums, keys, "_k", "_sum", (1.0 - alpha) ** block, "_ewma")
    ewma = ewma.select(*keys, (F.col("_k") * block).alias("_cut"), "_ewma")
    joined = bars.withColumn("_cut", cutoff).alias("l").join(
        ewma.alias("r"), _null_safe_on("l", "r", keys) & (F.col("l._cut") == F.col("r._cut")), how)
    return joined.select(
        *[F.col(f"l.{c}") for c in bars.columns],
        F.col("r._ewma").alias(out),
        F.when(F.col("l._cut") > 0, weight_mass(F.col("l._cut"), alpha)).alias("weight_mass"),
    )


def recursive_smoothing(series: DataFrame, entity: Sequence[str], ordinal: str, value: str,
                        alpha: float = 0.2, out: str = "level") -> DataFrame:
    """``L_t = alpha * y_t + (1 - alpha) * L_(t-1)`` with ``L_0 = 0`` for every row,
    i.e. a decayed prefix sum of ``alpha * y`` with decay ``1 - alpha``."""
    return decayed_prefix_sum(series, list(entity), ordinal, F.lit(alpha) * F.col(value).cast("double"), 1.0 - alpha, out)


def level_factors(rows: DataFrame, keys: Sequence[str], level: str, pct: str, out: str = "factor") -> DataFrame:
    """Per (``keys``, ``level``) the product over lower levels l of 1 - (sum of ``pct`` at l); 1 at the lowest."""
    sums = rows.groupBy(*keys, level).agg(F.sum(pct).alias("_plevel"))
    lower = Window.partitionBy(*keys).orderBy(level).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(*keys, level, F.coalesce(F.product(F.lit(1.0) - F.col("_plevel")).over(lower), F.lit(1.0)).alias(out))


def level_chained_discount(rows: DataFrame, idx: Sequence[str], level: str, pct: str, cost: str,
                           prev_out: str = "previous_deductions", disc_out: str = "coupon_discount",
                           costs: DataFrame | None = None) -> DataFrame:
    """Discounts applied level by level.

    A coupon at level ``l`` takes ``pct * (cost - deductions of all lower levels)``;
    coupons sharing a level see the same previous deductions.  With
    ``P_l = sum of pct at level l`` and ``f_l = prod_{l' < l} (1 - P_l')``:
    previous = cost * (1 - f_l), discount = pct * cost * f_l.

    Level sums are a partial aggregation per (transaction, level); the running
    product is a window over the distinct levels of one transaction (a short,
    fixed ladder, however many rows the transaction has); the result is joined
    back on (transaction, level), a join that AQE splits if one key is hot.
    ``costs`` (``idx``, ``cost``) brings the cost of a transaction from another table: the factors don't need it, so
    it is joined once, at the end.
    """
    keys = list(idx)
    factors = level_factors(rows, keys, level, pct, "_f")
    joined = rows.alias("l").join(factors.alias("r"), _null_safe_on("l", "r", [*keys, level]), "inner").select("l.*", "r._f")
    columns = list(rows.columns)
    if costs is not None:
        joined = joined.join(costs.select(*keys, cost), keys)
        columns.append(cost)
    return joined.select(
        *columns,
        (F.col(cost) * (F.lit(1.0) - F.col("_f"))).alias(prev_out),
        (F.col(pct) * F.col(cost) * F.col("_f")).alias(disc_out),
    )
