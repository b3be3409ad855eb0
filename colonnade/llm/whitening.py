"""Operator 13: embedding whitening by spectrum slicing.

Entries become integers floor(256 * c).  The fit list holds each distinct vector once; its covariance is summed in Spark
from integer differences to the rounded mean, corrected by exact fractions, so it does not depend on partitions or order.  Of its
eigenvalues the leading ones are found one at a time: the inertia of an LDL' factorisation of the shifted covariance
(Sylvester) counts the eigenvalues above the shift, bisection on that count isolates the j-th one, inverse iteration at the
interval's middle and Rayleigh quotient iteration converge to it, and two more counts, just below and above the result,
certify that it is number j.  Equal eigenvalues, which no shift can part, are taken together; any orthonormal vectors of their space serve.

Vectors that are null, empty, or hold null or non-finite entries or entries beyond a long take no part.  Vectors of different
lengths live in different spaces: each length has its own fit list and components.  Repeated rows and ids give rows of
their own but count once in the fit.  A component without variance (single vector, fewer dimensions than components, copies) has
explained 0, or null if nothing varies, and whitened null.  A deviation beyond a long is null.  Only ``keep`` columns
come along.  An empty table gives no rows.

The driver holds one covariance a length: dimensions squared, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colonnade.llm.text import materialise

_LIMB = 1 << 62
_EXACT = float(1 << 53)


# ---- inertia and eigenpairs of one symmetric matrix ---------------------------------------------

def count_above(matrix: np.ndarray, shift: float) -> int:
    """Number of eigenvalues above ``shift``: positive pivots of LDL' of matrix - shift * I with 1 x 1 and 2 x 2 pivots
    (Bunch and Kaufman's choice, which keeps the factors bounded)."""
    a = matrix - shift * np.eye(len(matrix))
    alpha = (1 + 17 ** 0.5) / 8
    above = 0
    while (n := len(a)) > 0:
        if n == 1:
            return above + int(a[0, 0] > 0)
        below = np.abs(a[1:, 0])
        r = int(below.argmax()) + 1
        biggest = below[r - 1]
        if biggest == 0:
            above += int(a[0, 0] > 0)
            a = a[1:, 1:]
            continue
        if abs(a[0, 0]) < alpha * biggest:
            others = np.abs(a[r])
            others[r] = 0
            if abs(a[0, 0]) * others.max() < alpha * biggest * biggest:
                if abs(a[r, r]) < alpha * others.max():
                    order = [0, r, *(i for i in range(1, n) if i != r)]
                    a = a[np.ix_(order, order)]
                    # In units of its off-diagonal entry the pivot's determinant is below alpha^2 - 1 < 0: one
                    # eigenvalue of each sign.
                    unit = a[1, 0]
                    p, q, rest = a[0, 0] / unit, a[1, 1] / unit, a[:2, 2:]
                    inverse = np.array([[q, -1.0], [-1.0, p]]) / (p * q - 1)
                    above += 1
                    a = a[2:, 2:] - rest.T @ (inverse @ (rest / unit))
                    continue
                order = [r, *(i for i in range(n) if i != r)]
                a = a[np.ix_(order, order)]
        above += int(a[0, 0] > 0)
        a = a[1:, 1:] - np.outer(a[1:, 0], a[0, 1:] / a[0, 0])
    return above


def leading_eigenpairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """The k greatest eigenvalues, their unit vectors (columns), and per eigenvalue the certificate: eigenvalues counted
    above just over it (less than its number) and above just under it (its number at least)."""
    n = len(matrix)
    k = min(k, n)
    size = float(np.abs(matrix).sum(axis=1).max())
    if size == 0 or k == 0:
        return np.zeros(k), np.eye(n)[:, :k], [(j, n) for j in range(k)]
    tiny = 8 * n * np.finfo(float).eps * size
    values, vectors, proof = np.zeros(k), np.zeros((n, k)), []
    for j in range(k):
        low, high = -size * 1.01, size * 1.01  # more than j above low, at most j above high
        if j:
            high = min(high, values[j - 1] + tiny)
        n_low, n_high = n, count_above(matrix, high) if j else 0
        # Isolate: a single eigenvalue in (low, high], or a group closer than rounding can part.
        while high - low > tiny and (n_low > j + 1 or n_high < j or high - low > 1e-3 * max(abs(low), abs(high))):
            middle = (low + high) / 2
            c = count_above(matrix, middle)
            if c > j:
                low, n_low = middle, c
            else:
                high, n_high = middle, c
        value, v = _refine(matrix, low, high, vectors[:, :j], tiny, j)
        values[j], vectors[:, j] = value, v
        proof.append((count_above(matrix, value + tiny), count_above(matrix, value - tiny)))
        if not (proof[-1][0] <= j < proof[-1][1]):
            raise ArithmeticError(f"eigenvalue {value} is not number {j + 1}: {proof[-1]} above and from it")
    return values, vectors, proof


def _refine(matrix: np.ndarray, low: float, high: float, found: np.ndarray, tiny: float, number: int) -> tuple[float, np.ndarray]:
    """Inverse iteration at the middle of the interval, then Rayleigh quotient iteration, orthogonal to the vectors found."""
    n = len(matrix)
    eye = np.eye(n)

    def solve(shift: float, x: np.ndarray) -> np.ndarray:
        for step in range(60):  # a shift that hits an eigenvalue exactly is moved by a rounding error
            try:
                y = np.linalg.solve(matrix - (shift + step * tiny / 64) * eye, x)
            except np.linalg.LinAlgError:
                continue
            if np.isfinite(y).all() and y.any():
                return y
        return x

    def clean(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            x = x - found @ (found.T @ x)
        return x / np.linalg.norm(x)

    x = clean(np.random.default_rng(number).standard_normal(n))
    while True:
        for _ in range(8):
            x = clean(solve((low + high) / 2, x))
        for _ in range(12):
            value = float(x @ matrix @ x)
            if not low - tiny <= value <= high + tiny:
                break
            if np.linalg.norm(matrix @ x - value * x) <= tiny / 16:
                return value, x
            x = clean(solve(value, x))
        else:
            value = float(x @ matrix @ x)
            if low - tiny <= value <= high + tiny:
                return value, x
        if high - low <= tiny:
            return float(x @ matrix @ x), x
        middle = (low + high) / 2  # the start was too far off: halve the interval and begin again
        if count_above(matrix, middle) > number:
            low = middle
        else:
            high = middle


# ---- sums over the fit list ---------------------------------------------------------------------

_SUMS = T.StructType([T.StructField("dim", T.IntegerType()), T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType()),
                      T.StructField("high", T.DecimalType(38, 0)), T.StructField("low", T.DecimalType(38, 0))])


def _vectors(batches: Iterator[pa.RecordBatch], column: str, rows: int = 4096) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray, np.ndarray]]:
    """(batch, dimension, row numbers, vectors) of equal length."""
    for whole in batches:
        for at in range(0, whole.num_rows, rows):
            b = whole.slice(at, rows)
            lists = b.column(b.schema.get_field_index(column))
            sizes = np.asarray(lists.value_lengths())
            flat, ends = np.asarray(lists.flatten()), np.cumsum(sizes)
            for dim in np.unique(sizes):
                pick = np.flatnonzero(sizes == dim)
                if len(pick) == len(sizes):
                    yield b, int(dim), pick, flat.reshape(-1, dim)
                else:
                    yield b, int(dim), pick, np.stack([flat[ends[i] - dim:ends[i]] for i in pick])


def _sum_rows(totals: dict[tuple[int, int, int], int]) -> pa.RecordBatch:
    from decimal import Decimal

    keys = list(totals)
    # Two limbs, so that sums of any size stay exact in decimal(38).
    cells = [divmod(totals[k], _LIMB) for k in keys]
    return pa.RecordBatch.from_arrays([pa.array([k[c] for k in keys], pa.int32()) for c in range(3)]
                                      + [pa.array([Decimal(c[p]) for c in cells], pa.decimal128(38, 0)) for p in range(2)], names=_SUMS.names)


def _totals(summed: DataFrame) -> dict[int, dict[tuple[int, int], int]]:
    out: dict[int, dict[tuple[int, int], int]] = {}
    for r in summed.groupBy("dim", "i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect():
        out.setdefault(r["dim"], {})[r["i"], r["j"]] = int(r["high"]) * _LIMB + int(r["low"])
    return out


def _products(y: np.ndarray) -> np.ndarray:
    """y'y as exact integers."""
    top = float(np.abs(y.astype(float)).max(initial=0))
    if top * top * len(y) < _EXACT:
        f = y.astype(float)
        return (f.T @ f).astype(np.int64).astype(object)
    o = y.astype(object)
    return o.T @ o


def fit_spaces(fit: DataFrame, k: int) -> dict[int, dict]:
    """Per vector length: n, sums, eigenvalues, vectors and trace of the covariance of the distinct vectors in ``fit``."""
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int, int], int] = {}
        for _, dim, pick, x in _vectors(batches, "x"):
            safe = float(np.abs(x.astype(float)).max(initial=0)) * len(x) < _LIMB
            for i, s in enumerate((x if safe else x.astype(object)).sum(axis=0).tolist()):
                totals[dim, i, -1] = totals.get((dim, i, -1), 0) + int(s)
            totals[dim, -1, -1] = totals.get((dim, -1, -1), 0) + len(pick)
        yield _sum_rows(totals)

    sums = _totals(fit.mapInArrow(first, _SUMS))
    sizes = {d: t[-1, -1] for d, t in sums.items()}
    means = {d: [Fraction(t[i, -1], sizes[d]) for i in range(d)] for d, t in sums.items()}
    centre = {d: [round(m) for m in ms] for d, ms in means.items()}

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int, int], int] = {}
        held: dict[int, np.ndarray] = {}
        for _, dim, _, x in _vectors(batches, "x"):
            c = np.array(centre[dim], object)
            wide = float(np.abs(x.astype(float)).max(initial=0)) > _LIMB / 2
            got = _products((x.astype(object) - c) if wide else x - c.astype(np.int64))
            held[dim] = held[dim] + got if dim in held else got
        for dim, m in held.items():
            for i in range(dim):
                for j in range(i + 1):
                    totals[dim, i, j] = int(m[i, j])
        yield _sum_rows(totals)

    spaces = {}
    for dim, t in _totals(fit.mapInArrow(second, _SUMS)).items():
        n, rest = sizes[dim], [m - c for m, c in zip(means[dim], centre[dim])]
        cov = np.zeros((dim, dim))
        for i in range(dim):
            for j in range(i + 1):
                cov[i, j] = cov[j, i] = float(Fraction(t[i, j], n) - rest[i] * rest[j])
        values, vectors, proof = leading_eigenpairs(cov, k)
        spaces[dim] = {"n": n, "sums": [sums[dim][i, -1] for i in range(dim)], "centre": centre[dim], "rest": np.array([float(r) for r in rest]),
                       "values": values, "vectors": vectors, "trace": float(sum(Fraction(t[i, i], n) - rest[i] ** 2 for i in range(dim))), "proof": proof}
    return spaces


def _flat(space: dict) -> np.ndarray:
    """Components whose variance is nothing but rounding."""
    return space["values"] <= 64 * len(space["sums"]) * np.finfo(float).eps * max(space["trace"], 0)


def _scores(space: dict, x: np.ndarray) -> np.ndarray:
    """Whitened rows; NaN for components without variance."""
    wide = float(np.abs(x.astype(float)).max(initial=0)) > _LIMB / 2
    y = (x.astype(object) - np.array(space["centre"], object)).astype(float) if wide else (x - np.array(space["centre"], np.int64)).astype(float)
    flat = _flat(space)
    scale = np.where(flat, np.nan, 1 / np.sqrt(np.where(flat, 1, space["values"])))
    return ((y - space["rest"]) @ space["vectors"]) * scale


def _deviations(space: dict, x: np.ndarray) -> list:
    n, sums = space["n"], space["sums"]
    big = max([abs(s) for s in sums] + [n * max(int(x.max()), -int(x.min()))]) if x.size else 0
    if 4 * big * big * x.shape[1] < 1 << 62:
        d = n * x - np.array(sums, np.int64)
        return (d * d).sum(axis=1).tolist()
    out = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in out]


def whiten(vectors: DataFrame, vector: str = "embedding", keep: tuple[str, ...] = ("vec_id",), components: int = 4) -> DataFrame:
    """``keep`` columns, component, n, deviation, whitened, explained and identity_error, one row per vector and component."""
    cells = F.transform(F.col(vector), lambda c: F.floor(F.lit(256.0) * c.cast("double")))
    fine = F.forall(F.col(vector), lambda c: c.isNotNull() & (F.abs(c.cast("double")) < F.lit(float(1 << 55))))
    rows = vectors.where(F.coalesce(fine & (F.size(vector) > 0), F.lit(False))).select(*[F.col(c) for c in keep], cells.cast("array<bigint>").alias("_x"))
    fit = materialise(rows.select(F.col("_x").alias("x")).distinct(), "whitening-fit")
    spaces = fit_spaces(fit, components)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for _, dim, _, x in _vectors(batches, "x"):
            w = np.nan_to_num(_scores(spaces[dim], x))
            w = np.hstack([w, np.ones((len(w), 1))])
            held[dim] = held.get(dim, 0) + w.T @ w
        rows = [(d, i, j, float(m[i, j])) for d, m in held.items() for i in range(len(m)) for j in range(len(m))]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.float64()))],
                                         names=["dim", "i", "j", "total"])

    checked: dict[int, dict] = {}
    for r in fit.mapInArrow(moments, "dim int, i int, j int, total double").groupBy("dim", "i", "j").agg(F.sum("total").alias("total")).collect():
        checked.setdefault(r["dim"], {})[r["i"], r["j"]] = r["total"] / spaces[r["dim"]]["n"]
    for dim, m in checked.items():
        k = min(components, dim)
        live = np.flatnonzero(~_flat(spaces[dim]))
        spaces[dim]["error"] = max((abs(m[i, j] - m[i, k] * m[j, k] - (i == j)) for i in live for j in live), default=0.0)

    schema = T.StructType([*rows.schema.fields[:len(keep)], T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
                           T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
                           T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, dim, pick, x in _vectors(batches, "_x"):
            space = spaces[dim]
            k = min(components, dim)
            w, at = _scores(space, x), pa.array(np.repeat(pick, k))
            part = [None if space["trace"] <= 0 else 0.0 if f else float(e) / space["trace"] for e, f in zip(space["values"], _flat(space))]
            new = [pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(pick))), pa.array([space["n"]] * (len(pick) * k), pa.int64()),
                   pa.array([d for d in _deviations(space, x) for _ in range(k)], pa.int64()), pa.array(w.ravel(), pa.float64(), from_pandas=True),
                   pa.array(part * len(pick), pa.float64()), pa.array([space["error"]] * (len(pick) * k), pa.float64())]
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(at) for c in range(len(keep))), *new], names=schema.names)
    return rows.mapInArrow(run, schema)
