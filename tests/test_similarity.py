"""Best-correlated partner (C3) against an all-pairs numpy brute force."""

import random

import numpy as np
import pytest

from colonnade.operators.similarity import best_correlated_partner, keyed_correlation


def _brute(series):
    keys = sorted(series)
    out = {}
    for i, a in enumerate(keys):
        best = None
        for b in keys[i + 1:]:
            r = float(np.corrcoef(series[a], series[b])[0, 1])
            cand = (round(r, 9), -b, r)
            if best is None or cand > best:
                best = cand
        if best is not None:
            out[a] = (-best[1], best[2])
    return out


@pytest.mark.parametrize("n_entities,seed", [(12, 1), (300, 2)])
def test_best_partner_matches_brute_force(spark, n_entities, seed):
    rnd = random.Random(seed)
    years = [2016, 2017, 2018, 2019, 2020]
    rows, series = [], {}
    for k in range(n_entities):
        vals = [rnd.randint(0, 12) for _ in years]
        if k % 17 == 3:
            vals = [4] * 5  # constant series: dropped (D21)
        if k % 23 == 5:
            vals = vals[:4]  # missing a year: dropped (F9)
        for y, v in zip(years, vals):
            rows.append((k, y, v))
        if len(vals) == 5 and len(set(vals)) > 1:
            series[k] = vals
    df = spark.createDataFrame(rows, "beat long, year int, n long")
    got = {r.beat: (r.partner, r.corr) for r in best_correlated_partner(df, "beat", "year", "n", years).collect()}
    expected = _brute(series)
    assert set(got) == set(expected)
    for k, (p, r) in expected.items():
        assert got[k][0] == p, k
        assert got[k][1] == pytest.approx(r, abs=1e-9)


def test_identical_shapes_tie_to_smaller_partner(spark):
    years = [1, 2, 3]
    rows = [(1, y, v) for y, v in zip(years, [1, 2, 3])] + [(5, y, v) for y, v in zip(years, [2, 4, 6])] \
        + [(3, y, v) for y, v in zip(years, [10, 20, 30])]
    df = spark.createDataFrame(rows, "k long, y int, n long")
    got = {r.k: r.partner for r in best_correlated_partner(df, "k", "y", "n", years).collect()}
    assert got == {1: 3, 3: 5}


def test_keyed_correlation(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 4.1), ("a", 3.0, 6.3)], "k string, x double, y double")
    got = keyed_correlation(df, ["k"], "x", "y").first()["corr"]
    assert got == pytest.approx(float(np.corrcoef([1, 2, 3], [2, 4.1, 6.3])[0, 1]))


@pytest.mark.parametrize("seed", [4, 5])
def test_best_partner_with_copies_and_near_copies(spark, seed):
    # One series copied under many interleaved keys, a proportional near copy
    # (r = 1 exactly, different vector bits possible), and random others.
    rnd = random.Random(seed)
    years = [1, 2, 3, 4, 5]
    base = [3, 9, 4, 7, 5]
    rows, series = [], {}
    keys = list(range(400))
    rnd.shuffle(keys)
    for i, k in enumerate(keys):
        if i < 120:
            vals = base
        elif i < 140:
            vals = [2 * v + 1 for v in base]  # same correlation shape
        elif i < 150:
            vals = [5, 1, 5, 1, 5]
        elif i < 165:
            vals = [v * 100000 for v in base[:-1]] + [base[-1] * 100000 + 1]  # near copy, r rounds to 1
        elif i < 170:
            vals = [v * 100000 for v in base[:-1]] + [base[-1] * 100000 + 2]
        else:
            vals = [rnd.randint(0, 12) for _ in years]
        if len(set(vals)) == 1:
            continue
        series[k] = vals
        rows += [(k, y, v) for y, v in zip(years, vals)]
    df = spark.createDataFrame(rows, "beat long, year int, n long")
    got = {r.beat: (r.partner, r.corr) for r in best_correlated_partner(df, "beat", "year", "n", years).collect()}
    expected = _brute(series)
    assert set(got) == set(expected)
    for k, (p, r) in expected.items():
        assert got[k][0] == p, (k, got[k], p, r)
        assert got[k][1] == pytest.approx(r, abs=1e-9)


def test_dense_cluster_of_distinct_near_copies(spark, monkeypatch):
    # 120 distinct series whose normalised vectors lie in one tiny cluster
    # (r close to 1 but mostly not rounding to 1), plus scattered others: the
    # crowded queries start on finer grids; the answer must equal brute force.
    from colonnade.operators import similarity as sim
    monkeypatch.setattr(sim, "DENSE_CELL", 8)
    rnd = random.Random(21)
    years = [1, 2, 3, 4, 5]
    base = [3000, 9000, 4000, 7000, 5000]
    rows, series = [], {}
    keys = list(range(200))
    rnd.shuffle(keys)
    for i, k in enumerate(keys):
        if i < 120:
            vals = [v + rnd.randint(-40, 40) for v in base]
        else:
            vals = [rnd.randint(0, 12) for _ in years]
        if len(set(vals)) == 1:
            continue
        series[k] = vals
        rows += [(k, y, v) for y, v in zip(years, vals)]
    df = spark.createDataFrame(rows, "beat long, year int, n long")
    got = {r.beat: (r.partner, r.corr) for r in best_correlated_partner(df, "beat", "year", "n", years).collect()}
    expected = _brute(series)
    assert set(got) == set(expected)
    for k, (p, r) in expected.items():
        assert got[k][0] == p, (k, got[k], p, r)
        assert got[k][1] == pytest.approx(r, abs=1e-9)


def _check(spark, series, years):
    rows = [(k, y, v) for k, vals in series.items() for y, v in zip(years, vals)]
    kind = "string" if isinstance(next(iter(series)), str) else "long"
    df = spark.createDataFrame(rows, f"beat {kind}, year int, n long")
    got = {r.beat: (r.partner, r.corr) for r in best_correlated_partner(df, "beat", "year", "n", years).collect()}
    keys = sorted(series)
    z = np.array([series[k] for k in keys], float)
    z -= z.mean(axis=1, keepdims=True)
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    r = z @ z.T
    assert set(got) == set(keys[:-1])
    for i, a in enumerate(keys[:-1]):
        rr = np.round(r[i, i + 1:], 9)
        j = int(np.flatnonzero(rr == rr.max())[0]) + i + 1
        assert got[a][0] == keys[j], (a, got[a], keys[j], r[i, j])
        assert got[a][1] == pytest.approx(r[i, j], abs=1e-9)


@pytest.mark.parametrize("dense", [1, 8, 64, 10_000])
def test_ties_do_not_depend_on_the_starting_grid(spark, monkeypatch, dense):
    # Small counts: many partners tie exactly at the best correlation, at very different distances from cell borders.
    from colonnade.operators import similarity as sim
    monkeypatch.setattr(sim, "DENSE_CELL", dense)
    rnd = random.Random(dense)
    series = {}
    while len(series) < 160:
        vals = [rnd.randint(0, 2) for _ in range(5)]
        if len(set(vals)) > 1:
            series[len(series)] = vals
    # equal up to the tenth digit: ties at nine digits between vectors that differ
    for i in range(25):
        series[1000 + i] = [10**6 + i, 3 * 10**6, 2 * 10**6 + 2 * i, 10**6, 5 * 10**6]
    _check(spark, series, [1, 2, 3, 4, 5])


@pytest.mark.parametrize("n_years", [2, 3, 8])
def test_string_keys_and_other_lengths(spark, n_years):
    rnd = random.Random(n_years)
    series = {}
    while len(series) < 90:
        vals = [rnd.randint(0, 6) for _ in range(n_years)]
        if len(set(vals)) > 1:
            series[f"e{len(series) * 7919 % 1000:04d}x"] = vals
    _check(spark, series, list(range(n_years)))


def test_a_third_of_all_entities_on_one_series(spark):
    rnd = random.Random(8)
    series = {k: [3, 9, 4, 7, 5] if k % 3 == 0 else [rnd.randint(0, 30) for _ in range(5)] for k in range(900)}
    _check(spark, {k: v for k, v in series.items() if len(set(v)) > 1}, [1, 2, 3, 4, 5])
