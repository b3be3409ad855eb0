"""Operator 9: nothing is sent through the driver, and any cut into blocks, lanes and groups gives the same k best."""

import numpy as np
import pytest

from colonnade.llm import topk_columnar as topk

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, queries, k):
    """By query id, as rows of one id share their ranks."""
    def cells(v):
        return None if v is None or any(x is None or not np.isfinite(x) for x in v) else [int(np.floor(256 * x)) for x in v]

    rows, queries = ([(i, c) for i, v in t if i is not None and (c := cells(v)) is not None] for t in (rows, queries))
    found = {}
    for q, a in queries:
        near = [(-sum(x * y for x, y in zip(a, b)), c) for c, b in rows if c != q and len(a) == len(b)]
        found.setdefault(q, []).extend(sorted(near)[:k])
    return sorted((q, n + 1, c, -s) for q, x in found.items() for n, (s, c) in enumerate(sorted(x)[:k]))


def table():
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((90, 21)))]
    rows += [(100 + i, v.tolist()) for i, v in enumerate(rng.integers(-1, 2, (60, 3)).astype(float))]  # many ties
    rows += [(7, rows[8][1]), (7, rows[7][1]), (8, rows[7][1]), (103, rows[93][1])]  # repeated ids, other and equal vectors
    rows += [(200, []), (201, []), (202, [1e4] * 21), (203, [-3e6] * 3), (204, [0.5] * 5)]
    return rows + [(None, [1.0] * 3), (205, None), (206, [None, 1.0, 2.0]), (207, [float("inf"), 1.0, 2.0])]


def test_driver_holds_no_vectors(spark):
    v = spark.createDataFrame(table(), SCHEMA)
    plan = topk.exact_topk(v, v.where("vec_id % 3 = 0"))._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "MapInArrow" in plan


@pytest.mark.parametrize("group_cells, k, blocks", [(1 << 23, 5, (256, 4096, 16)), (64, 3, (3, 7, 4)), (1, 200, (2, 1, 5))])
def test_any_cut_gives_the_same(spark, monkeypatch, group_cells, k, blocks):
    monkeypatch.setattr(topk, "_GROUP_CELLS", group_cells)
    rows = table()
    queries = [r for r in rows if r[0] is None or r[0] % 3 == 0 or r[0] == 7]
    v, q = (spark.createDataFrame(t, SCHEMA).repartition(3) for t in (rows, queries))
    got = topk.exact_topk(v, q, k=k, query_block=blocks[0], candidate_block=blocks[1], step=blocks[2])
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, queries, k)
    assert topk.exact_topk(v, q.limit(0)).count() == topk.exact_topk(v.limit(0), q).count() == 0


@pytest.mark.parametrize("fall", [1.0, 0.9])
def test_bounds_keep_the_best(fall):
    """Blocks one after another, cut by the bounds: ``fall`` makes the first dimensions the heavy ones, so that most leave early."""
    rng = np.random.default_rng(5)
    c, q = (np.floor(rng.standard_normal((64, n)) * 100 * fall ** np.arange(64)[:, None]).astype(np.int64) for n in (3000, 40))
    s = topk.Search(np.arange(40), q, 4, 16, 8)
    for at in range(0, 3000, 700):
        s.meet(np.arange(at, min(at + 700, 3000)), c[:, at:at + 700])
    for i in range(40):
        score = c.T @ q[:, i]
        want = sorted((-int(score[j]), j) for j in range(3000) if j != i)[:4]
        assert [(-int(x), int(j)) for x, j in zip(s.scores[i], s.owners[i])] == want
    assert fall == 1.0 or s.pays[8] or s.pays[16]
