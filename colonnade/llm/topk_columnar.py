"""Operator 9: exact top-k inner products by columnar branch-and-bound.

Vectors are kept by dimension (vertical layout) in blocks, cells in the narrowest integers that hold them.  Products
accumulate one dimension block at a time; a candidate whose partial score plus the product of remaining norms
(Cauchy-Schwarz) cannot reach the query's k-th best score so far leaves, and survivors are compacted.  Partial scores and
bounds are floating with room for their rounding; what survives is scored in integers.

Candidate blocks are dealt to lanes, query blocks to groups; a task takes one lane and one group, holds the group's queries with
their k best and lets the lane's blocks pass.  Query blocks are copied once a lane and candidate blocks once a group, both
through the shuffle: the driver holds no vectors.

Vectors that are null or hold null or non-finite components take no part, nor do rows with another
dimension than the query.  Ties go to the smaller id; repeated ids are separate candidates, except that a row never
meets its own id.  Fewer than k candidates give all.  Empty tables give no rows; only id and vector columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from colonnade.llm.text import materialise, partitions

_BLOCK = "block long, dim int, n int, ids binary, cells binary"
_FOUND = "query_id long, vec_id long, score long"
_BLOCK_CELLS = 1 << 22  # most of a block
_GROUP_CELLS = 1 << 23  # most of the queries that a task holds
_LANE_CELLS = 1 << 26  # most that pass in a task, about
_MOVED = 4  # times the candidates' cells that the shuffle may hold, unless cores would stand idle
_FEW = 1 / 32  # share of pairs from which they are followed one by one
_LOOK = 16  # every so many query blocks all cuts are looked at, else those that paid


def _narrow(cells: np.ndarray) -> np.ndarray:
    for kind in (np.int16, np.int32):
        if not cells.size or np.iinfo(kind).min <= cells.min() and cells.max() <= np.iinfo(kind).max:
            return cells.astype(kind)
    return cells


def _wide(buffer: pa.Buffer, dim: int, n: int) -> np.ndarray:
    """dimension x rows, in the type that was written."""
    width = len(buffer) // (dim * n) if dim * n else 2
    return np.frombuffer(buffer, f"i{width}").reshape(dim, n)


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """(id, v array<double>) -> blocks of equal dimension, integer cells by dimension."""
    schema = pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("cells", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId() << 32, 0
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def most(dim: int) -> int:
            return max(1, min(size, _BLOCK_CELLS // max(1, dim)))

        def out(dim: int, least: int) -> Iterator[pa.RecordBatch]:
            """Blocks of at least so many rows; the others wait."""
            nonlocal made
            ids, cells = (np.concatenate(x) for x in zip(*held.pop(dim)))
            at = 0
            while len(ids) - at >= least:
                i, c = ids[at:at + most(dim)], cells[at:at + most(dim)]
                made, at = made + 1, at + len(i)
                yield pa.RecordBatch.from_pydict({"block": [part + made], "dim": [dim], "n": [len(i)], "ids": [i.tobytes()],
                                                  "cells": [np.ascontiguousarray(_narrow(c).T).tobytes()]}, schema)
            if at < len(ids):
                held[dim] = [(ids[at:], cells[at:])]

        for b in batches:
            lists = b.column(1)
            sizes, flat = np.asarray(lists.value_lengths()), np.asarray(lists.flatten())
            ids, ends = np.asarray(b.column(0)), np.cumsum(sizes)
            for dim in np.unique(sizes).tolist():
                pick = np.flatnonzero(sizes == dim)
                v = flat[(ends[pick] - dim)[:, None] + np.arange(dim)]
                held.setdefault(dim, []).append((ids[pick], np.floor(256.0 * v).astype(np.int64)))
                if sum(len(i) for i, _ in held[dim]) >= most(dim):
                    yield from out(dim, most(dim))
        for dim in list(held):
            yield from out(dim, 1)
    return rows.mapInArrow(run, _BLOCK)


def _rest(m: np.ndarray, cuts: list[int]) -> np.ndarray:
    """Norms of what follows each cut (dimension x rows -> cuts x rows); the first is the whole norm."""
    out = np.zeros((len(cuts), m.shape[1]))
    for c in range(len(cuts) - 2, -1, -1):
        out[c] = out[c + 1] + (m[cuts[c]:cuts[c + 1]].astype(float) ** 2).sum(axis=0)
    return np.sqrt(out)


def _pairs(keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.divmod(np.flatnonzero(keep), max(1, keep.shape[1]))


def _plus(part: np.ndarray | None, more: np.ndarray) -> np.ndarray:
    return more if part is None else np.add(part, more, out=part)


class Search:
    """Queries of one dimension with their k best so far; candidate blocks pass one after another."""

    def __init__(self, ids: np.ndarray, cells: np.ndarray, k: int, width: int, step: int):
        """``cells``: dimension x queries."""
        self.ids, self.k, self.width = ids, k, width
        dim = len(cells)
        self.cuts = [*range(0, dim, step), dim]
        self.rest = _rest(cells, self.cuts)
        self.cells = np.ascontiguousarray(cells.T)
        self.near: dict[type, np.ndarray] = {}
        n = len(ids)
        self.found = np.zeros(n, np.int64)
        self.scores, self.owners = np.zeros((n, k), np.int64), np.zeros((n, k), np.int64)
        self.pays, self.visits = dict.fromkeys(self.cuts, True), 0

    def meet(self, ids: np.ndarray, cells: np.ndarray) -> None:
        """A block of candidates, cells dimension x rows."""
        rest = _rest(cells, self.cuts)
        most = rest[0].max(initial=0.0)
        kind = np.float32 if self.rest[0].max(initial=0.0) * most < 2.0**100 else np.float64
        if kind not in self.near:
            self.near = {kind: self.cells.astype(kind)}
        c, room = cells.astype(kind), (self.cells.shape[1] + 8) * 4 * float(np.finfo(kind).eps) * most
        seed, across = max(256, 8 * self.k), np.ascontiguousarray(cells.T)
        for lo in range(0, len(self.ids), self.width):
            rows, at, to = slice(lo, lo + self.width), 0, len(ids)
            if (self.found[rows] < self.k).any():  # nothing to hold against yet: the first columns give a bound, the next a better one
                self._seed(rows, ids[:seed], across[:seed], c[:, :seed], room)
                at, to = seed, 4 * seed
            while at < len(ids):
                self._sift(rows, ids[at:to], across[at:to], c[:, at:to], rest[:, at:to], room)
                at, to = to, max(4 * to, len(ids))

    def _seed(self, rows: slice, ids: np.ndarray, across: np.ndarray, c: np.ndarray, room: float) -> None:
        part = next(iter(self.near.values()))[rows] @ c
        part[self.ids[rows, None] == ids] = -np.inf
        keep = part > -np.inf
        if len(ids) > self.k:
            kth = np.partition(part, len(ids) - self.k, axis=1)[:, len(ids) - self.k]
            keep &= part >= (kth - 2 * self.rest[0][rows] * room)[:, None]
        self._settle(rows.start, *_pairs(keep), ids, across)

    def _floor(self, rows: slice, room: float) -> np.ndarray:
        """What a floating score must reach; a score that equals the k-th best may have a smaller id."""
        return np.where(self.found[rows] < self.k, -np.inf, self.scores[rows, -1] - self.rest[0][rows] * room)

    def _sift(self, rows: slice, ids: np.ndarray, across: np.ndarray, c: np.ndarray, rest: np.ndarray, room: float) -> None:
        q = next(iter(self.near.values()))[rows]
        kind, look = q.dtype, self.visits % _LOOK == 0
        self.visits += 1
        floor_ = self._floor(rows, room).astype(kind)
        mine, others = ((x * (1 + 2.0**-18)).astype(kind) for x in (self.rest[:, rows], rest))
        alive = np.arange(len(ids))
        part, done, dim = None, 0, self.cuts[-1]
        for n, cut in enumerate(self.cuts):
            if cut == dim or not cut or not (look or self.pays[cut]):
                continue
            part, done = _plus(part, q[:, done:cut] @ c[done:cut]), cut
            if look:  # a few candidates tell whether the bound dismisses enough here
                some = slice(None, None, max(1, len(alive) // 128))
                hit = part[:, some] + mine[n][:, None] * others[n][some] >= floor_[:, None]
                self.pays[cut] = bool(hit.mean() <= _FEW or hit.any(axis=0).mean() <= 0.5)
            if not self.pays[cut]:
                continue
            keep = np.multiply.outer(mine[n], others[n])
            keep += part
            keep = keep >= floor_[:, None]
            if np.count_nonzero(keep) <= _FEW * keep.size:
                i, j = _pairs(keep)
                i, j = self._follow(i, j, part[i, j], n, q, c, mine, others, floor_)
                return self._settle(rows.start, i, alive[j], ids, across)
            needed = keep.any(axis=0)
            if np.count_nonzero(needed) <= 0.5 * len(needed):
                alive, part, c, others = alive[needed], part[:, needed], c[:, needed], others[:, needed]
        part = _plus(part, q[:, done:] @ c[done:])
        i, j = _pairs(part >= floor_[:, None])
        self._settle(rows.start, i, alive[j], ids, across)

    def _follow(self, i, j, score, n: int, q, c, mine, others, floor_) -> tuple[np.ndarray, np.ndarray]:
        """The pairs (i, j) whose score stays within reach over the dimension blocks from cut ``n`` on."""
        for n in range(n, len(self.cuts) - 1):
            s, e = self.cuts[n], self.cuts[n + 1]
            a, b = np.ascontiguousarray(q[:, s:e]), np.ascontiguousarray(c[s:e].T)
            score = score + np.einsum("ij,ij->i", a[i], b[j])
            keep = score + mine[n + 1][i] * others[n + 1][j] >= floor_[i]
            i, j, score = i[keep], j[keep], score[keep]
        return i, j

    def _settle(self, start: int, i: np.ndarray, j: np.ndarray, ids: np.ndarray, across: np.ndarray) -> None:
        """Exact scores of the pairs, merged into the k best; ``i`` counts from ``start``, ``across`` is rows x dimension."""
        i = i + start
        other = self.ids[i] != ids[j]
        i, j = i[other], j[other]
        some = max(1, (1 << 21) // max(1, across.shape[1]))
        for lo in range(0, len(i), some):
            a, b = i[lo:lo + some], j[lo:lo + some]
            score = np.einsum("ij,ij->i", self.cells[a].astype(np.int64), across[b].astype(np.int64))
            self._merge(a, score, ids[b])

    def _merge(self, i: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        k = self.k
        low, owner = self.scores[i, -1], self.owners[i, -1]
        better = (self.found[i] < k) | (score > low) | (score == low) & (ids < owner)
        i, score, ids = i[better], score[better], ids[better]
        if not len(i):
            return
        rows = np.unique(i)
        who = np.concatenate([i, np.repeat(rows, k)])
        score = np.concatenate([score, self.scores[rows].ravel()])
        ids = np.concatenate([ids, self.owners[rows].ravel()])
        none = np.concatenate([np.zeros(len(i), bool), (np.arange(k) >= self.found[rows][:, None]).ravel()])
        order = np.lexsort((ids, ~score, none, who))  # ~score falls as the score rises, at the ends of a long too
        first = np.searchsorted(who[order], rows)
        best = order[first[:, None] + np.arange(k)]
        self.scores[rows], self.owners[rows], self.found[rows] = score[best], ids[best], (~none[best]).sum(axis=1)

    def rows(self, most: int = 1 << 16) -> Iterator[pa.RecordBatch]:
        i, r = np.nonzero(np.arange(self.k) < self.found[:, None])
        for lo in range(0, len(i), most):
            a, b = i[lo:lo + most], r[lo:lo + most]
            yield pa.RecordBatch.from_pydict({"query_id": self.ids[a], "vec_id": self.owners[a, b], "score": self.scores[a, b]})


def _dealt(block: Column, n: int) -> Column:
    """One of n by turns within a task's blocks, from another one each task."""
    task, made = F.shiftright(block, 32), block.bitwiseAND(F.lit((1 << 32) - 1))
    return F.pmod(F.floor((task * F.lit(0.6180339887498949)) % 1 * n) + made, F.lit(n)).cast("int")


def _grid(c: DataFrame, q: DataFrame, k: int, tasks: int, cores: int) -> tuple[int, int]:
    """Lanes of candidates and groups of queries: up to about ``tasks`` pairs that move the fewest cells and answers."""
    totals = [F.count("*"), F.sum("n"), F.sum(F.col("n").cast("long") * F.col("dim"))]
    (c_blocks, _, c_cells), (q_blocks, q_rows, q_cells) = ([x or 0 for x in d.agg(*totals).first()] for d in (c, q))
    copied = q_cells + 12 * k * q_rows  # an answer takes as much as twelve cells
    # t tasks move 2 * sqrt(t * copied / c_cells) times the candidates at best
    tasks = min(tasks, max(3 * cores, (_MOVED ** 2 * c_cells) // (4 * max(1, copied))))
    held = -(-copied // _GROUP_CELLS)
    groups = max(1, min(max(held, min(tasks, round((tasks * copied / max(1, c_cells)) ** 0.5))), q_blocks))
    lanes = max(1, min(max(-(-tasks // groups), -(-c_cells // _LANE_CELLS)), c_blocks))
    return lanes, groups


def exact_topk(vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 5,
               query_block: int = 256, candidate_block: int = 4096, step: int = 16) -> DataFrame:
    """query_id, rank, vec_id, score: each query row's k highest scores over all other rows."""

    def clean(df: DataFrame) -> DataFrame:
        d = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
        bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        return d.where(F.col("id").isNotNull() & F.col("v").isNotNull() & ~F.coalesce(bad, F.lit(True)))

    spark = vectors.sparkSession
    cand = materialise(_blocks(clean(vectors), candidate_block), "topk-candidates")
    q = materialise(_blocks(clean(queries), query_block), "topk-queries")
    lanes, groups = _grid(cand, q, k, partitions(spark, 1, 1), spark.sparkContext.defaultParallelism)

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    # Every group of queries meets every lane of candidates in a task of their own, queries first.
    sent = [d.select((F.col("lane") * groups + F.col("group")).alias("cell"), F.lit(later).alias("later"), "dim", "n", "ids", "cells")
            for later, d in ((False, q.withColumn("group", _dealt(F.col("block"), groups)).withColumn("lane", each(lanes))),
                             (True, cand.withColumn("lane", _dealt(F.col("block"), lanes)).withColumn("group", each(groups))))]
    met = sent[0].union(sent[1]).repartitionById(lanes * groups, F.col("cell")).sortWithinPartitions("cell", "later")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, waiting, open_ = None, {}, {}

        def ended() -> Iterator[pa.RecordBatch]:
            for s in open_.values():
                yield from s.rows()
            waiting.clear()
            open_.clear()

        for b in batches:
            for r in range(b.num_rows):
                at, later, dim, n = (b.column(c)[r].as_py() for c in range(4))
                if at != cell:
                    yield from ended()
                    cell = at
                ids = np.frombuffer(b.column(4)[r].as_buffer(), np.int64)
                cells = _wide(b.column(5)[r].as_buffer(), dim, n)
                if not later:
                    waiting.setdefault(dim, []).append((ids.copy(), cells.copy()))
                    continue
                if dim in waiting:
                    held = waiting.pop(dim)
                    open_[dim] = Search(np.concatenate([i for i, _ in held]), np.concatenate([c for _, c in held], axis=1), k, query_block, step)
                if dim in open_:
                    open_[dim].meet(ids, cells)
        yield from ended()

    best = met.mapInArrow(run, _FOUND)
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int"), "vec_id", "score")
