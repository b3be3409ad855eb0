"""Operator 11: runs (maximal periodic stretches of words) by scale-tiled distribution.

Periods are dealt into octaves [2^k, 2^(k+1)).  A document is exploded into overlapping tiles per octave, as wide as the
octave needs; octaves whose tiles are no wider than ``tile`` words share them, so a short document is one tile.  A tile is
solved alone: boundaries stand every 2^k words, and the Z-values of each boundary m, that is how far the words from m + p
equal those from m, are found for all periods p of the octave together, over names of blocks of 2^j words.  Every run has a
boundary whose Z-value is at least 2^(k+1) words; from such pairs the equal stretch is followed to both sides as far as the
tile reaches.  That gives fragments (period, interval of positions i where word i equals word i + p).  Fragments are
shuffled by document and period and stitched where they overlap, as neighbouring tiles do; the whole intervals give the
runs, of which each stretch keeps its smallest period.

Block names are 64-bit hashes, so each interval is compared word by word before it leaves.  Texts too short for more
than one tile (by bytes) are solved where they are read, as nothing is to be stitched; tiles of the others are spread over all
tasks.  Their documents are told apart by a digest of the words and the input partition, so exact copies in a partition are
solved once, and no group is larger than a partition.  One document's words and runs must fit a task; nothing else grows
with the input.

Null text has no words.  Documents of any length are whole.  Rows with null or repeated ids give one row each.  Only
``keep`` columns come along, so others can't clash.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colonnade.llm.text import byte_words, partitions
from colonnade.session import scratch_path

EXPONENT, SHORTEST = 4, 6


def block_names(words: np.ndarray, longest: int) -> list[np.ndarray]:
    """names[j][i]: hash of the 2^j words from i, while 2^j <= longest."""
    mixed = words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    names = [mixed ^ (mixed >> np.uint64(29))]
    while 2 << (len(names) - 1) <= longest:
        last, half = names[-1], 1 << (len(names) - 1)
        if len(last) <= half:
            break
        both = (last[:-half] * np.uint64(0xBF58476D1CE4E5B9) + last[half:]) ^ np.uint64(len(names))
        both = (both ^ (both >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        names.append(both ^ (both >> np.uint64(30)))
    return names


def _follow(names: list[np.ndarray], i: np.ndarray, j: np.ndarray, forward: bool) -> np.ndarray:
    """How many words from i (or before i) equal those from (before) j > i, to the end of the tile."""
    n = len(names[0])
    i, j = i.copy(), j.copy()
    first = i.copy()
    top = len(names) - 1
    # The largest block as often as it fits, then each smaller one once.
    for level in [top, *range(top, -1, -1)]:
        size, name = 1 << level, names[level]
        live = np.arange(len(i))
        while len(live):
            a, b = (i[live], j[live]) if forward else (i[live] - size, j[live] - size)
            fits = (b + size <= n) if forward else (a >= 0)
            live, a, b = live[fits], a[fits], b[fits]
            same = name[a] == name[b]
            live = live[same]
            i[live] += size if forward else -size
            j[live] += size if forward else -size
            if level != top:
                break
    return np.abs(i - first)


def tile_fragments(words: np.ndarray, octaves: range, core: tuple[int, int], longest: int) -> np.ndarray:
    """Rows (period, low, high) for boundaries in ``core``: words[low:high] equals words[low + period:high + period], as far
    as the tile goes.  ``longest``: no stretch with one word repeated is longer than this many words."""
    n = len(words)
    names = block_names(words, max(1, min(longest, n)))
    out = [np.empty((0, 3), np.int64)]
    for k in octaves:
        size = 1 << k
        level = min(k + 1, len(names) - 1)
        need = 1 << level
        marks = np.arange(core[0], min(core[1], n), size)
        if not len(marks):
            continue
        for first in range(size, 2 * size, max(1, (1 << 20) // len(marks))):
            periods = np.arange(first, min(2 * size, first + max(1, (1 << 20) // len(marks))))
            at = marks[:, None]
            fits = at + periods[None, :] + need <= n
            to = np.where(fits, at + periods[None, :], at)
            hit = fits & (names[level][np.minimum(at, len(names[level]) - 1)] == names[level][np.minimum(to, len(names[level]) - 1)])
            # The marks of one interval hit in a row: the first stands for all.
            hit[1:] &= ~hit[:-1].copy()
            r, c = np.nonzero(hit)
            if not len(r):
                continue
            m, p = marks[r], periods[c]
            high = m + _follow(names, m, m + p, True)
            low = m - _follow(names, m, m + p, False)
            out.append(np.stack([p, low, high], axis=1))
    found = np.concatenate(out)
    return _checked(words, _primitive(names, found))


def _checked(words: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Intervals compared by words; a hash collision cuts one into the intervals that really are equal."""
    good = []
    for p, low, high in found:
        same = words[low:high] == words[low + p:high + p]
        if same.all():
            good.append((p, low, high))
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[0], same.astype(np.int8), [0]])))
        good.extend((p, low + a, low + b) for a, b in edge.reshape(-1, 2))
    return np.array(good, np.int64).reshape(-1, 3)


def _primitive(names: list[np.ndarray], found: np.ndarray) -> np.ndarray:
    """Drop stretches that repeat a shorter piece: their smaller period, a divisor, has the same stretch (by block names alone:
    a word of repeats has as many periods as a half of its length, too many to compare each)."""
    if not len(found):
        return found
    p, low, high = found.T
    factor = np.arange(p.max() + 1)  # smallest prime factor
    for d in range(2, int(p.max() ** 0.5) + 1):
        if factor[d] == d:
            multiples = factor[d * d::d]
            multiples[multiples == np.arange(d * d, p.max() + 1, d)] = d
    keep, left, live = np.ones(len(found), bool), p.copy(), np.flatnonzero(p > 1)
    while len(live):
        d = factor[left[live]]
        part = p[live] // d
        reach = _follow(names, low[live], low[live] + part, True)
        repeats = reach >= high[live] + p[live] - low[live] - part
        keep[live[repeats]] = False
        left[live] //= d
        live = live[~repeats & (left[live] > 1)]
    return found[keep]


def _tiles(n: int, tile: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(first octave, end octave, core start, core end, text start, text end) of a document of n words."""
    top = max((n // EXPONENT).bit_length(), 1)
    if n <= tile:
        yield 0, top, 0, n, 0, n
        return
    shared = max(1, (tile // 16).bit_length() - 1)
    for first, end in [(0, min(shared + 1, top)), *((k, k + 1) for k in range(shared + 1, top))]:
        size = 1 << (end - 1)
        core = max(tile, 8 * size)
        for at in range(0, n, core):
            yield first, end, at, min(n, at + core), max(0, at - size), min(n, at + core + 4 * size)


def _long_enough(found: np.ndarray, n: int, start: int, whole: int) -> np.ndarray:
    """Without intervals that end inside the tile on both sides and are too short for a run."""
    p, low, high = found.T
    inside = ((low > 0) | (start == 0)) & ((high + p < n) | (start + n == whole))
    return found[~inside | (high - low + p >= np.maximum(SHORTEST, EXPONENT * p))]


def _numbers(words: list[bytes]) -> np.ndarray:
    number: dict[bytes, int] = {}
    return np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))


def _runs_of(texts: list[np.ndarray]) -> list[list[dict]]:
    """Sorted runs of each of several one-tile documents, solved as one array with a number of its own after each."""
    out: list[list[dict]] = [[] for _ in texts]
    longest = max(map(len, texts), default=0)
    if longest < SHORTEST:
        return out
    flat = np.concatenate([x for i, w in enumerate(texts) for x in (w, np.array([-1 - i], np.int64))])
    begins = np.cumsum([0, *(len(w) + 1 for w in texts)])
    got = tile_fragments(flat, range(max((longest // EXPONENT).bit_length(), 1)), (0, len(flat)), longest)
    best: dict[tuple[int, int, int], int] = {}
    for p, low, high in got.tolist():
        if high - low + p >= max(SHORTEST, EXPONENT * p):
            d = int(np.searchsorted(begins, low, side="right")) - 1
            key = (d, low - int(begins[d]), high - low + p)
            best[key] = min(p, best.get(key, p))
    for (d, start, length), p in sorted(best.items()):
        out[d].append({"start": start, "length": length, "period": p})
    for found in out:
        found.sort(key=lambda r: (r["start"], r["period"]))
    return out


def _collapse(words: list[bytes], runs: list[dict]) -> str:
    if runs:
        stay = np.ones(len(words), bool)
        for r in runs:
            stay[r["start"] + r["period"]:r["start"] + r["length"]] = False
        words = [words[i] for i in np.flatnonzero(stay)]
    return b" ".join(words).decode("utf-8", "surrogatepass")


_RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))
_ARROW_RUNS = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))


def _out_schema(rows: DataFrame, n_keep: int) -> T.StructType:
    return T.StructType([*rows.schema.fields[:n_keep], T.StructField("n_words", T.LongType()), T.StructField("runs", _RUNS), T.StructField("collapsed", T.StringType())])


def _solve_short(rows: DataFrame, n_keep: int, room: int) -> DataFrame:
    schema = _out_schema(rows, n_keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            start, size, held = 0, 0, []
            for i in range(b.num_rows):
                words = byte_words(b.column(n_keep)[i].as_py())
                held.append(words)
                size += len(words)
                if size >= room or i == b.num_rows - 1:
                    found = _runs_of([_numbers(w) for w in held])
                    new = [pa.array([len(w) for w in held], pa.int64()), pa.array(found, _ARROW_RUNS),
                           pa.array([_collapse(w, f) for w, f in zip(held, found)], pa.string())]
                    yield pa.RecordBatch.from_arrays([*(b.column(c).slice(start, len(held)) for c in range(n_keep)), *new], names=schema.names)
                    start, size, held = i + 1, 0, []
    return rows.mapInArrow(run, schema)


_TILE = [("first", T.IntegerType(), pa.int32()), ("end", T.IntegerType(), pa.int32()), ("core", T.LongType(), pa.int64()),
         ("core_end", T.LongType(), pa.int64()), ("start", T.LongType(), pa.int64()), ("stop", T.LongType(), pa.int64()),
         ("whole", T.LongType(), pa.int64()), ("ids", T.BinaryType(), pa.binary())]


def _explode(rows: DataFrame, n_keep: int, tile: int) -> DataFrame:
    """Each long document (keep columns, body, key) and its tiles (key, tile columns)."""
    schema = T.StructType([*rows.schema.fields[:n_keep], T.StructField("body", T.StringType()), T.StructField("key", T.BinaryType()),
                           *(T.StructField(c, t) for c, t, _ in _TILE)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId().to_bytes(4, "big")
        sent: set[bytes] = set()
        for b in batches:
            none = [pa.nulls(1, b.schema.field(c).type) for c in range(n_keep)]
            for i in range(b.num_rows):
                words = byte_words(b.column(n_keep)[i].as_py())
                body = b" ".join(words)
                key = hashlib.sha256(body).digest() + part
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(i, 1) for c in range(n_keep)), pa.array([body.decode("utf-8", "surrogatepass")], pa.string()),
                                                  pa.array([key], pa.binary()), *(pa.nulls(1, t) for _, _, t in _TILE)], names=schema.names)
                if key in sent:
                    continue
                sent.add(key)
                ids = _numbers(words)
                packed = ids.astype(np.uint16 if ids.max(initial=0) < 1 << 16 else np.uint32)
                for first, end, core, core_end, start, stop in _tiles(len(ids), tile):
                    cells = (first, end, core, core_end, start, stop, len(ids), packed[start:stop].tobytes())
                    yield pa.RecordBatch.from_arrays([*none, pa.nulls(1, pa.string()), pa.array([key], pa.binary()),
                                                      *(pa.array([v], t) for v, (_, _, t) in zip(cells, _TILE))], names=schema.names)
    return rows.mapInArrow(run, schema)


_FRAGMENT = T.StructType([T.StructField("key", T.BinaryType()), *(T.StructField(c, T.LongType()) for c in ("period", "low", "high"))])


def _solve_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for r in b.to_pylist():
            n = r["stop"] - r["start"]
            ids = np.frombuffer(r["ids"], np.uint16 if len(r["ids"]) == 2 * n else np.uint32).astype(np.int64)
            got = tile_fragments(ids, range(r["first"], r["end"]), (r["core"] - r["start"], r["core_end"] - r["start"]), n)
            got = _long_enough(got, n, r["start"], r["whole"])
            yield pa.RecordBatch.from_arrays([pa.array([r["key"]] * len(got), pa.binary()), pa.array(got[:, 0]), pa.array(got[:, 1] + r["start"]),
                                              pa.array(got[:, 2] + r["start"])], names=_FRAGMENT.names)


def stitch(fragments: DataFrame) -> DataFrame:
    """key, start, length, period of the runs that the fragments (key, period, low, high) make."""
    by = Window.partitionBy("key", "period").orderBy("low", "high")
    ended = F.max("high").over(by.rowsBetween(Window.unboundedPreceding, -1))
    # An interval that begins after all earlier ones have ended begins a new stretch.
    marked = fragments.distinct().withColumn("fresh", F.when(F.col("low") > F.coalesce(ended, F.lit(-1)), 1).otherwise(0))
    grouped = marked.withColumn("stretch", F.sum("fresh").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    whole = grouped.groupBy("key", "period", "stretch").agg(F.min("low").alias("start"), F.max("high").alias("high"))
    runs = whole.select("key", "start", (F.col("high") - F.col("start") + F.col("period")).alias("length"), "period")
    runs = runs.where(F.col("length") >= F.greatest(F.lit(SHORTEST), F.lit(EXPONENT) * F.col("period")))
    return runs.groupBy("key", "start", "length").agg(F.min("period").alias("period"))


def periodic_runs(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), tile: int = 8192, room: int = 200_000) -> DataFrame:
    """``keep`` columns, n_words, runs (array of start, length, period, sorted by start, then period) and collapsed (the words without
    those that a run holds after its first period, joined by blanks)."""
    spark, n_keep = docs.sparkSession, len(keep)
    rows = docs.select(*[F.col(c) for c in keep], F.col(text).alias("_text"))
    # A word and its separator take two bytes at least, so a text below this has at most ``tile`` words.
    wide = F.coalesce(F.octet_length("_text") >= 2 * tile, F.lit(False))
    short = _solve_short(rows.where(~wide), n_keep, room)

    plain = _explode(rows.where(wide).toDF(*[f"_k{i}" for i in range(n_keep)], "_text"), n_keep, tile)
    path = scratch_path(spark, "period-tiles")
    plain.write.option("compression", "zstd").parquet(path)
    work = spark.read.schema(plain.schema).parquet(path)
    tiles = work.where("ids is not null").select("key", *[c for c, _, _ in _TILE])
    fragments = tiles.repartition(partitions(spark, 1, 1), "key", "first", "core").mapInArrow(_solve_tiles, _FRAGMENT)
    listed = stitch(fragments).groupBy("key").agg(F.sort_array(F.collect_list(F.struct(F.col("start"), F.col("period"), F.col("length")))).alias("_runs"))
    found = F.transform("_runs", lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period")))
    bodies = work.where("body is not null").select(*[f"_k{i}" for i in range(n_keep)], "body", "key")
    joined = bodies.join(listed, "key", "left").select(*[f"_k{i}" for i in range(n_keep)], "body", F.coalesce(found, F.array().cast(_RUNS)).alias("runs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [byte_words(x.as_py()) for x in b.column(n_keep)]
            runs = b.column(n_keep + 1)
            new = [pa.array([len(w) for w in words], pa.int64()), runs, pa.array([_collapse(w, f.as_py()) for w, f in zip(words, runs)], pa.string())]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in range(n_keep)), *new], names=schema.names)
    schema = _out_schema(joined, n_keep)
    return short.union(joined.mapInArrow(run, schema))
