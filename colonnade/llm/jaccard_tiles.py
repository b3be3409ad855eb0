"""Operator 8: n-gram Jaccard join with size-banded tiles, bitmap signatures and exact intersection.

Sets of word shingles (64-bit hashes).  Equal sets are one class (told by a 128-bit digest of the set).  A set sends its
prefix, the first size - ceil(t * size) + 1 shingles in an order that is the same for all sets, as two sets that link share one of
those.  The order puts shingles that are frequent in a bounded sample of sets last and follows the hash otherwise: it
decides how full tiles get, never what is found.  Shingles sent by one class only go at once.

A tile is a shared shingle and a band of sizes; a set enters the band of its size and the next one, so any two sets that are close
enough in size meet.  First each tile's sets are compared with a hub, the set whose shingles are shared most (an original
rather than one of its copies), in two rounds; linked sets become one component.  Tiles of two sets are settled by that.  In larger tiles that still hold several
components all sets of different ones are compared, inside a task and without making rows of them (large tiles by blocks).  A comparison
goes by size, then by a bound on the overlap from the bit counts of signatures, hashed bitmaps of two to four bits a
shingle, then by exact intersection of sorted arrays, which are made for the pairs that are left only; so no link between components is
lost.  The bit counts of one tile grow with the square of the sets in it that are alike but not linked.

Null and empty texts have no set: size 0, a component of their own.  Texts with fewer words than a shingle have
their whole sequence as one.  Repeated rows are equal sets.  Rows with a null key take part (links through them count)
and get the least key of their component, null if there is none; one key on several texts is a row each.  Whole texts are read,
however long.  Empty tables give no rows; only key and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from colonnade.llm.text import Scratch, byte_words, materialise
from colonnade.llm.windows import WordHashes, rolling

# Least bits of a signature; larger sets have two to four bits a shingle.
BITS = 512
# Sets of a tile that one task compares with one another at once.
BLOCK = 4_096
# Pairs that a task holds before it passes them on.
TOLD = 50_000
# First tokens that a set brings along, and what stands for none.
FIRST, NO_TOKEN = 6, (1 << 63) - 1
# Sets in the sample that the shingle order is taken from, and frequent shingles it may name.
SAMPLE_SETS, FREQUENT = 20_000, 100_000
# Pairs of one centre that one group verifies.
GROUP = 2_000
# A worker keeps its cache as long as it lives, and an executor keeps several workers.
_word_hash = WordHashes(50_000)


def shingle_set(text: str | None, n: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    ws = byte_words(text, lower=True)
    if not ws:
        return np.zeros(0, np.uint64)
    h = np.sort(rolling(_word_hash(ws), min(n, len(ws))) ^ np.uint64(len(ws) if len(ws) < n else 0))
    return h[np.r_[True, h[1:] != h[:-1]]]


def signature(s: np.ndarray) -> np.ndarray:
    """Bits (a power of two of them) as integers of 64; halves laid over each other give the signature of half the length."""
    size = max(BITS, 1 << (2 * len(s) - 1).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[(s >> np.uint64(20)) % np.uint64(size)] = 1
    return np.packbits(bits).view(np.int64)


def fold(sig: np.ndarray, size: int) -> np.ndarray:
    while len(sig) > size:
        sig = sig[:len(sig) // 2] | sig[len(sig) // 2:]
    return sig


def bounded_pairs(n: np.ndarray, comp: np.ndarray, sigs: list[np.ndarray], percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(i, js > i): sets of different components that size and bit counts allow to link."""
    width = min(map(len, sigs))
    mat = np.stack([fold(s, width) for s in sigs]).view(np.uint64)  # counts of signed integers are of their magnitude
    for i in range(len(n) - 1):
        js = np.arange(i + 1, len(n))
        js = js[(comp[js] != comp[i]) & (100 * np.minimum(n[i], n[js]) >= percent * np.maximum(n[i], n[js]))]
        if len(js):
            mine, others = mat[i], mat[js]
            most = np.minimum(n[i] - np.bitwise_count(mine & ~others).sum(axis=1).astype(np.int64), n[js] - np.bitwise_count(others & ~mine).sum(axis=1).astype(np.int64))
            js = js[(100 + percent) * most >= percent * (n[i] + n[js])]
            if len(js):
                yield i, js


def prefix(s: np.ndarray, percent: int, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The shingles that the set sends: first the ones not known as frequent, by hash."""
    send = len(s) - -(-percent * len(s) // 100) + 1
    if not len(frequent[0]):
        return s[:send]
    at = np.minimum(np.searchsorted(frequent[0], s), len(frequent[0]) - 1)
    weight = np.where(frequent[0][at] == s, frequent[1][at], 0)
    return s[np.lexsort((s, weight))[:send]]


def needed(na: Column, nb: Column, percent: int) -> Column:
    """Least intersection of sets that link: 100 * i >= percent * (na + nb - i)."""
    return F.ceil(F.lit(percent) * (na + nb) / F.lit(100 + percent))


def overlap_bound(a: Column, b: Column, na: Column, nb: Column) -> Column:
    """Upper bound of the intersection: a bit that only one set has stands for at least one element the other lacks.  Of two
    lengths the longer signature is folded (sets that are close in size differ by one halving)."""
    def folded(x: Column, y: Column) -> Column:
        half = F.size(y)
        return F.when(F.size(x) > half, F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseOR(q))).otherwise(x)

    def only(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q)))), F.lit(0), lambda t, v: t + v)
    return F.least(na - only(folded(a, b), folded(b, a)), nb - only(folded(b, a), folded(a, b)))


def components(spark: SparkSession, edges: DataFrame, name: str) -> DataFrame:
    """(a, b) links -> (id, comp): least id reachable, by alternating large-star and small-star steps.

    Every row is (larger end, smaller end); a hub's neighbours are moved to their least one, so a
    node keeps one link per round in the end and rounds grow with the log of the longest chain."""
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    e = materialise(e, f"{name}-edges")
    while True:
        # Stars only: every node has one link, and no node is both an end and a centre.
        ends = e.select(F.col("a").alias("v"), F.lit(1).alias("n"), F.lit(0).alias("c"))
        ends = ends.unionByName(e.select(F.col("b").alias("v"), F.lit(0).alias("n"), F.lit(1).alias("c")))
        if ends.groupBy("v").agg(F.sum("n").alias("n"), F.max("c").alias("c")).where(F.col("n") + F.col("c") > 1).isEmpty():
            break
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialise(large.where("a <> b").distinct(), f"{name}-large")
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        nxt = large.join(small, "a")
        nxt = nxt.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b")))
        e = materialise(nxt.where("a <> b").distinct(), f"{name}-small")
    roots = e.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("comp"))
    return materialise(e.select(F.col("a").alias("id"), F.col("b").alias("comp")).unionByName(roots), f"{name}-comp")


def merge(comp: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """(id, comp) after new links (a, b) between ids: only the components that they touch are worked on."""
    if links.isEmpty():
        return comp
    ends = comp.select(F.col("id").alias("a"), F.col("comp").alias("ca")), comp.select(F.col("id").alias("b"), F.col("comp").alias("cb"))
    moved = components(comp.sparkSession, links.join(ends[0], "a").join(ends[1], "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")), name)
    moved = moved.select(F.col("id").alias("comp"), F.col("comp").alias("to"))
    return materialise(comp.join(moved, "comp", "left").select("id", F.coalesce("to", "comp").alias("comp")), f"{name}-merged")


def _sets(rows: DataFrame, n_keep: int, n: int, fields: list[tuple[str, T.DataType, pa.DataType]], make) -> DataFrame:
    """The first ``n_keep`` columns and what ``make`` tells of the set of the text in the last one."""
    schema = T.StructType([*rows.schema.fields[:n_keep], *(T.StructField(c, t) for c, t, _ in fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                made = [make(shingle_set(t.as_py(), n)) for t in b.column(b.num_columns - 1)]
                new = [pa.array([m[i] for m in made], t) for i, (_, _, t) in enumerate(fields)]
                yield pa.RecordBatch.from_arrays([*b.columns[:n_keep], *new], names=schema.names)
    return rows.mapInArrow(run, schema)


def frequent_shingles(rows: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, counts) of at most FREQUENT shingles that occur in at least four of about SAMPLE_SETS different sets."""
    every = max(1, rows.count() // SAMPLE_SETS)
    sample = rows.where(F.pmod(F.col("h1"), F.lit(every)) == 0).select("h1", "h2", "t").dropDuplicates(["h1", "h2"]).select("t")
    listed = _sets(sample, 0, n, [("arr", T.ArrayType(T.LongType()), pa.list_(pa.int64()))], lambda s: (s.view(np.int64),)).distinct()
    top = (listed.select(F.explode("arr").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("c")).where("c > 3")
           .orderBy(F.desc("c"), "s").limit(FREQUENT).collect())
    s, c = np.array([r[0] for r in top], np.int64).view(np.uint64), np.array([r[1] for r in top], np.int64)
    order = np.argsort(s)
    return s[order], c[order]


def _bounded(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes whose signatures allow a link."""
    sides = [classes.select(F.col("cid").alias(c), F.col("n").alias(f"n_{c}"), F.col("sig").alias(f"sig_{c}")) for c in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b")
    bound = overlap_bound(F.col("sig_a"), F.col("sig_b"), F.col("n_a"), F.col("n_b"))
    return both.where(bound >= needed(F.col("n_a"), F.col("n_b"), percent)).select("a", "b")


def _open_pairs(left: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of sets of different components that meet in a tile (token, band, cid, n, comp; ``m`` sets in the tile) and that size and bit
    counts allow to link.  Tiles of more than BLOCK sets are dealt as pairs of blocks.

    Sets that share many shingles meet in many tiles; each set brings the first tokens it has in the band, and a pair that has an
    earlier one in common is left to that tile."""
    per = Window.partitionBy("cid", "band")
    left = left.select("token", "band", "cid", "n", "comp", "m").repartition("cid").withColumn("_rn", F.row_number().over(per.orderBy("token")))
    left = left.withColumn("first", F.array(*[F.max(F.when(F.col("_rn") == k, F.col("token"))).over(per) for k in range(1, FIRST + 1)]))
    blocks = F.ceil(F.col("m") / BLOCK)
    mine = F.pmod(F.xxhash64("cid"), blocks)
    spread = F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda j: F.struct(F.least(mine, j).alias("lo"), F.greatest(mine, j).alias("hi")))
    rows = left.select("token", "band", "cid", "n", "comp", "first", F.explode(spread).alias("g")).join(classes.select("cid", "sig"), "cid")
    rows = rows.select("token", "band", F.col("g.lo").alias("lo"), F.col("g.hi").alias("hi"), "cid", "n", "comp", "sig", "first")

    def compare(token: int, cid: np.ndarray, n: np.ndarray, comp: np.ndarray, first: np.ndarray, sigs: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for i, js in bounded_pairs(n, comp, sigs, percent):
            earlier = first[i][first[i] < token]
            js = js[~np.isin(first[js], earlier).any(axis=1)]
            yield np.maximum(cid[i], cid[js]), np.minimum(cid[i], cid[js])

    def worth(begin: np.ndarray, size: np.ndarray, token, n, comp, first) -> np.ndarray:
        """Which groups to compare: of two sets, those that size, components and earlier tiles leave; all larger groups."""
        go = size > 2
        two = np.flatnonzero(size == 2)
        i, j = begin[two], begin[two] + 1
        near = (comp[i] != comp[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
        same = (first[i][:, :, None] == first[j][:, None, :]) & (first[i] < token[i][:, None])[:, :, None]
        go[two] = near & ~same.any(axis=(1, 2))
        return np.flatnonzero(go)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last group of a batch may go on in the next
        for b in batches:
            sigs, ends = np.asarray(b.column(7).flatten()), np.cumsum(np.asarray(b.column(7).value_lengths()))
            parts = [np.asarray(c) for c in b.columns[:7]] + [np.asarray(b.column(8).flatten().fill_null(NO_TOKEN)).reshape(-1, FIRST),
                                                             np.fromiter(np.split(sigs, ends[:-1]), object, b.num_rows)]
            yield from step([np.concatenate(p) for p in zip(held, parts)] if held else parts, False)
            held = rest[0]
        if held:
            yield from step(held, True)

    rest: list = [None]

    def step(parts: list, last: bool) -> Iterator[pa.RecordBatch]:
        token, cid, n, comp, first, sigs = parts[0], *parts[4:9]
        change = np.flatnonzero(np.any([p[1:] != p[:-1] for p in parts[:4]], axis=0)) + 1
        begin = np.concatenate([[0], change])
        size = np.diff(np.concatenate([begin, [len(token)]]))
        rest[0] = None if last else [p[begin[-1]:] for p in parts]
        if not last:
            begin, size = begin[:-1], size[:-1]
        found, have = [(cid[:0], cid[:0])], 0
        for g in worth(begin, size, token, n, comp, first):
            at = slice(begin[g], begin[g] + size[g])
            for told in compare(token[begin[g]], cid[at], n[at], comp[at], first[at], list(sigs[at])):
                found.append(told)
                have += len(told[0])
                if have > TOLD:
                    yield pa.RecordBatch.from_arrays([np.concatenate(x) for x in zip(*found)], names=["a", "b"])
                    found, have = [(cid[:0], cid[:0])], 0
        yield pa.RecordBatch.from_arrays([np.concatenate(x) for x in zip(*found)], names=["a", "b"])

    dealt = rows.repartition("token", "band", "lo", "hi").sortWithinPartitions("token", "band", "lo", "hi")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def _verified(pairs: DataFrame, classes: DataFrame, rows: DataFrame, n: int, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs that link, by intersection of the sorted arrays of the sets in them.

    Of the two, the set with more pairs is the centre; its text goes once to each of its groups (of about GROUP pairs), the
    other one's once per pair.  Texts go compressed, which takes about a quarter of their arrays; the arrays are made where they
    are compared.  A group's rows arrive in order, the centre first, so a task holds two arrays at a time."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("d"))
    counted = pairs.join(ends.select(F.col("c").alias("a"), F.col("d").alias("da")), "a").join(ends.select(F.col("c").alias("b"), F.col("d").alias("db")), "b")
    first = (F.col("da") > F.col("db")) | ((F.col("da") == F.col("db")) & (F.col("a") < F.col("b")))
    other = F.when(first, F.col("b")).otherwise(F.col("a"))
    meets = counted.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("centre"), other.alias("cid"),
                           F.pmod(F.xxhash64(other), F.ceil(F.greatest("da", "db") / GROUP)).alias("salt"))
    roles = meets.select("cid", F.struct("centre", "salt", F.lit(1).alias("role")).alias("r")).unionByName(
        meets.select("centre", "salt").distinct().select(F.col("centre").alias("cid"), F.struct("centre", "salt", F.lit(0).alias("role")).alias("r")))
    roles = roles.groupBy("cid").agg(F.collect_list("r").alias("roles"))
    place = classes.select("cid", F.coalesce(F.col("at.k").cast("string"), F.lit("")).alias("w0"), F.col("at.h1").alias("w1"), F.col("at.h2").alias("w2"))
    wanted = scratch.write(roles.join(place, "cid"), "wanted")
    texts = rows.select(F.coalesce(F.col("k").cast("string"), F.lit("")).alias("w0"), F.col("h1").alias("w1"), F.col("h2").alias("w2"), "t")
    found = texts.join(wanted, ["w0", "w1", "w2"]).dropDuplicates(["w0", "w1", "w2"]).select("cid", "roles", "t")
    packed_schema = T.StructType([*found.schema.fields[:2], T.StructField("body", T.BinaryType())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                bodies = [squeeze.compress(t.as_py().encode("utf-8", "surrogatepass")) for t in b.column(2)]
                yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(bodies, pa.binary())], names=packed_schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, hub, loosen = None, np.zeros(0, np.uint64), zstandard.ZstdDecompressor()
        for b in batches:
            out = []
            for centre, salt, role, cid, body in zip(*(c.to_pylist() for c in b.columns[:4]), b.column(4)):
                s = shingle_set(loosen.decompress(body.as_py()).decode("utf-8", "surrogatepass"), n)
                if role == 0:
                    group, hub = (centre, salt), s
                    continue
                if group != (centre, salt):
                    raise RuntimeError("a group arrived without its centre")
                both = len(np.intersect1d(hub, s, assume_unique=True))
                if 100 * both >= percent * (len(hub) + len(s) - both):
                    out.append((centre, cid))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in range(2)], names=["a", "b"])

    dealt = found.mapInArrow(pack, packed_schema).select("cid", F.explode("roles").alias("r"), "body").select("r.centre", "r.salt", "r.role", "cid", "body")
    return dealt.repartition("centre", "salt").sortWithinPartitions("centre", "salt", "role").mapInArrow(run, "a long, b long")


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80,
                       rounds: int = 2) -> DataFrame:
    """key, n_shingles, component_id (least key of the component), class_size (rows with an equal set)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    rows = docs.select(F.col(key).alias("k"), F.xxhash64(F.col(text)).alias("h1"), F.xxhash64(F.lit(1), F.col(text)).alias("h2"), F.col(text).alias("t"))
    frequent = frequent_shingles(rows, n)

    def describe(s: np.ndarray) -> tuple:
        if not len(s):
            return 0, None, None, None
        return len(s), xxhash.xxh3_128_digest(s.tobytes()), signature(s), prefix(s, percent, frequent).view(np.int64)

    longs = T.ArrayType(T.LongType())
    described = _sets(rows, 3, n, [("n", T.LongType(), pa.int64()), ("sk", T.BinaryType(), pa.binary()), ("sig", longs, pa.list_(pa.int64())),
                                   ("tokens", longs, pa.list_(pa.int64()))], describe)
    described = scratch.write(described, "described")
    # Any row of a class stands for it: its set is the same.
    classes = described.where("sk is not null").groupBy("sk").agg(
        F.min("k").alias("rep"), F.count(F.lit(1)).alias("class_size"), F.min(F.struct("k", "h1", "h2", "n", "sig", "tokens")).alias("at"))
    sending = scratch.write(classes.select(F.monotonically_increasing_id().alias("cid"), "sk", "rep", "class_size", F.struct("at.k", "at.h1", "at.h2").alias("at"),
                                           "at.n", "at.sig", "at.tokens"), "sending")
    members = scratch.write(described.select("k", "n", "sk"), "members")
    scratch.drop("described")

    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)) + 1e-9)
    sent = sending.select("cid", "n", F.explode("tokens").alias("token"))
    shared = sent.withColumn("_c", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("_c > 1")
    scored = shared.withColumn("score", F.sum("_c").over(Window.partitionBy("cid")) / F.col("n"))
    banded = scored.select("cid", "n", "score", "token", F.explode(F.array(band, band + 1)).alias("band"))
    tiles = banded.withColumn("m", F.count(F.lit(1)).over(Window.partitionBy("token", "band"))).where("m > 1")
    tiles = scratch.write(tiles, "tiles")
    classes = scratch.write(sending.drop("tokens"), "classes")
    scratch.drop("sending")

    comp = classes.select(F.col("cid").alias("id"), F.col("cid").alias("comp"))
    tried = spark.createDataFrame([], "a long, b long")
    close = 100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")
    for r in range(rounds + 1):
        # Of two sets, the hub and the other one have met in the first round.
        unsettled = tiles.where("m > 2") if r else tiles
        at = unsettled.join(comp, unsettled["cid"] == comp["id"]).drop("id")
        # Tiles with one component left have nothing to compare.
        best = F.struct("score", F.xxhash64("cid").alias("o"), "cid", "n", "comp") if r == 0 else F.struct(F.xxhash64("cid", F.lit(r)).alias("o"), "cid", "n", "comp")
        hubs = at.groupBy("token", "band").agg(F.max(best).alias("h"), F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 <> c1")
        if r < rounds:
            meet = at.join(hubs.select("token", "band", F.col("h.cid").alias("cid2"), F.col("h.n").alias("n2"), F.col("h.comp").alias("comp2")), ["token", "band"])
            pairs = meet.where((F.col("comp") != F.col("comp2")) & close).select(F.greatest("cid", "cid2").alias("a"), F.least("cid", "cid2").alias("b")).distinct()
            pairs = scratch.write(pairs.join(tried, ["a", "b"], "left_anti"), f"pairs{r}")
            tried = tried.unionByName(pairs)
            alike = scratch.write(_bounded(pairs, classes, percent), "alike")
        else:
            left = at.join(hubs.select("token", "band"), ["token", "band"])
            alike = scratch.write(_open_pairs(left, classes, percent).join(tried, ["a", "b"], "left_anti"), "alike")
        if not alike.isEmpty():
            found = scratch.write(_verified(alike, classes, rows, n, percent, scratch), "links")
            scratch.drop("wanted")
            comp = merge(comp, found, f"jaccard-{r}")
    # Components are written by now, if any set linked.
    scratch.drop("tiles", "alike", "links", *(f"pairs{r}" for r in range(rounds)))
    named = classes.join(comp, classes["cid"] == comp["id"])
    least = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "comp").select("sk", "component_id", "class_size")
    out = members.select("k", "n", "sk").join(named, "sk", "left")
    return out.select(F.col("k").alias(key), F.col("n").alias("n_shingles"),
                      F.coalesce("component_id", "k").alias("component_id"), F.coalesce("class_size", F.lit(0)).alias("class_size"))
