"""Operator 3: Brown class-based bigram model with exchange clustering of the whole training vocabulary.

Texts are read once, in chunks of about ``CHUNK`` words: numbers of words in the chunk's own vocabulary of hashes.  Words whose
relative training frequency is at least ``frequent`` (at most 1 / frequent of them, a proven bound; each is that
frequent in some chunk) get their first classes by sequential exchange on the driver, all other words are one context
there.  Then every other word is placed, and all words are exchanged in sweeps.

The other words are dealt to blocks by hash.  A block holds its words' bigrams in both directions, with numbers for
the neighbours, in a table bucketed by block, so that no sweep shuffles bigrams.  What travels in a sweep is one class
byte for each word and block in which it has neighbours: both sides know the order, as each sees the same bigrams.  Frequent
words have no block: their (side, class of the neighbour) counts are summed over the blocks of the neighbours and their
moves scored on the driver, bounded like their number.  Tasks score each word's moves against the class x class matrix.
In a sweep half of the words (by hash) may move, against the matrix before the sweep; classes that do not raise the
likelihood are dropped and fewer words move next.

p(w | history) = p(class | class before) * p(w | class), both smoothed; the end of a text is a token and a class,
and stands before the first word.  Only words unseen in training share a fallback class, with the probability that the
unigram gives them.  Null and empty texts are the end token alone.  Repeated rows are scored each.  A corpus without
training rows gives every word its smoothing mass.  Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colonnade.llm.text import Scratch
from colonnade.llm.windows import bucket_count

ADD = 0.1
CHUNK = 2_000_000  # words read together
PIECE = 4_000_000  # bytes of text cut into words together
PER_BLOCK = 1_000_000  # words of text for each block
PLACED, NEW = 2, 3  # kinds of the list entry that holds a word's own class; 0 and 1: class to the right, to the left
OWN = -1  # stands for the sender in the row that holds a block's own classes
CLASSES = "block int, src int, cls binary"


def exchange(bigrams: np.ndarray, movable: int, classes: int, sweeps: int = 4) -> np.ndarray:
    """Class of each symbol.  Symbols [0, movable) start dealt by rank and are exchanged; symbol movable + i keeps
    class classes + i.  bigrams[i, j]: times that symbol j followed symbol i."""
    fixed = len(bigrams) - movable
    cls = np.r_[np.arange(movable) % classes, classes + np.arange(fixed)]
    k = classes + fixed
    n = np.zeros((k, k))
    np.add.at(n, (cls[:, None], cls[None, :]), bigrams)

    def g(x):
        return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)

    for _ in range(sweeps):
        moved = 0
        for w in range(movable):
            a = cls[w]
            self_n = float(bigrams[w, w])
            right = np.bincount(cls, weights=bigrams[w], minlength=k)
            left = np.bincount(cls, weights=bigrams[:, w], minlength=k)
            right[a] -= self_n  # the word's own pairs apart
            left[a] -= self_n
            n[a] -= right
            n[:, a] -= left
            n[a, a] -= self_n
            rows, cols = n[:classes], n[:, :classes].T
            row_gain = g(rows + right) - g(rows)
            col_gain = g(cols + left) - g(cols)
            own = np.arange(classes)
            both = n[own, own]
            cell = g(both + right[:classes] + left[:classes] + self_n) - g(both)
            out, into = rows.sum(1), cols.sum(1)
            r, li = right.sum() + self_n, left.sum() + self_n
            gain = (row_gain.sum(1) - row_gain[own, own] + col_gain.sum(1) - col_gain[own, own] + cell
                    - (g(out + r) - g(out)) - (g(into + li) - g(into)))
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            moved += b != a
            cls[w] = b
            n[b] += right
            n[:, b] += left
            n[b, b] += self_n
        if not moved:
            break
    return cls


def _g(x: np.ndarray) -> np.ndarray:
    """x * log(x), 0 at 0; x is not negative."""
    out = np.maximum(x, 1e-300)
    np.log(out, out=out)
    out *= x
    return out


def likelihood(n: np.ndarray) -> float:
    return float(_g(n).sum() - _g(n.sum(0)).sum() - _g(n.sum(1)).sum())


def _planes(x: np.ndarray) -> bytes:
    """How many bytes a number takes, then all lowest bytes, all next ones, and so on: small numbers compress well so."""
    size = max(1, -(-int(x.max()).bit_length() // 8)) if len(x) else 1
    return b"".join([bytes([size]), *((x >> 8 * i).astype(np.uint8).tobytes() for i in range(size))])


def _whole(b: bytes) -> np.ndarray:
    planes = np.frombuffer(b, np.uint8, offset=1).reshape(b[0], -1)
    out = planes[0].astype(np.int64)
    for i in range(1, b[0]):
        out |= planes[i].astype(np.int64) << 8 * i
    return out


def _sorted(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys, ascending, and their n; as one number where both fit, which sorts faster."""
    if not len(key):
        return key, n
    bits = int(n.max()).bit_length()
    if int(key.max()).bit_length() + bits < 63:
        both = np.sort(key << bits | n)
        return both >> bits, both & ((1 << bits) - 1)
    order = np.argsort(key, kind="stable")
    return key[order], n[order]


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their n."""
    if not len(key):
        return key, n
    key, n = _sorted(key, n)
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[first], np.add.reduceat(n, first)


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def cut_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Words per text, the words' numbers, and the distinct words: as ``byte_words`` with lower, for many texts at once."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")  # the words of the rule end at the six ASCII separators
    _, at, data = texts.buffers()
    at = np.frombuffer(at, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(np.frombuffer(data or b"", np.uint8)[at[0]:at[-1]].tobytes().lower(), np.uint8)
    at = at - at[0]
    inside = (raw != 32) & ((raw < 9) | (raw > 13))
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    full = at[:-1] < at[1:]
    begins[at[:-1][full]] = inside[at[:-1][full]]
    ends[at[1:][full] - 1] = inside[at[1:][full] - 1]
    begins = np.flatnonzero(begins)
    bounds = np.r_[0, np.cumsum(np.flatnonzero(ends) - begins + 1)].astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(bounds), pa.py_buffer(raw[inside])]).dictionary_encode()
    return np.diff(np.searchsorted(begins, at)), words.indices.to_numpy(), words.dictionary.to_numpy(zero_copy_only=False).tolist()


def read_chunks(batches: Iterator[pa.RecordBatch], frequent: float) -> Iterator[pa.RecordBatch]:
    """Rows k, held, t -> a row for each chunk: texts in order, words as numbers in the chunk's sorted vocabulary."""
    number = TaskContext.get().partitionId() << 32
    held: list[tuple] = []
    size = 0

    def out() -> pa.RecordBatch:
        nonlocal number
        number += 1
        k, is_held = (pa.concat_arrays([x[i] for x in held]) for i in (0, 1))
        sizes = np.concatenate([x[2] for x in held])
        every = [w for x in held for w in x[4]]
        h, at, which = np.unique(_hashes(every), return_index=True, return_inverse=True)
        first = np.cumsum([0, *(len(x[4]) for x in held)])
        ids = np.concatenate([which[x[3] + f] for x, f in zip(held, first)])
        train = ~is_held.fill_null(True).to_numpy(zero_copy_only=False)
        n = np.bincount(ids[np.repeat(train, sizes)], minlength=len(h))
        tokens, texts = int(n.sum()), int(train.sum())
        often = [every[i] for i in at[(n > 0) & (n >= frequent * (tokens + texts))]]
        crc = np.fromiter(map(zlib.crc32, map(every.__getitem__, at.tolist())), np.uint32, len(at))
        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        cols = {"chunk": [number], "k": one(k), "held": one(is_held), "size": [_planes(sizes)], "ids": [_planes(ids)], "h": [h.tobytes()],
                "crc": [crc.tobytes()], "n": [_planes(n)], "often": pa.array([often], pa.list_(pa.binary())), "tokens": [tokens], "texts": [texts]}
        return pa.RecordBatch.from_pydict(cols)

    for b in batches:
        t = b.column("t")
        at = np.cumsum(np.r_[0, pc.fill_null(pc.binary_length(t), 0).to_numpy(zero_copy_only=False)])
        lo = 0
        while lo < len(t):
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + PIECE)))
            hi = min(hi, len(t))
            sizes, codes, words = cut_words(t.slice(lo, hi - lo))
            held.append((b.column("k").slice(lo, hi - lo), b.column("held").slice(lo, hi - lo), sizes, codes, words))
            size += int(sizes.sum()) + (hi - lo)
            lo = hi
            if size >= CHUNK:
                yield out()
                held, size = [], 0
    if held:
        yield out()


def _sequence(ids: np.ndarray, sizes: np.ndarray, end: int, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kept texts one after the other, each followed by ``end``; where each begins."""
    ids, sizes = ids[np.repeat(keep, sizes)], sizes[keep]
    out = np.full(len(ids) + len(sizes), end, np.int64)
    stop = np.cumsum(sizes + 1)
    words = np.ones(len(out), bool)
    words[stop - 1] = False
    out[words] = ids
    return out, stop - sizes - 1


class Blocks:
    """The words that are not frequent, dealt to ``count`` blocks by hash; ``head``: hashes of the frequent ones by rank.

    A neighbour's code is 2 * i + side; i: rank of a frequent word, len(head) for the end token, and from there on the neighbours
    of the block by (block, hash)."""

    def __init__(self, head: np.ndarray, count: int, classes: int):
        self.head, self.count, self.classes, self.k = head, count, classes, classes + 2
        self.few = len(head) + 1

    def ranks(self, h: np.ndarray, other: int) -> np.ndarray:
        """Rank of each hash among the frequent words, else ``other``."""
        if not len(self.head):
            return np.full(len(h), other)
        order = np.argsort(self.head)
        at = np.minimum(np.searchsorted(self.head[order], h), len(order) - 1)
        return np.where(self.head[order][at] == h, order[at], other)

    def of(self, h: np.ndarray) -> np.ndarray:
        return (h % np.uint64(self.count)).astype(np.int64)

    def symbol_pairs(self, ids: np.ndarray, sizes: np.ndarray, keep: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Bigrams of a chunk's kept texts over ranks, end token and one symbol for all other words."""
        s = self.few + 1
        seq, _ = _sequence(self.ranks(h, s - 1)[ids], sizes, self.few - 1, keep)
        return np.bincount(np.r_[self.few - 1, seq[:-1]] * s + seq, minlength=s * s) if len(seq) else np.zeros(s * s)

    def send(self, ids: np.ndarray, sizes: np.ndarray, keep: np.ndarray, h: np.ndarray, crc: np.ndarray) -> Iterator[tuple]:
        """(block, words, first classes, entries per word, codes, counts, other neighbours' hashes) of a chunk's bigrams."""
        seq, _ = _sequence(ids, sizes, len(h), keep)
        if not len(seq):
            return
        of = self.of(h)
        by_block = np.argsort(of, kind="stable")
        place = np.empty(len(h) + 1, np.int64)
        place[by_block] = np.arange(len(h))  # words by (block, hash), the end token last
        place[-1] = len(h)
        h, crc, seq = h[by_block], crc[by_block], place[seq]
        wide = len(h) + 1
        key = np.sort(np.r_[len(h), seq[:-1]] * wide + seq)
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        n = np.diff(np.r_[first, len(key)])
        a, b = np.divmod(key[first], wide)
        rank = np.r_[self.ranks(h, self.few), self.few - 1]
        right, left = rank[a] == self.few, rank[b] == self.few
        key, n = _sorted(np.r_[a[right] * wide + b[right] << 1, b[left] * wide + a[left] << 1 | 1], np.r_[n[right], n[left]])
        side = key & 1
        w, v = np.divmod(key >> 1, wide)
        start = (crc % np.uint32(self.classes)).astype(np.uint8)
        bounds = np.searchsorted(w, np.searchsorted(of[by_block], np.arange(self.count + 1)))
        for p in np.flatnonzero(np.diff(bounds)):
            at = slice(bounds[p], bounds[p + 1])
            ww, vv = w[at], v[at]
            code = rank[vv]
            new = np.flatnonzero(np.r_[True, ww[1:] != ww[:-1]])
            far = code == self.few
            seen = np.zeros(wide, bool)
            seen[vv[far]] = True
            others = np.flatnonzero(seen)
            code[far] = self.few + (np.cumsum(seen) - 1)[vv[far]]
            yield (int(p), h[ww[new]].tobytes(), start[ww[new]].tobytes(), _planes(np.diff(np.r_[new, len(ww)])),
                   _planes(2 * code + side[at]), _planes(n[at]), h[others].tobytes())

    def build(self, rows: list[tuple]) -> dict:
        """A block from all its rows of ``send``."""
        sent, far = [np.frombuffer(r[1], np.uint64) for r in rows], [np.frombuffer(r[6], np.uint64) for r in rows]
        words, near = np.unique(np.concatenate(sent)), np.unique(np.concatenate(far))
        which = [np.searchsorted(words, x) for x in sent]
        start = np.zeros(len(words), np.uint8)
        for r, x in zip(reversed(rows), reversed(which)):
            start[x] = np.frombuffer(r[2], np.uint8)
        w = np.concatenate([np.repeat(x, _whole(r[3])) for r, x in zip(rows, which)])
        of = self.of(near)
        order = np.argsort(of, kind="stable")
        rank = np.empty(len(near), np.int64)
        rank[order] = np.arange(len(near))
        codes = []
        for r, f in zip(rows, far):
            code = _whole(r[4])
            i = code >> 1
            codes.append(2 * np.r_[np.arange(self.few), self.few + rank[np.searchsorted(near, f)]][i] + (code & 1))
        wide = 2 * (self.few + len(near))
        key, n = _summed(w * wide + np.concatenate(codes), np.concatenate([_whole(r[5]) for r in rows]))
        w, code = np.divmod(key, wide)
        tail = code >> 1 >= self.few
        src, counts = np.unique(of, return_counts=True)
        to = np.unique(of[order][(code[tail] >> 1) - self.few] * len(words) + w[tail])
        dest, out = np.divmod(to, len(words))
        dest, outs = np.unique(dest, return_counts=True)
        total = np.bincount(w, weights=n * (code & 1 == 0), minlength=len(words)).astype(np.int64)
        return {"block": rows[0][0], "words": words.tobytes(), "total": _planes(total), "start": start.tobytes(),
                "per": _planes(np.bincount(w, minlength=len(words))), "code": _planes(code), "n": _planes(n),
                "src": _planes(src), "counts": _planes(counts), "dest": _planes(dest), "outs": _planes(outs), "out": _planes(out)}

    def spread(self, row, cls: np.ndarray) -> pd.DataFrame:
        """The block's classes for itself and for each block in which its words have neighbours."""
        cls = cls.astype(np.uint8)
        parts = np.split(cls[_whole(row.out)], np.cumsum(_whole(row.outs))[:-1])
        rows = [(row.block, OWN, cls.tobytes()), *((int(q), row.block, x.tobytes()) for q, x in zip(_whole(row.dest), parts) if len(x))]
        return pd.DataFrame(rows, columns=["block", "src", "cls"])

    def entries(self, row, sent: pd.DataFrame) -> tuple[np.ndarray, ...]:
        """Words' classes, and of each entry word, rank (few: none), side, count, class where there is no rank."""
        sent = sent.sort_values("src")
        own = np.frombuffer(sent["cls"].iloc[0], np.uint8).astype(np.int64)
        if sent["src"].iloc[0] != OWN or [*map(len, sent["cls"].iloc[1:])] != [*_whole(row.counts)]:
            raise RuntimeError("classes of a block's neighbours are missing")
        near = np.frombuffer(b"".join(sent["cls"].iloc[1:]), np.uint8).astype(np.int64)
        w, code, n = np.repeat(np.arange(len(own)), _whole(row.per)), _whole(row.code), _whole(row.n)
        i = code >> 1
        d = np.concatenate([np.zeros(self.few, np.int64), near])[i]
        return own, w, np.minimum(i, self.few), code & 1, n, d

    def cells(self, own, w, rank, side, n, d) -> np.ndarray:
        """Class x class counts of bigrams without frequent words, words per class, counts by (rank, side, class)."""
        k, few = self.k, self.few
        far = (rank == few) & (side == 0)
        m = np.bincount(own[w[far]] * k + d[far], weights=n[far], minlength=k * k)
        near = rank < few
        by_rank = np.bincount(rank[near] * 256 + (1 - side[near]) * 128 + own[w[near]], weights=n[near], minlength=few * 256)
        return np.r_[m, np.bincount(own, minlength=k), by_rank]


def packed_lists(word: np.ndarray, side: np.ndarray, d: np.ndarray, n: np.ndarray, kind: int, own: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, ...]:
    """What ``best_moves`` takes: each word's counts by side and class, and an entry with its own class."""
    key, n = _summed(np.r_[word * 512 + side * 128 + d, np.arange(len(own)) * 512 + kind * 128 + own], np.r_[n, total])
    word, kinds = key >> 9, key >> 7 & 3
    return np.searchsorted(word, np.arange(len(own))), word, kinds, key & 127, n.astype(float), np.flatnonzero(kinds >= PLACED)


def best_moves(matrix: np.ndarray, classes: int, first, word, kind, d, n, own) -> np.ndarray:
    """The class in which each word's counts raise the likelihood most, other words staying where they are.

    Ties (empty classes) fall by the word's main context, so that words of one context go together and others elsewhere."""
    base = np.stack([matrix[:classes].T, matrix[:, :classes]])  # [side, neighbour's class, word's class]
    out, into = matrix[:classes].sum(1), matrix[:, :classes].sum(0)
    few = 16
    table = np.stack([_g(base + i) - _g(base) for i in range(few)])
    tie = 1e-6 * np.random.default_rng(7).random((2 * 128, classes))
    main = np.maximum.reduceat(np.where(kind < PLACED, n.astype(np.int64) * 256 + kind * 128 + d, 0), first) % 256
    gain = np.empty((len(own), classes))
    bound = np.r_[first, len(n)]

    def of_total(total: np.ndarray, more: np.ndarray) -> np.ndarray:
        few_more, which = np.unique(more, return_inverse=True)  # rare words have few different counts
        return (_g(total + few_more[:, None]) - _g(total))[which]

    cls, placed = d[own], kind[own] == PLACED
    for lo in range(0, len(own), 2_000):
        hi = min(lo + 2_000, len(own))
        at = slice(bound[lo], bound[hi])
        side, dd, c, w = kind[at], d[at], n[at], word[at]
        real = side < PLACED
        side = np.where(real, side, 0)
        c = np.where(real, c, 0.0)
        add = table[np.minimum(c, few - 1).astype(int), side, dd]
        big = np.flatnonzero(c >= few)
        add[big] = _g(base[side[big], dd[big]] + c[big, None]) - _g(base[side[big], dd[big]])
        r = np.bincount(w - lo, weights=c * (side == 0), minlength=hi - lo)
        li = np.bincount(w - lo, weights=c * (side == 1), minlength=hi - lo)
        part = np.add.reduceat(add, bound[lo:hi] - bound[lo], axis=0)
        part -= of_total(out, r) + of_total(into, li)
        part += tie[main[lo:hi]]
        # In its own class a placed word's counts are there already.
        a = cls[w]
        a = np.minimum(a, classes - 1)
        here = base[side, dd, a]
        stay = np.bincount(w - lo, weights=_g(here) - _g(np.maximum(here - c, 0)), minlength=hi - lo)
        a = np.minimum(cls[lo:hi], classes - 1)
        stay -= _g(out[a]) - _g(np.maximum(out[a] - r, 0)) + _g(into[a]) - _g(np.maximum(into[a] - li, 0))
        rows = np.flatnonzero(placed[lo:hi])
        part[rows, a[rows]] = stay[rows] + 1e-5
        gain[lo:hi] = part
    return gain.argmax(1)


def cluster(table: DataFrame, blocks: Blocks, pairs: np.ndarray, head: np.ndarray, totals: np.ndarray, sweeps: int,
            scratch: Scratch) -> tuple[DataFrame, np.ndarray, np.ndarray, np.ndarray]:
    """Classes of the blocks' words and of the frequent words, class x class counts and words per class.

    table: the blocks; pairs: bigrams over ranks, end token and others; head: first classes by rank.
    Class ``classes`` is the end token's, the one after it the fallback's."""
    classes, k, few = blocks.classes, blocks.k, blocks.few
    near = pairs[:few, :few]

    def among(head: np.ndarray) -> np.ndarray:
        """Class x class counts of frequent words and the end token."""
        m, c = np.zeros((k, k)), np.r_[head, classes]
        np.add.at(m, (c[:, None], c[None, :]), near)
        return m

    def together(now: DataFrame, run: Callable, schema: str, *columns: str) -> DataFrame:
        return table.select("block", *columns).groupBy("block").cogroup(now.groupBy("block")).applyInPandas(run, schema)

    def matrix(now: DataFrame, head: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        def run(block: pd.DataFrame, sent: pd.DataFrame) -> pd.DataFrame:
            m = blocks.cells(*blocks.entries(next(block.itertuples()), sent))
            at = np.flatnonzero(m)
            return pd.DataFrame({"cell": at, "n": m[at]})

        cells = together(now, run, "cell long, n double", "per", "code", "n", "counts").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()  # bounded
        flat = np.zeros(k * k + k + few * 256)
        flat[cells["cell"].to_numpy(np.int64)] = cells["n"].to_numpy(float)
        m, kinds, by_rank = flat[:k * k].reshape(k, k) + among(head), flat[k * k:k * k + k], flat[k * k + k:].reshape(few, 2, 128)
        c = np.r_[head, classes]
        np.add.at(m, c, by_rank[:, 0, :k])
        np.add.at(m.T, c, by_rank[:, 1, :k])
        return m, kinds + np.bincount(head, minlength=k), by_rank

    def moved_head(best: tuple, sweep: int, parts: int) -> np.ndarray:
        _, head, m, _, by_rank, _ = best
        free = np.flatnonzero((blocks.head.view(np.int64) >> 7) % parts == sweep % parts)
        if not len(free):
            return head
        lists = by_rank[:few - 1].copy()
        c = np.r_[head, classes]
        np.add.at(lists[:, 0].T, c, near[:few - 1].T)
        np.add.at(lists[:, 1].T, c, near[:, :few - 1])
        lists = lists[free]
        word, side, d = np.nonzero(lists)
        to = best_moves(m, classes, *packed_lists(word, side, d, lists[word, side, d].astype(np.int64), PLACED, head[free], totals[free]))
        out = head.copy()
        out[free] = to
        return out

    def moved(best: tuple, sweep: int, parts: int) -> DataFrame:
        """The blocks' classes after one sweep."""
        now, head, m = best[:3]

        def run(block: pd.DataFrame, sent: pd.DataFrame) -> pd.DataFrame:
            row = next(block.itertuples())
            own, w, rank, side, n, d = blocks.entries(row, sent)
            d = np.where(rank < few, np.r_[head, classes, 0][rank], d)
            free = (np.frombuffer(row.words, np.int64) >> 7) % parts == sweep % parts
            if free.any():
                place, on = np.cumsum(free) - 1, free[w]
                lists = packed_lists(place[w[on]], side[on], d[on], n[on], PLACED, own[free], _whole(row.total)[free])
                own[free] = best_moves(m, classes, *lists)
            return blocks.spread(row, own)

        return scratch.write(together(now, run, CLASSES, "words", "total", "per", "code", "n", "counts", "dest", "outs", "out"), f"classes{sweep + 1}")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """New words are placed by their frequent neighbours; a word without one keeps its start."""
        m, c = among(head), np.r_[head, classes]
        for b in batches:
            for row in b.itertuples():
                own = np.frombuffer(row.start, np.uint8).astype(np.int64)
                w, code, n = np.repeat(np.arange(len(own)), _whole(row.per)), _whole(row.code), _whole(row.n)
                on = code >> 1 < few
                lists = packed_lists(w[on], code[on] & 1, c[code[on] >> 1], n[on], NEW, own, _whole(row.total))
                lone = np.diff(np.r_[lists[0], len(lists[1])]) == 1
                yield blocks.spread(row, np.where(lone, own, best_moves(m, classes, *lists)))

    now = scratch.write(table.select("block", "start", "total", "per", "code", "n", "dest", "outs", "out").mapInPandas(place, CLASSES), "classes0")
    best, parts = None, 2
    for sweep in range(sweeps + 1):
        m, kinds, by_rank = matrix(now, head)
        if best is None or likelihood(m) > likelihood(best[2]):
            old = best
            best = (now, head, m, kinds, by_rank, sweep)
            scratch.drop(*[f"classes{old[5]}"] if old else [])
        else:
            parts *= 4
            scratch.drop(f"classes{sweep}")  # only the best classes are read again
        if sweep < sweeps:
            now, head = moved(best, sweep, parts), moved_head(best, sweep, parts)
    now, head, m, kinds = best[:4]

    def known(block: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        return block.assign(cls=own["cls"].iloc[0])

    got = table.select("block", "words", "total").groupBy("block").cogroup(now.where(F.col("src") == OWN).groupBy("block")).applyInPandas(
        known, "block int, words binary, total binary, cls binary")
    got = scratch.write(got, f"classes{sweeps + 1}")
    scratch.drop(f"classes{best[5]}")
    return got, head, m, kinds


def score_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", held_out: str = "held_out",
                    frequent: float = 5e-4, classes: int = 64, sweeps: int = 4) -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 of the text's probability)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "lm")
    kind = docs.schema[key].dataType.simpleString()
    count = bucket_count(docs, text, PER_BLOCK)
    source = docs.select(F.col(key).alias("k"), F.col(held_out).alias("held"), F.col(text).alias("t"))
    read = source.mapInArrow(lambda b: read_chunks(b, frequent), f"chunk long, k array<{kind}>, held array<boolean>, size binary, ids binary, "
                             "h binary, crc binary, n binary, often array<binary>, tokens long, texts long")
    # Written once, so that a lost task cannot number chunks or their rows anew.
    rows = scratch.write_bucketed(read, "rows", "chunk", count)
    sums = rows.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n"), F.coalesce(F.sum("texts"), F.lit(0)).alias("t")).first()
    texts, n_all = int(sums["t"]), int(sums["n"]) + int(sums["t"])
    least = frequent * max(n_all, 1)
    dealt = Blocks(np.zeros(0, np.uint64), count, classes)

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                h, crc, n = np.frombuffer(r.h, np.uint64), np.frombuffer(r.crc, np.uint32), _whole(r.n)
                h, crc, n = h[n > 0], crc[n > 0], n[n > 0]
                of = dealt.of(h)
                order = np.argsort(of, kind="stable")
                bounds = np.searchsorted(of[order], np.arange(count + 1))
                parts = [order[lo:hi] for lo, hi in zip(bounds[:-1], bounds[1:])]
                yield pd.DataFrame([(p, h[at].tobytes(), crc[at].tobytes(), _planes(n[at])) for p, at in enumerate(parts) if len(at)],
                                   columns=["block", "h", "crc", "n"])

    def vocabulary(part: pd.DataFrame) -> pd.DataFrame:
        """The block's frequent words, and in a row without hash the number of its words: equal hashes are told apart by crc32."""
        h, crc, n = (np.concatenate(x) for x in ([np.frombuffer(x, np.uint64) for x in part["h"]], [np.frombuffer(x, np.uint32) for x in part["crc"]],
                                                 [_whole(x) for x in part["n"]]))
        order = np.lexsort((crc, h))
        h, crc, n = h[order], crc[order], n[order]
        first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (crc[1:] != crc[:-1])])
        n = np.add.reduceat(n, first)
        many = n >= least
        return pd.DataFrame({"v": [len(first), *[0] * many.sum()], "h": [0, *h[first][many].view(np.int64)], "n": [0, *n[many]]})

    counted = rows.select("h", "crc", "n").mapInPandas(words, "block int, h binary, crc binary, n binary").groupBy("block").applyInPandas(
        vocabulary, "v long, h long, n long").collect()  # one row a block and the frequent words
    v_all = sum(r["v"] for r in counted) + (1 if texts else 0)
    often = {r["h"]: r["n"] for r in counted if not r["v"]}

    def named(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            h = _hashes([bytes(w) for w in b["w"]]).view(np.int64)
            yield pd.DataFrame({"w": b["w"], "h": h})[np.isin(h, list(often))]

    names = rows.select(F.explode("often").alias("w")).distinct().mapInPandas(named, "w binary, h long").collect()  # the frequent words
    top = sorted({r["h"]: bytes(r["w"]) for r in names}.items(), key=lambda r: (-often[r[0]], r[1]))
    totals = np.array([often[h] for h, _ in top], np.int64)
    blocks = Blocks(np.array([h for h, _ in top], np.int64).view(np.uint64), count, classes)

    def chunk(r) -> tuple[np.ndarray, ...]:
        return _whole(r.ids), _whole(r.size), np.array([x is not None and not x for x in r.held], bool), np.frombuffer(r.h, np.uint64)

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                n = blocks.symbol_pairs(*chunk(r))
                at = np.flatnonzero(n)
                yield pd.DataFrame({"cell": at, "n": n[at].astype(np.int64)})

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                for row in blocks.send(*chunk(r), np.frombuffer(r.crc, np.uint32)):
                    yield pd.DataFrame([row], columns=sent)

    def build(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([blocks.build(list(part.itertuples(index=False, name=None)))])

    symbols = blocks.few + 1
    sparse = rows.select("ids", "size", "held", "h").mapInPandas(pairs, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()  # bounded side
    big = np.zeros(symbols * symbols)
    big[sparse["cell"].to_numpy(np.int64)] = sparse["n"].to_numpy(float)
    big = big.reshape(symbols, symbols)
    # First classes of the frequent words; all other words are one symbol here.
    head = exchange(big, len(top), classes, sweeps)[:len(top)]
    sent = ["block", "words", "start", "per", "code", "n", "others"]
    table = rows.select("ids", "size", "held", "h", "crc").mapInPandas(
        send, "block int, words binary, start binary, per binary, code binary, n binary, others binary").groupBy("block").applyInPandas(
        build, "block int, words binary, total binary, start binary, per binary, code binary, n binary, src binary, counts binary, "
               "dest binary, outs binary, out binary")
    table = scratch.write_bucketed(table, "bigrams", "block", count)
    known, head, n_cls, kinds = cluster(table, blocks, big, head, totals, sweeps, scratch)
    scratch.drop("bigrams")
    k, unseen = classes + 2, classes + 1
    # Transitions: the class bigram backed off to the class frequency; unseen words keep the mass that the unigram gives them.
    base_room = float(np.log10(n_all + ADD * (v_all + 1)))
    new = ADD / (n_all + ADD * (v_all + 2))
    unigram = n_cls.sum(0) + ADD
    unigram[unseen] = 0
    unigram /= unigram.sum()
    step = (n_cls + 10 * unigram) / (n_cls.sum(1, keepdims=True) + 10) * (1 - new)
    step[:, unseen] = new
    step = np.log10(step)
    room = np.log10(n_cls.sum(0)[:classes] + ADD * np.maximum(kinds[:classes], 1))
    room = np.r_[room, np.zeros(k - classes)]
    base_end = float(np.log10(texts + ADD)) - base_room

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                h = np.frombuffer(r.h, np.uint64)
                of = blocks.of(h)
                yield pd.DataFrame([(int(p), r.chunk, h[of == p].tobytes()) for p in np.unique(of)], columns=["block", "chunk", "h"])

    def answer(block: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        have, total, cls = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint8)
        for r in block.itertuples():
            have, total, cls = np.frombuffer(r.words, np.uint64), _whole(r.total), np.frombuffer(r.cls, np.uint8)
        total, cls = np.r_[total, 0], np.r_[cls, np.uint8(unseen)]
        out = []
        for r in asked.itertuples():
            h = np.frombuffer(r.h, np.uint64)
            at = np.searchsorted(have, h)
            found = at < len(have)
            found[found] = have[at[found]] == h[found]
            at = np.where(found, at, len(have))
            out.append((r.chunk, r.block, cls[at].tobytes(), _planes(total[at])))
        return pd.DataFrame(out, columns=["chunk", "block", "cls", "n"])

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for r in left.to_batches():
            for i in range(r.num_rows):
                get = lambda c: r.column(c)[i].as_py()  # noqa: E731,B023
                h, ids, sizes = np.frombuffer(get("h"), np.uint64), _whole(get("ids")), _whole(get("size"))
                of, s, n = blocks.of(h), np.full(len(h), unseen), np.zeros(len(h), np.int64)
                for p, c, m in zip(*(right.column(c).to_pylist() for c in ("block", "cls", "n"))):
                    s[of == p], n[of == p] = np.frombuffer(c, np.uint8), _whole(m)
                rank = blocks.ranks(h, len(top))
                s, n = np.where(rank < len(top), np.r_[head, 0][rank], s), np.where(rank < len(top), np.r_[totals, 0][rank], n)
                logc, old = np.log10(n + ADD), n > 0
                all_rows = np.ones(len(sizes), bool)
                seq, begin = _sequence(ids, sizes, len(h), all_rows)
                cls = np.r_[s, classes][seq]
                path = step[np.r_[classes, cls[:-1]], cls] + np.r_[np.where(old, logc - room[s], 0.0), 0.0][seq]
                sums = [np.add.reduceat(x, begin) for x in (np.r_[old, texts > 0][seq].astype(np.int64), np.r_[logc - base_room, base_end][seq], path)]
                out.append(pa.table({"k": r.column("k")[i].values, "held": r.column("held")[i].values, "n": sizes + 1,
                                     "known": sums[0], "base": sums[1], "score": sums[2]}))
        return pa.concat_tables(out)

    # Words of a chunk are asked for once a block; those not in training find no class.
    asked = rows.select("chunk", "h").mapInPandas(ask, "block int, chunk long, h binary")
    answers = known.groupBy("block").cogroup(asked.groupBy("block")).applyInPandas(answer, "chunk long, block int, cls binary, n binary")
    out = rows.select("chunk", "k", "held", "size", "ids", "h").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        score, f"k {kind}, held boolean, n long, known long, base double, score double")
    return out.select(F.col("k").alias(key), F.col("held").alias("held_out"), F.col("n").alias("n_tokens"),
                      F.col("known").alias("n_known"), F.lit(n_all).cast("long").alias("train_tokens"),
                      F.col("base").alias("base_score"), "score")
