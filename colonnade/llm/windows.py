"""Which word windows of a text start anywhere else: hashed, dealt to buckets, counted, answered.

A task cuts its texts into chunks of about ``chunk`` window hashes (one long text may be more).  A hash that starts
twice within its chunk is settled there and goes to its bucket once, however often it starts; the others go
with their place in the chunk.  A bucket sees a hash at most once a chunk, marks those that come from two chunks
or start twice in one, and answers a chunk with the places.  The places of a chunk meet once
more and become spans of words by row, so the text side needs no hashes again.

What travels is 12 bytes a window that is alone in its chunk, 8 a repeated one, and less for the answers; rows between
the steps are one a (chunk, bucket).  Chunks are named by their rows; a chunk whose rows came in another order when a
lost task ran again is found out and raises.  Windows are told apart by 64-bit hashes alone: a window is taken for
another one of n with a chance of n / 2^64 (5e-7 at 10^13 windows).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colonnade.session import default_parallelism

MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHashes:
    """64-bit hash per word with a bounded cache (a cache only: misses are hashed again)."""

    def __init__(self, most: int = 400_000):
        self.known: dict[bytes, int] = {}
        self.most = most

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > self.most:
            known.clear()
        try:
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w)
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def rolling(h: np.ndarray, n: int, base: int = 0xD1342543DE82EF95) -> np.ndarray:
    """Rabin-Karp hash (mod 2^64, odd base) of every n-word window; windows of twice the length come from
    two of the length, so n words take log n array steps.  The result is mixed once more."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    total = len(h) - n + 1
    out, have = np.zeros(total, np.uint64), 0
    power, size, block = base, 1, h
    while True:
        if n & size:
            # append this block behind what is already covered: shift, then add
            out = out * np.uint64(power) + block[have:have + total]
            have += size
        if have == n:
            break
        block = block[:len(block) - size] * np.uint64(power) + block[size:]
        power = power * power % (1 << 64)
        size *= 2
    out ^= out >> np.uint64(31)
    out *= MIX
    out ^= out >> np.uint64(29)
    return out


def bucket_count(docs: DataFrame, text: str, per_bucket: int) -> int:
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    return max(default_parallelism(docs.sparkSession), -(-size // (6 * per_bucket)))


def repeated_spans(docs: DataFrame, text: str, hashes: Callable[[str], np.ndarray], buckets: int, window: int,
                   chunk: int = 3_000_000) -> DataFrame:
    """k1, k2 -> spans: array<binary>, for rows (named by two longs ``k1, k2``) with a repeated window.

    A span list holds uint32 pairs (first word, word behind the last), ascending and apart.  Every start counts, so
    rows that are equal in full repeat each other; they come once."""

    def pack(held: list) -> pd.DataFrame:
        keys = np.array([(k1, k2) for k1, k2, _ in held], np.int64)
        sizes = np.array([len(h) for *_, h in held], np.uint32)
        h = np.concatenate([h for *_, h in held])
        block = xxhash.xxh3_64_intdigest(keys.tobytes()) >> 1
        order = np.argsort(h, kind="stable")
        ranked = h[order]
        first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
        alone = np.diff(np.r_[first, len(h)]) == 1
        asked = np.sort(order[first[alone]])
        known = np.ones(len(h), bool)  # repeated within the chunk: no question left
        known[asked] = False
        told = ranked[first[~alone]]
        ask_at, tell_at = (h[asked] % np.uint64(buckets)).astype(np.int64), (told % np.uint64(buckets)).astype(np.int64)
        by_ask, by_tell = np.argsort(ask_at, kind="stable"), np.argsort(tell_at, kind="stable")
        asked, told = asked[by_ask], told[by_tell]
        edges = np.arange(buckets + 1)
        a, t = np.searchsorted(ask_at[by_ask], edges), np.searchsorted(tell_at[by_tell], edges)
        rows = [(block % buckets, block, b"", b"", b"", keys.tobytes(), sizes.tobytes(), np.packbits(known).tobytes())]
        for p in np.flatnonzero((np.diff(a) > 0) | (np.diff(t) > 0)):
            at = asked[a[p]:a[p + 1]]
            rows.append((int(p), block, np.diff(at, prepend=0).astype(np.uint32).tobytes(), h[at].tobytes(),
                         told[t[p]:t[p + 1]].tobytes(), b"", b"", b""))
        return pd.DataFrame(rows, columns=["bucket", "block", "at", "asked", "told", "owners", "sizes", "known"])

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for b in batches:
            for k1, k2, t in zip(b["k1"], b["k2"], b["t"]):
                h = hashes(t)
                if len(h):
                    held.append((k1, k2, h))
                    size += len(h)
                if size >= chunk:
                    yield pack(held)
                    held, size = [], 0
        if held:
            yield pack(held)

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        asked = [np.frombuffer(x, np.uint64) for x in pdf["asked"]]
        told = np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["told"]])
        every = np.concatenate(asked)
        _, which, n = np.unique(np.concatenate([every, told]), return_inverse=True, return_counts=True)
        n[which[len(every):]] = 2  # told hashes start twice at least
        hit = n[which[:len(every)]] > 1
        rows, lo = [], 0
        for block, at, h, owners, sizes, known in zip(pdf["block"], pdf["at"], asked, pdf["owners"], pdf["sizes"], pdf["known"]):
            yes = hit[lo:lo + len(h)]
            lo += len(h)
            if owners:
                rows.append((block, b"", owners, sizes, known))
            elif yes.any():
                places = np.cumsum(np.frombuffer(at, np.uint32), dtype=np.int64)[yes]
                rows.append((block, np.diff(places, prepend=0).astype(np.uint32).tobytes(), b"", b"", b""))
        return pd.DataFrame(rows, columns=["block", "at", "owners", "sizes", "known"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        named = pdf[pdf["owners"].str.len() > 0]
        if named.empty:
            raise RuntimeError("a chunk came back in another order after a lost task; run the job again")
        keys = np.frombuffer(named["owners"].iloc[0], np.int64).reshape(-1, 2)
        sizes = np.frombuffer(named["sizes"].iloc[0], np.uint32).astype(np.int64)
        ends = np.cumsum(sizes)
        begins = ends - sizes
        hit = np.unpackbits(np.frombuffer(named["known"].iloc[0], np.uint8), count=int(ends[-1])).astype(bool)
        for at in pdf["at"]:
            hit[np.cumsum(np.frombuffer(at, np.uint32), dtype=np.int64)] = True
        at = np.flatnonzero(hit)
        if not len(at):
            return pd.DataFrame([], columns=["k1", "k2", "spans"])
        who = np.searchsorted(begins, at, side="right") - 1
        # windows that touch or overlap make one span of words
        new = np.flatnonzero(np.r_[True, (at[1:] > at[:-1] + window) | (who[1:] != who[:-1])])
        owner = who[new]
        spans = np.stack([at[new] - begins[owner], at[np.r_[new[1:], len(at)] - 1] - begins[owner] + window], 1).astype(np.uint32)
        cut = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        return pd.DataFrame([(*keys[owner[s]].tolist(), spans[s:e].tobytes()) for s, e in zip(cut, [*cut[1:], len(owner)])],
                            columns=["k1", "k2", "spans"])

    sent = docs.select("k1", "k2", F.col(text).alias("t")).mapInPandas(
        send, "bucket int, block long, at binary, asked binary, told binary, owners binary, sizes binary, known binary")
    answers = sent.groupBy("bucket").applyInPandas(count, "block long, at binary, owners binary, sizes binary, known binary")
    return (answers.groupBy("block").applyInPandas(merge, "k1 long, k2 long, spans binary")
            .groupBy("k1", "k2").agg(F.collect_set("spans").alias("spans")))
