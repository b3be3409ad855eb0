"""Operator 2: sum-of-squares online packing of token ids into fixed windows.

Each task tokenises its share of the documents once and packs on the way: the level array
``open[h]`` holds the windows filled to h tokens, and a piece goes to the level (0: a new window)
that makes the sum of squared counts of partly filled windows least.  Documents longer than a window
are cut.  Windows still open at the end of a task (or beyond ``max_open``, which bounds memory) are drained: their
ids are cut anew into full windows, and the last rest into windows of power-of-two lengths, which need no padding.

No shuffle: state is one task's.  A lost task repeats the same split and returns the same rows.
Null and empty text is the end id alone.  Repeated rows are packed once each.  An empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colonnade.llm.text import portable

_SPECIAL = "<|endoftext|>"


def encoder(vocabulary: str = "byte_bpe_50k"):
    """text -> ids.  The rank file of the same vocabulary is about three times as fast as the JSON
    file and gives the same ids (tested); texts that hold the special token go to the latter."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    slow = []

    def encode(text: str) -> list[int]:
        if _SPECIAL in text:
            from tokenizers import Tokenizer
            if not slow:
                slow.append(Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json")))
            return slow[0].encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)
    return encode


class LevelPacker:
    """Sum-of-squares packing; yields (doc, start, ids, doc_tokens, window, offset)."""

    def __init__(self, window: int, max_open: int = 2048):
        self.window, self.max_open = window, max_open
        self.count = np.zeros(window + 1, dtype=np.int64)  # open windows per fill level
        self.open: list[list] = [[] for _ in range(window + 1)]
        self.n_open = self.made = 0

    def _new(self) -> int:
        self.made += 1
        return self.made - 1

    def level_for(self, size: int) -> int:
        """Level h that makes the change of the sum of squares least; ties go to the fullest window."""
        room = self.window - size
        c = self.count
        after = 2 * c[size:size + room + 1].copy() + 1  # a window appears at h + size
        after[room] = 0  # a full window is not counted
        after[1:] -= 2 * c[1:room + 1] - 1  # and one leaves h
        after[1:][c[1:room + 1] == 0] = np.iinfo(np.int64).max
        return int(room - np.argmin(after[::-1]))

    def add(self, doc, ids: np.ndarray) -> Iterator[tuple]:
        total, w = len(ids), self.window
        for s in range(0, total - total % w, w):
            yield doc, s, ids[s:s + w], total, self._new(), 0
        size = total % w
        if not size:
            return
        piece = (doc, total - size, ids[total - size:], total)
        h = self.level_for(size)
        if h:
            held = self.open[h].pop()
            self.count[h] -= 1
            self.n_open -= 1
        else:
            held = []
        held.append(piece)
        if h + size == w:
            yield from self._emit(held)
        else:
            self.open[h + size].append(held)
            self.count[h + size] += 1
            self.n_open += 1
            if self.n_open > self.max_open:
                yield from self.drain(rest=False)

    def _emit(self, held: list) -> Iterator[tuple]:
        seq, at = self._new(), 0
        for doc, start, ids, total in held:
            yield doc, start, ids, total, seq, at
            at += len(ids)

    def drain(self, rest: bool = True) -> Iterator[tuple]:
        """Cut the open windows' pieces anew; without ``rest`` the last partial window stays open."""
        pieces = [p for level in self.open for held in level for p in held]
        self.open = [[] for _ in range(self.window + 1)]
        self.count[:] = 0
        self.n_open = 0
        left = sum(len(p[2]) for p in pieces)
        held, fill = [], 0
        size = 0
        for doc, start, ids, total in pieces:
            while len(ids):
                if not fill:
                    size = self.window if left >= self.window else (1 << (left.bit_length() - 1) if rest else self.window)
                take = min(size - fill, len(ids))
                held.append((doc, start, ids[:take], total))
                ids, start, fill, left = ids[take:], start + take, fill + take, left - take
                if fill == size:
                    yield from self._emit(held)
                    held, fill = [], 0
        if held:
            self.open[fill].append(held)
            self.count[fill] += 1
            self.n_open = 1


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 2048,
                   end_id: int = 1, with_ids: bool = False, encode_factory=encoder) -> DataFrame:
    """One row a piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids)."""
    kind = docs.schema[key].dataType.simpleString()
    schema = (f"k {portable(kind)}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
              + (", ids array<int>" if with_ids else ""))
    names = ["k", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, packer = encode_factory(), LevelPacker(window)
        base = TaskContext.get().partitionId() << 40

        def frame(pieces: list[tuple]) -> pd.DataFrame:
            out = pd.DataFrame([(d, s, len(i), zlib.crc32(i.astype("<u4").tobytes()), t, base + q, o)
                                for d, s, i, t, q, o in pieces], columns=names)
            if with_ids:
                out["ids"] = [p[2].astype(np.int32) for p in pieces]
            return out

        for b in batches:
            done: list[tuple] = []
            for doc, t in zip(b["k"], b["t"]):
                ids = encode(t) if t else []
                done.extend(packer.add(doc, np.array([*ids, end_id], dtype=np.uint32)))
                if len(done) > 20_000:
                    yield frame(done)
                    done = []
            yield frame(done)
        yield frame(list(packer.drain()))

    packed = docs.select(F.col(key).cast(portable(kind)).alias("k"), F.col(text).alias("t")).mapInPandas(run, schema)
    return packed.select(F.col("k").cast(kind).alias(key), *packed.columns[1:])
