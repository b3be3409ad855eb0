"""Operator 6: substring dedup by Rabin-Karp hashes of every fixed-length word window.

Window hashes are counted in Spark; the windows that start more than once are merged into maximal
removal intervals of words.  All copies of a repeated passage go, judged on the input.

Null and empty texts have no words.  Rows repeated whole repeat each other's windows, as one text under several or null ids
does.  Texts shorter than a window stay whole; a very long text is hashed whole, in its own chunk.  Empty tables give no rows; only the key and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colonnade.llm.text import Scratch, byte_words, portable
from colonnade.llm.windows import WordHashes, bucket_count, repeated_spans, rolling


def apart(found) -> list[tuple[int, int]]:
    """The spans of one row's lists (one, unless a lost task ran again), ascending and apart."""
    every = [] if found is None else sorted((s, e) for x in found for s, e in np.frombuffer(x, np.uint32).reshape(-1, 2).tolist())
    out: list[tuple[int, int]] = []
    for s, e in every:
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 35,
                   per_bucket: int = 1_500_000, with_text: bool = False) -> DataFrame:
    """key, n_words, n_removed, intervals (array<struct<start,end>> in words), kept_sha256 (and the kept text)."""
    kind = docs.schema[key].dataType.simpleString()
    buckets = bucket_count(docs, text, per_bucket)
    word_hash = WordHashes()

    def hashes(t: str | None) -> np.ndarray:
        ws = byte_words(t)
        return rolling(word_hash(ws), window) if len(ws) >= window else np.zeros(0, np.uint64)

    rows = docs.select(F.col(key).cast(portable(kind)).alias("k"), F.col(text).alias("t"),
                       F.xxhash64(F.col(key), F.col(text)).alias("k1"), F.xxhash64(F.lit("second"), F.col(text), F.col(key)).alias("k2"))
    told = Scratch(docs.sparkSession, "repeats").write(repeated_spans(rows, "t", hashes, buckets, window), "spans")
    joined = rows.join(told, ["k1", "k2"], "left").select("k", "t", "spans")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for t, found in zip(b["t"], b["spans"]):
                ws = byte_words(t)
                spans = apart(found)
                kept, at = [], 0
                for s, e in spans:
                    kept.extend(ws[at:s])
                    at = e
                kept.extend(ws[at:])
                body = b" ".join(kept)
                out.append((len(ws), len(ws) - len(kept), [{"start": s, "end": e} for s, e in spans],
                            hashlib.sha256(body).hexdigest(), *([body.decode("utf-8", "surrogatepass")] if with_text else [])))
            frame = pd.DataFrame(out, columns=["n_words", "n_removed", "intervals", "kept_sha256", *(["kept"] if with_text else [])])
            frame.insert(0, "k", b["k"].array)
            yield frame

    schema = (f"k {portable(kind)}, n_words long, n_removed long, intervals array<struct<start:long,`end`:long>>, kept_sha256 string"
              + (", kept string" if with_text else ""))
    done = joined.mapInPandas(cut, schema)
    return done.select(F.col("k").cast(kind).alias(key), *done.columns[1:])
