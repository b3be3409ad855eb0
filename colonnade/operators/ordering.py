"""Sorts, limits, top-k, set operations, range buckets and sampling
(O1-O6, U1-U3, K3, R1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colonnade.functions.scalars import RANGE_BOUNDS, string_order_bucket


def sort_by(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    """O1 / O2: a total order (range-partitioned sort)."""
    return df.orderBy(*cols)


def top_k(df: DataFrame, score: str, k: int, tie_keys: Sequence[str], ascending_output: bool = False) -> DataFrame:
    """The ``k`` rows with the highest ``score`` (ties: smaller keys).

    ``orderBy(..).limit(k)`` plans ``TakeOrderedAndProject``: each task keeps
    its own top ``k`` and only those reach the final merge, never a full sort.
    """
    top = df.orderBy(F.col(score).desc(), *[F.col(c).asc() for c in tie_keys]).limit(k)
    return top.orderBy(F.col(score).asc(), *[F.col(c).desc() for c in tie_keys]) if ascending_output else top


def union_all(*frames: DataFrame, allow_missing: bool = False) -> DataFrame:
    """Union by column name (positional union silently mixes columns)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=allow_missing)
    return out


def distinct_rows(df: DataFrame) -> DataFrame:
    """U3."""
    return df.distinct()


# Target rows per partition when ``parts_per_bucket='auto'``.
BUCKET_PART_ROWS = 2_000_000


def range_bucket_partition(df: DataFrame, key: str, bounds: Sequence[str] = RANGE_BOUNDS,
                           case_insensitive: bool = False, out: str = "bucket",
                           parts_per_bucket: int | str = 1) -> DataFrame:
    """Route rows to partitions by string range of ``key``.

    Bucket ``i`` (``len(bounds)+1`` buckets) owns partitions
    ``[i*parts_per_bucket, (i+1)*parts_per_bucket)``; with the default of one
    partition per bucket, partition ``i`` holds exactly bucket ``i``, the
    layout of five reducers.  For large inputs raise ``parts_per_bucket`` so a
    bucket is spread over several tasks by key hash (all rows of a key stay
    together).  ``'auto'`` sizes it from the largest bucket (one aggregate over
    the key column) so that no partition gets much more than
    ``BUCKET_PART_ROWS`` rows, however many rows one bucket holds.  Rows are
    sorted by key inside each partition, like reducer output.
    """
    with_bucket = df.withColumn(out, string_order_bucket(key, bounds, case_insensitive))
    if parts_per_bucket == "auto":
        largest = with_bucket.groupBy(out).count().agg(F.max("count")).first()[0] or 0
        parts_per_bucket = max(1, -(-int(largest) // BUCKET_PART_ROWS))
    m = int(parts_per_bucket)
    pid = F.col(out) * m + (F.pmod(F.xxhash64(F.col(key)), F.lit(m)) if m > 1 else F.lit(0))
    return (with_bucket.repartitionById((len(bounds) + 1) * m, pid.cast("int"))
            .sortWithinPartitions(key))


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 42, with_replacement: bool = False) -> DataFrame:
    """Row sample; arguments by keyword so the seed is really used."""
    return df.sample(withReplacement=with_replacement, fraction=fraction, seed=seed)


def key_digest(keys: Sequence[str], seed: int = 42) -> Column:
    """MD5 digits of seed and keys (null: empty), the same in every engine that has MD5."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]))


def hash_sample(df: DataFrame, keys: str | Sequence[str], fraction: float, seed: int = 42) -> DataFrame:
    """R1 (reproducible): rows whose key digest lies in the first ``fraction`` of all digests -- the same rows on every
    run, partitioning and engine; a larger fraction holds the smaller one's rows."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if fraction >= 1:
        return df
    return df.filter(F.substring(key_digest(keys, seed), 1, 8) < F.lit(f"{int(max(0.0, fraction) * 2 ** 32):08x}"))


def fixed_size_sample(df: DataFrame, keys: Sequence[str], k: int, seed: int = 42) -> DataFrame:
    """R1 (fixed size): the ``k`` rows with the smallest key digests (ties: smaller keys).  Every task keeps its own ``k``
    and only those are merged."""
    return df.orderBy(key_digest(keys, seed), *keys).limit(k)
