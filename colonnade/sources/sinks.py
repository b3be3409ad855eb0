"""Sinks and bounded actions (K1-K9).

Writers run on the executors; nothing is routed through the driver.  Paths are
arguments and can be any Hadoop file-system URI (S8).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colonnade.functions.scalars import RANGE_BOUNDS, string_order_bucket


def write_csv(df: DataFrame, path: str, header: bool = False, single_file: bool = False,
              mode: str = "overwrite", order_by: Sequence[str] = (), **options: str) -> None:
    """K1 / K4: CSV folder, one file per partition, or a single part file.

    ``single_file`` shuffles the finished rows into one task (sorted there by ``order_by``); what makes them keeps its
    parallelism.  Use it for small reports.
    """
    out = _one_part(df, order_by) if single_file else df
    writer = out.write.mode(mode).option("header", header)
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.csv(path)


def _one_part(df: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    one = df.repartition(1)
    return one.sortWithinPartitions(*order_by) if order_by else one


def kv_lines(df: DataFrame, key_cols: Sequence[str], value_col: str, key_sep: str = ",",
             sep: str = "\t", sort_within: bool = True) -> DataFrame:
    """``key<TAB>value`` lines, keys sorted inside each partition
    (what a MapReduce reducer writes).  Returns the single ``value`` column."""
    keyed = df.select(F.concat_ws(key_sep, *[F.col(c).cast("string") for c in key_cols]).alias("_k"),
                      F.col(value_col).cast("string").alias("_v"))
    if sort_within:
        keyed = keyed.sortWithinPartitions("_k")
    return keyed.select(F.concat_ws(sep, "_k", "_v").alias("value"))


def write_kv_text(df: DataFrame, path: str, key_cols: Sequence[str], value_col: str,
                  key_sep: str = ",", sep: str = "\t", mode: str = "overwrite") -> None:
    kv_lines(df, key_cols, value_col, key_sep, sep).write.mode(mode).text(path)


def write_format(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                 partition_by: Sequence[str] | None = None) -> None:
    """K7: generic final write."""
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_range_buckets(df: DataFrame, path: str, key: str, bounds: Sequence[str] = RANGE_BOUNDS, case_insensitive: bool = False,
                        bucket: str = "bucket", parts: int | None = None, mode: str = "overwrite") -> None:
    """K3 as files: one folder per range bucket (``bucket=i``), keys sorted inside each file.

    Rows are range-partitioned by (bucket, key, row hash), so partitions are of like size whatever the buckets': a large
    bucket, or one key with many rows, is written by many tasks, and a folder's files follow one another in key order.
    ``parts``: number of tasks (default: the session's shuffle partitions, coalesced by size)."""
    tagged = df.withColumn(bucket, string_order_bucket(key, bounds, case_insensitive))
    salt = F.xxhash64(*[c for c, t in df.dtypes if not t.startswith("map")])
    spread = tagged.repartitionByRange(*([parts] if parts else []), F.col(bucket), F.col(key), salt)
    spread.sortWithinPartitions(bucket, key).write.mode(mode).partitionBy(bucket).csv(path)


def write_report(metrics: DataFrame, path: str, fmt: str = "json") -> None:
    """K6: a small (metric, value) frame written as one file."""
    write_format(_one_part(metrics), path, fmt)


def fetch_limited(df: DataFrame, n: int) -> DataFrame:
    """K8: bound a result before it is fetched (``limit`` plans a
    ``CollectLimit``/``TakeOrderedAndProject``, never a full collect)."""
    return df.limit(n)


def persist_for_reuse(df: DataFrame) -> DataFrame:
    """K9: keep an input that several actions read (ML fits).  Memory first,
    spilling to disk; lost blocks are recomputed from lineage."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
