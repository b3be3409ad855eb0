"""Word and scratch helpers shared by the corpus operators.

A word is ``[^\\x20\\x09-\\x0D]+`` everywhere; null text has no words.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.session import default_parallelism, scratch_path

SPACE = " \t\n\x0b\x0c\r"


def words_col(text: Column) -> Column:
    """Array of words, JVM-side: separators become one character, empty pieces go."""
    flat = F.translate(F.coalesce(text, F.lit("")), SPACE[1:], " " * (len(SPACE) - 1))
    return F.array_remove(F.split(flat, " ", -1), "")


def byte_words(text: str | None, lower: bool = False) -> list[bytes]:
    """Words in UTF-8: splitting and lowering bytes knows the six ASCII separators and A-Z only, as the rule does."""
    raw = text.encode("utf-8", "surrogatepass") if text else b""
    return (raw.lower() if lower else raw).split()


_INTEGERS = ("tinyint", "smallint", "int", "bigint")


def portable(kind: str) -> str:
    """The type in which a column of type ``kind`` passes through pandas unchanged: integers next to nulls would become
    floating there, so they travel as text."""
    return "string" if kind in _INTEGERS else kind


def materialise(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write below the shared checkpoint folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables written below the shared checkpoint folder that go once what follows from them is written."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        self.paths: dict[str, str] = {}

    def write(self, df: DataFrame, step: str, codec: str = "zstd") -> DataFrame:
        path = scratch_path(self.spark, f"{self.name}-{step}")
        df.write.option("compression", codec).parquet(path)
        self.drop(step)
        self.paths[step] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def write_bucketed(self, df: DataFrame, step: str, column: str, buckets: int, codec: str = "zstd") -> DataFrame:
        """As ``write``, in buckets: groups by ``column`` are read together without a shuffle."""
        path = scratch_path(self.spark, f"{self.name}-{step}")
        name = f"{self.name}_{step}_{uuid.uuid4().hex}"
        df.write.option("compression", codec).option("path", path).bucketBy(buckets, column).format("parquet").saveAsTable(name)
        self.drop(step)
        self.paths[step] = path
        out = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")  # the name only: the files lie in a folder given, and ``out`` knows them
        return out

    def drop(self, *steps: str) -> None:
        """Delete the tables; no frame that reads them may be used any more."""
        for step in steps:
            if path := self.paths.pop(step, None):
                jvm = self.spark._jvm
                where = jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def partitions(spark: SparkSession, rows: int, per_task: int) -> int:
    return max(default_parallelism(spark), -(-rows // per_task))
