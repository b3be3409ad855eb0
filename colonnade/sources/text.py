"""Whitespace-separated n-gram lines (``word year occurrences volumes`` or
``word1 word2 year occurrences volumes``), normalised to one layout (U2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def classify_ngram_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Tokenise lines, normalise 1-grams and 2-grams to ``(word1, word2, year, occurrences, volumes)``, and say in ``reject``
    what is wrong with the others: ``arity`` (not four or five tokens; no fields), ``number`` (occurrences or volumes do
    not parse and are null), else ``none``; ``line`` is the line of a reject.

    Tokens come from ``split(rtrim(line), '\\s+')``: trailing blanks are ignored
    and a leading blank yields one empty first token, which is how the original
    MapReduce mapper tokenises (D2).
    """
    toks = F.split(F.rtrim(F.col(column)), r"\s+")
    shaped, two = F.coalesce(F.col("_n").isin(4, 5), F.lit(False)), F.col("_n") == 5

    def field(one: int, both: int) -> Column:
        return F.when(shaped, F.get("_t", F.when(two, F.lit(both)).otherwise(F.lit(one))))

    fields = lines.select(F.col(column).alias("line"), toks.alias("_t"), F.size(toks).alias("_n")).select(
        "line", F.col("_n"),
        field(0, 0).alias("word1"), F.when(two, F.get("_t", 1)).alias("word2"), field(1, 2).alias("year"),
        field(2, 3).try_cast("bigint").alias("occurrences"), field(3, 4).try_cast("int").alias("volumes"))
    reject = (F.when(~shaped, F.lit("arity")).when(F.col("occurrences").isNull() | F.col("volumes").isNull(), F.lit("number"))
              .otherwise(F.lit("none")))
    return fields.select("word1", "word2", "year", "occurrences", "volumes", reject.alias("reject"),
                         F.when(reject != "none", F.col("line")).alias("line"))


def parse_ngram_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """The n-grams of :func:`classify_ngram_lines`: lines of another token count are dropped, numbers that do not parse
    are null (D4)."""
    return classify_ngram_lines(lines, column).filter("reject <> 'arity'").drop("reject", "line")


def read_ngrams(spark: SparkSession, path: str) -> DataFrame:
    """Scan a folder of n-gram text files and normalise it (S5 + U2)."""
    return parse_ngram_lines(spark.read.text(path))


def split_ngrams(spark: SparkSession, path: str, out: str) -> DataFrame:
    """S5 / D4 with the rejects kept and counted: one scan writes all lines below ``out``, a folder per ``reject``
    reason; returns (reject, n), counted from what was written."""
    classify_ngram_lines(spark.read.text(path)).write.mode("overwrite").partitionBy("reject").parquet(out)
    return spark.read.parquet(out).groupBy("reject").agg(F.count(F.lit(1)).alias("n"))
