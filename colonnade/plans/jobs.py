"""Composed batch jobs (C1-C4, C7-C10, C12, C13), one function each, with the
columns they work on as arguments.  The model jobs (C5, C6, C11) live in
:mod:`colonnade.operators.ml`."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colonnade.functions.predicates import in_range, in_years, is_valid_year
from colonnade.functions.scalars import concat_key, period_label
from colonnade.operators.aggregates import (
    average_of_counts, conditional_count, max_floor_zero, pivot_scaled, population_stddev,
)
from colonnade.operators.ordering import hash_sample, range_bucket_partition, top_k
from colonnade.operators.sequences import dense_ordinal, level_chained_discount
from colonnade.operators.similarity import best_correlated_partner
from colonnade.sources.sinks import write_csv


def monthly_average_count(df: DataFrame, date_col: str) -> DataFrame:
    """Rows per (month, year), averaged over the years of each month."""
    dated = df.select(F.month(date_col).cast("bigint").alias("month"), F.year(date_col).alias("year"))
    return average_of_counts(dated, ["month"], ["year"], "avg_count").orderBy("month")


def top_places_recent(df: DataFrame, place: str, year: Column, recent_years: Sequence[int],
                      k: int = 10) -> DataFrame:
    """The ``k`` places with most rows in ``recent_years`` (every place
    competes, with 0 when it has none), printed in ascending order."""
    counts = conditional_count(df, [place], year.isin(list(recent_years)), "n")
    return top_k(counts, "n", k, [place], ascending_output=True)


def correlated_partners(df: DataFrame, entity: str, date_col: str, years: Sequence[int]) -> DataFrame:
    """Yearly row counts per entity over ``years``; for every entity with
    all years, the larger-keyed entity with the most correlated counts."""
    counts = (df.filter(in_years(df, date_col, years))
              .select(F.col(entity), F.year(date_col).alias("_year"))
              .groupBy(entity, "_year").agg(F.count(F.lit(1)).alias("_n")))
    best = best_correlated_partner(counts, entity, "_year", "_n", list(years))
    return best.orderBy(F.col("corr").desc(), entity)


def region_period_average(df: DataFrame, region: Column, year_text: Column,
                          periods: Sequence[tuple[str, int, int]],
                          divisors: Mapping[str, float]) -> DataFrame:
    """C4: rows per (region, period label), each period divided by its number
    of years, one column per period, sorted by region."""
    labelled = df.select(region.alias("region"), period_label(year_text, periods).alias("period"))
    return pivot_scaled(labelled, "region", "period", divisors).orderBy("region")


def syllable_hits(ngrams: DataFrame, syllables: Sequence[str]) -> DataFrame:
    """(year, syllable, volumes) once per (word, syllable) match of a valid-year n-gram.

    Plain explode + filter (no lambda functions), so the whole step stays in
    generated code."""
    syl = F.array(*[F.lit(s.lower()) for s in syllables])
    valid = ngrams.filter(is_valid_year("year") & F.col("volumes").isNotNull())
    per_word = (valid.select("year", "volumes", F.explode(F.array("word1", "word2")).alias("_w"))
                .filter(F.col("_w").isNotNull())
                .select("year", "volumes", F.lower("_w").alias("_w")))
    pairs = per_word.select("year", "volumes", "_w", F.explode(syl).alias("syllable"))
    return pairs.filter(F.col("_w").contains(F.col("syllable"))).select("year", "volumes", "syllable")


def syllable_average(ngrams: DataFrame, syllables: Sequence[str]) -> DataFrame:
    """Mean volumes per (year, syllable)."""
    return (syllable_hits(ngrams, syllables).groupBy("year", "syllable")
            .agg(F.avg(F.col("volumes").cast("double")).alias("avg_volumes")))


def volume_stddev(ngrams: DataFrame) -> DataFrame:
    """Population standard deviation of volumes over valid-year n-grams."""
    valid = ngrams.filter(is_valid_year("year") & F.col("volumes").isNotNull())
    return population_stddev(valid, [], "volumes", "value").select(
        F.lit("standardDeviation").alias("metric"), "value")


def items_in_year_range(df: DataFrame, title: str, artist: str, value: str, year: str,
                        lo: int = 2000, hi: int = 2010) -> DataFrame:
    """Map-only filter + projection: ``title,artist`` -> value for valid
    years in [lo, hi].  No shuffle."""
    ok = is_valid_year(year) & in_range(F.col(year).try_cast("int"), lo, hi)
    return df.filter(ok).select(concat_key(title, artist).alias("key"), F.col(value).alias("value"))


def longest_per_key_bucketed(df: DataFrame, key: str, value: str, year: str | None = None,
                             parts_per_bucket: int | str = 1) -> DataFrame:
    """Max value per key (floor 0) in five key ranges, each of ``parts_per_bucket`` partitions (one: the five
    reducers of the original job)."""
    rows = df.filter(is_valid_year(year)) if year else df
    best = max_floor_zero(rows, [key], value, "max_value")
    return range_bucket_partition(best, key, parts_per_bucket=parts_per_bucket)


def sample_report(df: DataFrame, path: str, keys: Sequence[str], fraction: float, seed: int = 42) -> None:
    """A row sample written as one CSV file.  The sample is drawn by the scan's tasks; only its rows go to the one that writes."""
    write_csv(hash_sample(df, keys, fraction, seed), path, header=True, single_file=True, order_by=keys)


def ranked_report(df: DataFrame, path: str, score: str, keys: Sequence[str]) -> None:
    """A ranked list as text, ``rank<TAB>key<TAB>score``, highest score first (ties: smaller keys), in parts that
    follow one another in rank order.

    Ranks are global without a global task: range pieces are numbered alone and offset by the sizes of the earlier ones."""
    ranked = dense_ordinal(df.select(*keys, score), [], [f"-{score}", *keys], "rank")
    key = F.concat_ws(",", *[F.col(c).cast("string") for c in keys])
    lines = ranked.repartitionByRange(F.col("rank")).sortWithinPartitions("rank")
    lines.select(F.concat_ws("\t", F.col("rank").cast("string"), key, F.col(score).cast("string")).alias("value")).write.mode("overwrite").text(path)


def coupon_chain(items: DataFrame, idx: str, level: str, pct: str, cost: str, costs: DataFrame | None = None) -> DataFrame:
    """Level-chained discounts for every coupon row (``costs``: transactions with their cost, if not in ``items``)."""
    return level_chained_discount(items, [idx], level, pct, cost, costs=costs)
