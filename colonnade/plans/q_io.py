"""Registered queries: scans and sinks (S1-S7, K1-K6) and the text/file jobs
(C7-C10, C13).  Round-trip queries write data that Spark derives from the test
tables below the shared checkpoint folder and read it back with the scan under
test; the oracle computes the expected content straight from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colonnade.operators.ordering import bernoulli_sample, fixed_size_sample, hash_sample, range_bucket_partition
from colonnade.plans import jobs
from colonnade.plans.common import r6, table
from colonnade.plans.registry import register
from colonnade.session import scratch_path
from colonnade.sources import csv as csv_src
from colonnade.sources import sinks
from colonnade.sources.text import read_ngrams, split_ngrams


@register("scan_csv_strings", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       o_orderstatus, strftime(o_orderdate, '%m/%d/%Y') AS o_orderdate, o_orderpriority
FROM orders
""")
def scan_csv_strings(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]
    o = table(spark, sf, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "MM/dd/yyyy"))
    path = scratch_path(spark, "orders-csv")
    sinks.write_csv(o.select(*cols), path, header=True)
    return csv_src.read_csv_strings(spark, path, cols)


# Fixed value: event timestamps written the way the crime CSV stores them.
_EVENT_CSV_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
])


@register("scan_csv_typed", """
SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value
FROM events
""")
def scan_csv_typed(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select(
        "event_id", F.date_format("ts", csv_src.EVENT_TIMESTAMP_FORMAT).alias("ts"), "user_id", "event_type", "value")
    path = scratch_path(spark, "events-csv")
    sinks.write_csv(e, path, header=True)
    back = csv_src.read_csv_typed(spark, path, _EVENT_CSV_SCHEMA, timestamp_format=None,
                                  timestamp_ntz_format=csv_src.EVENT_TIMESTAMP_FORMAT, mode="FAILFAST")
    return back.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


@register("scan_csv_zoned", """
SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS ts, user_id FROM events
""")
def scan_csv_zoned(spark: SparkSession, sf: str) -> DataFrame:
    """S2 as the crime CSV is read: timestamps with the session's zone, by ``timestampFormat``."""
    e = table(spark, sf, "events").select("event_id", F.date_format("ts", csv_src.EVENT_TIMESTAMP_FORMAT).alias("ts"), "user_id")
    path = scratch_path(spark, "events-zoned-csv")
    sinks.write_csv(e, path, header=True)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampType()), T.StructField("user_id", T.LongType())])
    back = csv_src.read_csv_typed(spark, path, schema, mode="FAILFAST")
    return back.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


@register("scan_text_positional", """
SELECT CAST(n_nationkey AS VARCHAR) AS key, n_name AS name, CAST(n_regionkey AS VARCHAR) AS region FROM nation
""")
def scan_text_positional(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation").select(F.concat_ws(",", "n_nationkey", "n_name", "n_regionkey").alias("value"))
    path = scratch_path(spark, "nation-text")
    n.write.text(path)
    return csv_src.read_text_positional(spark, path, {"key": 0, "name": 1, "region": 2})


@register("scan_text_skip_header", """
SELECT CAST(r_regionkey AS VARCHAR) AS r_regionkey, r_name FROM region
""")
def scan_text_skip_header(spark: SparkSession, sf: str) -> DataFrame:
    header = "r_regionkey,r_name"
    body = table(spark, sf, "region").select(F.concat_ws(",", "r_regionkey", "r_name").alias("value"))
    lines = spark.createDataFrame([(header,)], "value string").unionByName(body)
    path = scratch_path(spark, "region-text")
    lines.write.text(path)
    rows = csv_src.drop_header_row(spark.read.text(path), header)
    return rows.select(csv_src.split_field("value", 0).alias("r_regionkey"),
                       csv_src.split_field("value", 1).alias("r_name"))


# N-gram lines derived from line items: odd line numbers give 2-grams
# "adjective noun year occurrences volumes", even ones 1-grams "noun year
# occurrences volumes"; line 3 uses double blanks and line 5 a trailing blank.
def _ngram_source(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_partkey", "l_linenumber", "l_quantity", "l_shipdate")
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    j = li.join(p, li.l_partkey == p.p_partkey)
    toks = F.split("p_name", " ")
    two = (F.col("l_linenumber") % 2) == 1
    return j.select(
        F.when(two, F.get(toks, 0)).otherwise(F.get(toks, 1)).alias("word1"),
        F.when(two, F.get(toks, 1)).alias("word2"),
        F.year("l_shipdate").cast("string").alias("year"),
        F.col("l_linenumber").cast("bigint").alias("occurrences"),
        F.col("l_quantity").cast("int").alias("volumes"),
        F.col("l_linenumber").alias("_ln"),
    )


_NGRAM_SQL = """
SELECT CASE WHEN l_linenumber % 2 = 1 THEN split_part(p_name, ' ', 1) ELSE split_part(p_name, ' ', 2) END AS word1,
       CASE WHEN l_linenumber % 2 = 1 THEN split_part(p_name, ' ', 2) END AS word2,
       CAST(year(l_shipdate) AS VARCHAR) AS year,
       CAST(l_linenumber AS BIGINT) AS occurrences, CAST(l_quantity AS INTEGER) AS volumes
FROM lineitem JOIN part ON l_partkey = p_partkey
"""


@register("scan_ngram", _NGRAM_SQL)
def scan_ngram(spark: SparkSession, sf: str) -> DataFrame:
    src = _ngram_source(spark, sf)
    sep = F.when(F.col("_ln") == 3, F.lit("  ")).otherwise(F.lit(" "))
    tail = F.when(F.col("_ln") == 5, F.lit(" ")).otherwise(F.lit(""))
    line = F.concat(F.concat_ws(" ", "word1", "word2"), sep, "year", sep,
                    F.col("occurrences").cast("string"), sep, F.col("volumes").cast("string"), tail)
    path = scratch_path(spark, "ngrams")
    src.select(line.alias("value")).write.text(path)
    return read_ngrams(spark, path)


@register("scan_ngram_rejects", """
SELECT CASE l_linenumber WHEN 4 THEN 'arity' WHEN 6 THEN 'number' ELSE 'none' END AS reject, COUNT(*) AS n
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1
""")
def scan_ngram_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """N-gram lines of which line 4 lacks its last two tokens and line 6 has a word for its volumes; the rejects
    are kept by reason and counted without a second scan of the input."""
    src = _ngram_source(spark, sf)
    volumes = F.when(F.col("_ln") == 6, F.lit("many")).otherwise(F.col("volumes").cast("string"))
    line = F.when(F.col("_ln") == 4, F.concat_ws(" ", "word1", "year")).otherwise(
        F.concat_ws(" ", "word1", "word2", "year", F.col("occurrences").cast("string"), volumes))
    path = scratch_path(spark, "ngram-rejects")
    src.select(line.alias("value")).write.text(path)
    return split_ngrams(spark, path, scratch_path(spark, "ngram-split"))


# Fixed values of the test mapping: syllables searched in part-name words.
SYLLABLES = ("ol", "in", "ar")


@register("syllable_avg", f"""
WITH g AS ({_NGRAM_SQL}),
w AS (SELECT year, volumes, word1 AS w FROM g UNION ALL SELECT year, volumes, word2 FROM g WHERE word2 IS NOT NULL),
s AS (SELECT year, volumes, syl FROM w, (VALUES ('ol'), ('in'), ('ar')) v(syl) WHERE contains(lower(w), syl))
SELECT year, syl AS syllable, ROUND(AVG(volumes), 6) AS avg_volumes FROM s
WHERE regexp_matches(year, '^(?:[0-9]{{1,4}}|-[0-9]{{1,3}})$') GROUP BY 1, 2
""")
def syllable_avg(spark: SparkSession, sf: str) -> DataFrame:
    out = jobs.syllable_average(_ngram_source(spark, sf), SYLLABLES)
    return out.select("year", "syllable", r6("avg_volumes").alias("avg_volumes"))


@register("stddev_population", f"""
WITH g AS ({_NGRAM_SQL})
SELECT 'standardDeviation' AS metric, ROUND(STDDEV_POP(volumes), 6) AS value FROM g
WHERE regexp_matches(year, '^(?:[0-9]{{1,4}}|-[0-9]{{1,3}})$')
""")
def stddev_population(spark: SparkSession, sf: str) -> DataFrame:
    out = jobs.volume_stddev(_ngram_source(spark, sf))
    return out.select("metric", r6("value").alias("value"))


@register("ngram_kv_report", f"""
WITH g AS ({_NGRAM_SQL}),
w AS (SELECT year, volumes, word1 AS w FROM g UNION ALL SELECT year, volumes, word2 FROM g WHERE word2 IS NOT NULL),
s AS (SELECT year, volumes, syl FROM w, (VALUES ('ol'), ('in'), ('ar')) v(syl) WHERE contains(lower(w), syl)),
a AS (SELECT year, syl, AVG(volumes) AS v FROM s GROUP BY 1, 2)
SELECT year || ',' || syl AS key, ROUND(v, 6) AS value FROM a
""")
def ngram_kv_report(spark: SparkSession, sf: str) -> DataFrame:
    """C7 output as MapReduce text (K2/O5): ``year,syllable<TAB>average``, read back."""
    out = jobs.syllable_average(_ngram_source(spark, sf), SYLLABLES).withColumn("avg_volumes", r6("avg_volumes"))
    path = scratch_path(spark, "syllable-kv")
    sinks.write_kv_text(out, path, ["year", "syllable"], "avg_volumes")
    back = spark.read.text(path)
    return back.select(csv_src.split_field("value", 0, "\t").alias("key"),
                       csv_src.split_field("value", 1, "\t").cast("double").alias("value"))


@register("ngram_ranked_report", f"""
WITH g AS ({_NGRAM_SQL}),
a AS (SELECT word1 AS w, SUM(volumes) AS v FROM g GROUP BY 1)
SELECT row_number() OVER (ORDER BY v DESC, w) AS rank, w AS key, CAST(v AS BIGINT) AS value FROM a
""")
def ngram_ranked_report(spark: SparkSession, sf: str) -> DataFrame:
    """Words ranked by their volumes, written as rank, key and value and read back."""
    totals = _ngram_source(spark, sf).groupBy("word1").agg(F.sum("volumes").alias("total"))
    path = scratch_path(spark, "ranked")
    jobs.ranked_report(totals, path, "total", ["word1"])
    back = spark.read.text(path)
    return back.select(*[csv_src.split_field("value", i, "\t").cast(t).alias(c) for i, (c, t) in enumerate(
        (("rank", "bigint"), ("key", "string"), ("value", "bigint")))])


# Wide "song" CSV derived from parts: 166 columns, title at 0, artist at 2,
# duration at 3 and year at 165 (1990 + size); the rest is filler.
_WIDE = 166


def _write_wide_parts(spark: SparkSession, sf: str) -> str:
    p = table(spark, sf, "part")
    filler = {i: F.lit("x") for i in range(_WIDE)}
    filler[0] = F.col("p_name")
    filler[1] = F.col("p_partkey").cast("string")
    filler[2] = F.get(F.split("p_name", " "), 1)
    filler[3] = F.col("p_retailprice").cast("string")
    filler[165] = (F.col("p_size") + 1990).cast("string")
    wide = p.select(*[filler[i].alias(f"c{i}") for i in range(_WIDE)])
    path = scratch_path(spark, "wide-parts")
    sinks.write_csv(wide, path, header=False)
    return path


@register("scan_wide_csv", """
SELECT p_name AS title, split_part(p_name, ' ', 2) AS artist, CAST(p_retailprice AS VARCHAR) AS duration,
       CAST(p_size + 1990 AS VARCHAR) AS year FROM part
""")
def scan_wide_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = _write_wide_parts(spark, sf)
    return csv_src.read_wide_csv(spark, path, _WIDE, {"title": 0, "artist": 2, "duration": 3, "year": 165})


@register("map_only_filter_project", """
SELECT p_name || ',' || split_part(p_name, ' ', 2) AS key, CAST(p_retailprice AS VARCHAR) AS value FROM part
WHERE p_size + 1990 BETWEEN 2000 AND 2010
""")
def map_only_filter_project(spark: SparkSession, sf: str) -> DataFrame:
    path = _write_wide_parts(spark, sf)
    wide = csv_src.read_wide_csv(spark, path, _WIDE, {"title": 0, "artist": 2, "duration": 3, "year": 165})
    return jobs.items_in_year_range(wide, "title", "artist", "duration", "year", 2000, 2010)


_BUCKET_SQL = """CASE WHEN token < 'f' THEN 0 WHEN token < 'k' THEN 1 WHEN token < 'p' THEN 2
            WHEN token < 'u' THEN 3 ELSE 4 END"""


@register("max_per_key_bucketed", f"""
SELECT token AS artist, GREATEST(MAX(p_retailprice), 0.0) AS max_value, {_BUCKET_SQL} AS bucket,
       {_BUCKET_SQL} AS part
FROM (SELECT unnest(string_split(p_name, ' ')) AS token, p_retailprice FROM part) t GROUP BY token
""")
def max_per_key_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """Longest duration per artist in five ordered parts; ``part`` is the
    partition the row ends up in, which must equal its bucket."""
    p = table(spark, sf, "part").select(F.explode(F.split("p_name", " ")).alias("artist"), "p_retailprice")
    out = jobs.longest_per_key_bucketed(p, "artist", "p_retailprice")
    return out.withColumn("part", F.spark_partition_id())


@register("range_bucket_partition", f"""
SELECT token, COUNT(*) AS n, {_BUCKET_SQL} AS bucket, {_BUCKET_SQL} AS part
FROM (SELECT unnest(string_split(p_name, ' ')) AS token FROM part) t GROUP BY token
""")
def range_bucket_partition_query(spark: SparkSession, sf: str) -> DataFrame:
    toks = table(spark, sf, "part").select(F.explode(F.split("p_name", " ")).alias("token"))
    counts = toks.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return range_bucket_partition(counts, "token").withColumn("part", F.spark_partition_id())


_SUPPLIER_SCHEMA = T.StructType([
    T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType()),
    T.StructField("s_nationkey", T.IntegerType()), T.StructField("s_acctbal", T.DoubleType()),
])


@register("sink_csv_roundtrip", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def sink_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "supplier-csv")
    sinks.write_csv(table(spark, sf, "supplier"), path, header=True)
    return csv_src.read_csv_typed(spark, path, _SUPPLIER_SCHEMA, timestamp_format=None, mode="FAILFAST")


@register("sink_single_file_csv", "SELECT s_nationkey, COUNT(*) AS n FROM supplier GROUP BY 1")
def sink_single_file_csv(spark: SparkSession, sf: str) -> DataFrame:
    """K4: a small report written as a single part file."""
    counts = table(spark, sf, "supplier").groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n"))
    path = scratch_path(spark, "supplier-report")
    sinks.write_csv(counts, path, header=True, single_file=True)
    schema = T.StructType([T.StructField("s_nationkey", T.IntegerType()), T.StructField("n", T.LongType())])
    return csv_src.read_csv_typed(spark, path, schema, timestamp_format=None, mode="FAILFAST")


@register("sink_kv_text", """
SELECT CAST(s_nationkey AS VARCHAR) AS key, CAST(COUNT(*) AS VARCHAR) AS value FROM supplier GROUP BY s_nationkey
""")
def sink_kv_text(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "supplier").groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n"))
    path = scratch_path(spark, "supplier-kv")
    sinks.write_kv_text(counts, path, ["s_nationkey"], "n")
    back = spark.read.text(path)
    return back.select(csv_src.split_field("value", 0, "\t").alias("key"),
                       csv_src.split_field("value", 1, "\t").alias("value"))


@register("write_format_parquet", """
SELECT l_returnflag, l_linestatus, COUNT(*) AS n, ROUND(SUM(l_extendedprice), 2) AS revenue
FROM lineitem GROUP BY 1, 2
""")
def write_format_parquet(spark: SparkSession, sf: str) -> DataFrame:
    """K7: generic final write, partitioned by a column, read back."""
    li = table(spark, sf, "lineitem")
    out = li.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("revenue"))
    path = scratch_path(spark, "lineitem-summary")
    sinks.write_format(out, path, "parquet", partition_by=["l_returnflag"])
    return spark.read.parquet(path).select("l_returnflag", "l_linestatus", "n", "revenue")


@register("union_with_empty", "SELECT event_id, user_id, event_type, value FROM events")
def union_with_empty(spark: SparkSession, sf: str) -> DataFrame:
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                           T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())])
    empty = csv_src.empty_frame(spark, schema)
    return empty.unionByName(table(spark, sf, "events").select(*schema.fieldNames()))


@register("sample_bernoulli")
def sample_bernoulli(spark: SparkSession, sf: str) -> DataFrame:
    """1 % Bernoulli sample (seed 42) written as one CSV report and read back."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    sample = bernoulli_sample(li, 0.01, seed=42)
    path = scratch_path(spark, "sample")
    sinks.write_csv(sample, path, header=True, single_file=True)
    schema = T.StructType([T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
                           T.StructField("l_partkey", T.LongType()), T.StructField("l_quantity", T.DoubleType())])
    return csv_src.read_csv_typed(spark, path, schema, timestamp_format=None, mode="FAILFAST")


@register("sample_report", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
WHERE substr(md5('42|' || l_orderkey || '|' || l_linenumber), 1, 8) < '028f5c28'
""")
def sample_report(spark: SparkSession, sf: str) -> DataFrame:
    """1 % of the rows, by their keys' digests, written as one CSV file and read back."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    path = scratch_path(spark, "sample-report")
    jobs.sample_report(li, path, ["l_orderkey", "l_linenumber"], 0.01)
    schema = T.StructType([T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
                           T.StructField("l_partkey", T.LongType()), T.StructField("l_quantity", T.DoubleType())])
    return csv_src.read_csv_typed(spark, path, schema, timestamp_format=None, mode="FAILFAST")


@register("sample_fixed_size", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
ORDER BY md5('7|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey), l_orderkey, l_linenumber, l_partkey LIMIT 500
""")
def sample_fixed_size(spark: SparkSession, sf: str) -> DataFrame:
    """Exactly 500 rows, those with the smallest key digests."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return fixed_size_sample(li, ["l_orderkey", "l_linenumber", "l_partkey"], 500, seed=7)


@register("sample_by_customer", """
SELECT o_orderkey, o_custkey FROM orders WHERE substr(md5('42|' || o_custkey), 1, 8) < '19999999'
""")
def sample_by_customer(spark: SparkSession, sf: str) -> DataFrame:
    """All orders of a tenth of the customers (a key's rows stay together)."""
    return hash_sample(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey", 0.1)


@register("sample_systematic", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey % 100 < 1
""")
def sample_systematic(spark: SparkSession, sf: str) -> DataFrame:
    """R1 (reproducible variant): every order whose key falls in the first slot of 100."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return li.filter(F.pmod("l_orderkey", F.lit(100)) < 1)


@register("sample_hash_mod", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey % 100 < 1
""")
def sample_hash_mod(spark: SparkSession, sf: str) -> DataFrame:
    """R1 (reproducible): 1 % of orders by key slot, a sample that is the same
    on every run and partitioning (same rows as ``sample_systematic``)."""
    return sample_systematic(spark, sf)


@register("range_bucket_spread", f"""
SELECT token, COUNT(*) AS n, {_BUCKET_SQL} AS bucket FROM (SELECT unnest(string_split(p_name, ' ')) AS token FROM part) t
GROUP BY token
""")
def range_bucket_spread(spark: SparkSession, sf: str) -> DataFrame:
    """K3 at scale: each range bucket spread over four partitions; every
    partition still holds a single bucket."""
    toks = table(spark, sf, "part").select(F.explode(F.split("p_name", " ")).alias("token"))
    counts = toks.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    out = range_bucket_partition(counts, "token", parts_per_bucket=4)
    return out.filter(F.floor(F.spark_partition_id() / 4) == F.col("bucket")).select("token", "n", "bucket")


@register("sink_range_buckets", f"""
SELECT token, p_retailprice AS price, {_BUCKET_SQL} AS bucket
FROM (SELECT unnest(string_split(p_name, ' ')) AS token, p_retailprice FROM part) t
""")
def sink_range_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """K3 as files: every (word, price) row in the folder of its range bucket, read back with the folder's number."""
    toks = table(spark, sf, "part").select(F.explode(F.split("p_name", " ")).alias("token"), F.col("p_retailprice").alias("price"))
    path = scratch_path(spark, "range-buckets")
    sinks.write_range_buckets(toks, path, "token", parts=12)
    return spark.read.schema("token string, price double, bucket int").csv(path)


@register("max_per_key_spread", f"""
SELECT token AS artist, GREATEST(MAX(p_retailprice), 0.0) AS max_value, {_BUCKET_SQL} AS bucket
FROM (SELECT unnest(string_split(p_name, ' ')) AS token, p_retailprice FROM part) t GROUP BY token
""")
def max_per_key_spread(spark: SparkSession, sf: str) -> DataFrame:
    """C10 beyond five tasks: three partitions a range, none of which holds two ranges."""
    p = table(spark, sf, "part").select(F.explode(F.split("p_name", " ")).alias("artist"), "p_retailprice")
    out = jobs.longest_per_key_bucketed(p, "artist", "p_retailprice", parts_per_bucket=3)
    return out.filter(F.floor(F.spark_partition_id() / 3) == F.col("bucket"))
