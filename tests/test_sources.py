"""Scans and sinks on literal fixtures (FIXTURES.md F-1..F-3)."""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from colonnade.sources import csv as csv_src
from colonnade.sources import sinks
from colonnade.sources.text import parse_ngram_lines


def _write(path, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.txt"), "w") as f:
        f.write(text)


def test_csv_quoted_comma_keeps_columns(spark, tmp_dir):
    # A quoted comma in "Location Description" must not shift later fields.
    _write(tmp_dir, 'ID,Block,Location Description,Beat,Year\n'
                    '1,001XX N STATE ST,"PARKING LOT, GARAGE",0111,2019\n'
                    '2,064XX S DR,STREET,0714,2020\n')
    df = csv_src.read_csv_strings(spark, tmp_dir, ["ID", "Block", "Location Description", "Beat", "Year"])
    rows = {r["ID"]: r for r in df.collect()}
    assert rows["1"]["Location Description"] == "PARKING LOT, GARAGE"
    assert rows["1"]["Year"] == "2019" and rows["1"]["Beat"] == "0111"


def test_positional_text_scan_ignores_quotes(spark, tmp_dir):
    _write(tmp_dir, "a,b,c\nx,y\n")
    df = csv_src.read_text_positional(spark, tmp_dir, {"first": 0, "third": 2})
    assert sorted((r.first, r.third) for r in df.collect()) == [("a", "c"), ("x", None)]


def test_typed_csv_timestamp_pattern(spark, tmp_dir):
    # 12-hour clock with AM/PM marker.
    _write(tmp_dir, "ID,Date\n7,01/05/2017 11:40:00 PM\n8,12/31/2000 01:02:03 AM\n")
    schema = T.StructType([T.StructField("ID", T.LongType()), T.StructField("Date", T.TimestampNTZType())])
    df = csv_src.read_csv_typed(spark, tmp_dir, schema, timestamp_format=None,
                                timestamp_ntz_format=csv_src.EVENT_TIMESTAMP_FORMAT)
    got = {r.ID: r.Date.isoformat() for r in df.collect()}
    assert got == {7: "2017-01-05T23:40:00", 8: "2000-12-31T01:02:03"}


def test_ngram_parse_shapes_and_malformed(spark):
    # F-2: arity 4 and 5, leading/trailing blanks, 3 tokens, non-numeric volumes.
    lines = ["nuchi 1999 3 4", "haw chi 2000 5 6", "  word 1999 3 4", "word 1999 3 4   ",
             "one two three", "word 1999 3 x", "a\tb\t2001\t1\t2"]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    got = [tuple(r) for r in parse_ngram_lines(df).collect()]
    assert ("nuchi", None, "1999", 3, 4) in got
    assert ("haw", "chi", "2000", 5, 6) in got
    # Leading blanks give an empty first token (Java split), so it is a 2-gram shape.
    assert ("", "word", "1999", 3, 4) in got
    assert ("word", None, "1999", 3, 4) in got  # trailing blanks ignored
    assert ("word", None, "1999", 3, None) in got  # non-numeric volumes -> null, not a failure
    assert ("a", "b", "2001", 1, 2) in got
    assert len(got) == 6  # the 3-token line is dropped


def test_ngram_rejects_are_kept_and_counted(spark, tmp_dir):
    from colonnade.sources.text import classify_ngram_lines, split_ngrams
    lines = ["nuchi 1999 3 4", "one two three", "word 1999 3 x", "w 1999 y 4", "", "haw chi 2000 5 6"]
    _write(tmp_dir + "/in", "\n".join(lines) + "\n")
    counts = {r.reject: r.n for r in split_ngrams(spark, tmp_dir + "/in", tmp_dir + "/out").collect()}
    assert counts == {"arity": 2, "number": 2, "none": 2}
    kept = spark.read.parquet(tmp_dir + "/out")
    assert {r.line for r in kept.where("reject <> 'none'").collect()} == set(lines[1:5])
    df = spark.createDataFrame([(None,), ("a b 1 2 3",)], "value string")
    assert [tuple(r) for r in classify_ngram_lines(df).orderBy("reject").collect()] == [
        (None, None, None, None, None, "arity", None), ("a", "b", "1", 2, 3, "none", None)]


def test_single_file_keeps_the_scan_parallel_and_sorted(spark, tmp_dir):
    df = spark.range(0, 1000, 1, 8).withColumn("part", F.spark_partition_id())
    sinks.write_csv(df, os.path.join(tmp_dir, "o"), single_file=True, order_by=["id"])
    part = [f for f in os.listdir(os.path.join(tmp_dir, "o")) if f.startswith("part-")]
    rows = [tuple(map(int, x.split(","))) for x in open(os.path.join(tmp_dir, "o", part[0]))]
    assert len(part) == 1 and [r[0] for r in rows] == list(range(1000)) and len({r[1] for r in rows}) == 8


def test_wide_csv_short_row_is_null_not_error(spark, tmp_dir):
    # F-3: positions 0, 2, 3, 165; a row with too few columns.
    full = ",".join(["t", "x", "artist", "3.5"] + ["f"] * 161 + ["2005"])
    _write(tmp_dir, full + "\nshort,row\n")
    df = csv_src.read_wide_csv(spark, tmp_dir, 166, {"title": 0, "artist": 2, "duration": 3, "year": 165})
    rows = sorted(df.collect(), key=lambda r: r.title)
    assert rows[0].title == "short" and rows[0].year is None
    assert (rows[1].artist, rows[1].duration, rows[1].year) == ("artist", "3.5", "2005")


def test_header_drop_and_empty_frame(spark):
    lines = spark.createDataFrame([("h",), ("a",), ("h",), ("b",)], "value string")
    assert sorted(r.value for r in csv_src.drop_header_row(lines, "h").collect()) == ["a", "b"]
    empty = csv_src.empty_frame(spark, T.StructType([T.StructField("x", T.LongType())]))
    assert empty.count() == 0 and empty.columns == ["x"]


def test_kv_lines_sorted_within_partition(spark, tmp_dir):
    df = spark.createDataFrame([(2008, "nu", 26.801897), (1520, "nu", 1.0), (1800, "chi", 1.5625)],
                               "year int, syl string, avg double").coalesce(1)
    lines = [r.value for r in sinks.kv_lines(df, ["year", "syl"], "avg").collect()]
    assert lines == ["1520,nu\t1.0", "1800,chi\t1.5625", "2008,nu\t26.801897"]


def test_single_file_csv(spark, tmp_dir):
    df = spark.range(100).repartition(4)
    out = os.path.join(tmp_dir, "o")
    sinks.write_csv(df, out, header=True, single_file=True)
    parts = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(parts) == 1


def test_checkpoint_root_reads_session_setting(spark):
    from colonnade.session import checkpoint_root, scratch_path
    root = checkpoint_root(spark)
    assert root and "ckpt" in root  # the folder the test session names
    assert scratch_path(spark, "x").startswith(root.rstrip("/") + "/scratch/x-")


def test_typed_csv_malformed_number_is_null(spark, tmp_dir):
    # A malformed number must not fail the job; it becomes null.
    _write(tmp_dir, "id,value\n1,2.5\n2,abc\n3,\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("value", T.DoubleType())])
    df = csv_src.read_csv_typed(spark, tmp_dir, schema, timestamp_format=None)
    assert sorted((r.id, r.value) for r in df.collect()) == [(1, 2.5), (2, None), (3, None)]
