"""The streaming tumbling count equals the batch one once all input is consumed."""

import os
import shutil

from pyspark.sql import functions as F

from colonnade.operators.windows import tumbling_count
from colonnade.streaming import weekly_counts_stream
from colonnade.streaming.windows import read_parquet_stream

SRC = "/root/testdata/sf0.001/events.parquet"


def test_stream_matches_batch(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    shutil.copy(SRC, os.path.join(src, "part-0.parquet"))
    batch = spark.read.parquet(src)
    stream = read_parquet_stream(spark, src, batch.schema, max_files_per_trigger=1)
    counts = weekly_counts_stream(stream, "ts", ["user_id"], "event_id")
    q = (counts.writeStream.outputMode("complete").format("memory").queryName("weekly_stream_test")
         .option("checkpointLocation", os.path.join(tmp_dir, "ckpt")).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    fmt = "yyyy-MM-dd HH:mm:ss"
    got = spark.table("weekly_stream_test").select(
        "user_id", F.date_format("window.start", fmt).alias("w"), "event_count")
    want = tumbling_count(batch, "ts", ["user_id"], "event_id").select(
        "user_id", F.date_format("window.start", fmt).alias("w"), "event_count")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
