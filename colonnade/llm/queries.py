"""Registered queries of the corpus operators: (spark, sf_dir) -> DataFrame over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.llm.bpe_stream import encode_documents
from colonnade.llm.jaccard_tiles import jaccard_components
from colonnade.llm.lm_brown import score_documents
from colonnade.llm.licences import scan_licences
from colonnade.llm.mixing_pareto import mix_pareto
from colonnade.llm.packing_ss import pack_documents
from colonnade.llm.period_tiles import periodic_runs
from colonnade.llm.pii_weak import detect_pii
from colonnade.llm.quality_mcd import mcd_outliers
from colonnade.llm.sql import ORACLES
from colonnade.llm.substring_windows import remove_repeats
from colonnade.llm.text import words_col
from colonnade.llm.topk_columnar import exact_topk
from colonnade.llm.url_rules import judge_urls
from colonnade.llm.whitening import whiten
from colonnade.sources.tables import load_table


def op1_quality_mcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mcd_outliers(load_table(spark, sf_dir, "documents"))


def op2_packing_ss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(load_table(spark, sf_dir, "documents"))


def op3_lm_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    return score_documents(docs.withColumn("_held", F.coalesce(held, F.lit(False))), held_out="_held")


def op4_pii_weak(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect_pii(load_table(spark, sf_dir, "documents"))
    spans = F.array_join(F.transform("found", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.withColumn("spans", spans).drop("found")


def op5_mixing_pareto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_pareto(load_table(spark, sf_dir, "documents")).drop("copies", "inclusion")


def op6_substring_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(load_table(spark, sf_dir, "documents")).drop("intervals")


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(load_table(spark, sf_dir, "pages")).drop("pattern")


def op8_jaccard_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(load_table(spark, sf_dir, "documents")).drop("class_size")


def op9_topk_columnar(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = load_table(spark, sf_dir, "embeddings")
    return exact_topk(vectors, vectors.where("vec_id % 50 = 0"))


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(load_table(spark, sf_dir, "documents"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text; in every tenth document (by the id's hash) the words from some place on repeat their first ones."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, words = F.floor(h / 10), words_col(F.col("text"))
    n = F.size(words).cast("long")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    unit, times = F.slice(words, (a + 1).cast("int"), p.cast("int")), F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(unit, times)), F.lit(1), (n - a).cast("int"))
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), " ")
    chosen = F.coalesce((h % 10 == 0) & (n > 0), F.lit(False))
    return docs.select("doc_id", F.when(chosen, planted).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_periods(load_table(spark, sf_dir, "documents")))
    order = F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p")))
    best = F.get(F.sort_array(order), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_best.s").alias("start"), (-F.col("_best.l")).alias("length"),
        F.col("_best.p").alias("period"), F.floor(-F.col("_best.l") * 1000 / F.col("_best.p")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_bpe_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    done = encode_documents(load_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(load_table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    fns = (op1_quality_mcd, op2_packing_ss, op3_lm_brown, op4_pii_weak, op5_mixing_pareto, op6_substring_windows,
           op7_url_rules, op8_jaccard_tiles, op9_topk_columnar, op10_licences, op11_periodic_runs, op12_bpe_stream, op13_whitening, pipeline)
    return {f.__name__: f for f in fns}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
