"""Training-data pipeline: quality rules, n-gram Jaccard join, PII, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns documents (the last one: packed pieces); run() writes every
stage's rows below the shared checkpoint folder and rereads them for the next one.

Stages read the columns of documents; extra ones do not come along.  Null texts count as empty: the quality rules reject
them, the other stages keep them (the mix takes no document without words).  Rows that share an id share the fate of any of
them in the quality rules and the mix, and copies under one id all stay in the Jaccard join; rows without id always stay there.  Texts of any length are
processed whole.  Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.llm.jaccard_tiles import jaccard_components
from colonnade.llm.mixing_pareto import mix_pareto
from colonnade.llm.packing_ss import pack_documents
from colonnade.llm.pii_weak import detect_pii
from colonnade.llm.quality_mcd import mcd_outliers
from colonnade.llm.text import materialise
from colonnade.sources.tables import load_table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    verdict = mcd_outliers(docs).where("kept").select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(verdict, docs["doc_id"].eqNullSafe(verdict["_id"]), "left_semi").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays, the one with the least id; documents without words stay."""
    comp = jaccard_components(docs)
    stay = comp.where("doc_id is null or doc_id = component_id or component_id is null").select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(stay, docs["doc_id"].eqNullSafe(stay["_id"]), "left_semi").select(*COLUMNS)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Found spans become <KIND>; of overlapping spans the earlier, then the longer one is replaced whole."""
    found = detect_pii(docs.select(*COLUMNS).withColumn("_body", F.col("text")), keep=("_body", "lang", "source", "n_chars"))
    body = F.coalesce("_body", F.lit(""))
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(acc, s):
        fresh = s["start"] >= acc["at"]
        grown = F.concat(acc["out"], F.substring(body, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit("<"), F.upper(s["kind"]), F.lit(">"))
        return F.struct(F.when(fresh, grown).otherwise(acc["out"]).alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    done = F.aggregate("found", start, step, lambda a: F.concat(a["out"], F.substring(body, (a["at"] + 1).cast("int"), F.lit(2**31 - 1))))
    text = F.when(F.size("found") == 0, F.col("_body")).otherwise(done)
    out = found.withColumn("text", text)
    n = F.when(F.size("found") == 0, F.col("n_chars")).otherwise(F.char_length("text"))
    return out.withColumn("n_chars", n.cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (documents without words: not at all)."""
    copies = mix_pareto(docs).where("taken > 0").groupBy(F.col("doc_id").alias("_id")).agg(F.max("copies").alias("_copies"))
    out = docs.join(copies, docs["doc_id"].eqNullSafe(copies["_id"]))
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    return pack_documents(docs)


STAGES = [("quality rules", quality), ("n-gram Jaccard join", near_duplicates), ("PII", private_data),
          ("mixing sources to target weights", mixing), ("packing", packing)]

#: Hash order, trained models and tokenizers are beyond SQL; tests/llm/test_pipeline.py checks the stages one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
