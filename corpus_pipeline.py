"""The corpus pipeline: toxicity, line dedup, n-gram Jaccard join, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.llm import common, line_winnowing, mixing, packing, signature_trees, toxicity_kn


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the toxicity models do not reject."""
    return toxicity_kn.kept(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated runs of lines; n_chars follows. A document that had only such runs goes."""
    out = line_winnowing.dedup(docs).where("n_removed = 0 OR n_removed < n_lines")
    return out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return signature_trees.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences."""
    return packing.op5(docs)


STAGES = [("toxicity", drop_toxic), ("line_dedup", dedup_lines), ("ngram_jaccard", dedup_near), ("mix_sources", mix_sources), ("packing", pack)]

#: Tokenising and trained models are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = common.as_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
