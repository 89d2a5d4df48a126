"""Documents to training sequences: five stages, each written as Parquet and read by the next.

All but the last stage return the columns of ``documents``. A stage sees what its predecessor
kept, with the texts as that left them.
"""

from __future__ import annotations

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession

from tierstone.llm import decontaminate, line_dedup, near_dups, packing, quality_lines
from tierstone.llm.shipping import ship
from tierstone.sources import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail the rules go; so do documents that are short, repetitive or mostly gone."""
    return quality_lines.clean(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document with a smaller id holds too go, and documents that had no others."""
    ship(spark)
    return line_dedup.dedup(docs, scratch_path(spark, "line_index"), drop_emptied=True)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of the least id."""
    ship(spark)
    return near_dups.keep_first(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in the training sequences."""
    ship(spark)
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_duplicates", near),
    ("decontamination", benchmark),
    ("packing", packed),
]

# near duplicates and tokens are not expressible in SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
