"""Registered queries: each applies one operator to its whole table.

The operators return real outputs (texts, spans, files); the digests that are compared across
engines are derived here.
"""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone.llm import (
    cross_tokenizer,
    decontaminate,
    id_store,
    line_dedup,
    nbsvm,
    near_dups,
    ngram_join,
    packing,
    quality_lines,
    sharding,
    site_templates,
    substring_dedup,
    target_resampling,
)
from tierstone.llm.shipping import ship
from tierstone.sources import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_id_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "ids")
    id_store.write_ids(_table(spark, sf_dir, "documents"), path, tokenizer_path("word_bpe_49k.json"), end_id=2)
    return id_store.read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = quality_lines.measure(_table(spark, sf_dir, "documents"))
    return measured.select("doc_id", "_quality.*").drop("cleaned")


def op9_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    index = line_dedup.LineIndex(spark, scratch_path(spark, "line_index"))
    index.insert(docs)
    return index.resolve(docs).select(
        "doc_id", "_lines.n_lines", "_lines.n_dropped", F.sha2("_lines.text", 256).alias("kept_sha256")
    )


def op3_matrix_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shuffle_into_shards(_table(spark, sf_dir, "documents"), shards=8)
    text = F.coalesce("text", F.lit(""))
    return placed.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit(sharding.LAW).alias("law"),
        "_place.shard",
        "_place.slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = site_templates.extract(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", F.col("_main").alias("text"), F.length("_main").cast("long").alias("n_chars"))


def op5_induced_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    kept = F.col("_repeats.kept")
    return found.select(
        "doc_id",
        "_repeats.n_bytes",
        (F.col("_repeats.n_bytes") - F.length(kept)).cast("long").alias("n_removed"),
        F.size("_repeats.spans").cast("long").alias("n_spans"),
        F.sha2(kept, 256).alias("kept_sha256"),
    )


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality").where(~held_out)
    model = nbsvm.train(nbsvm.with_labels(docs, labels), "quality")
    scored = docs.select("doc_id", held_out.alias("held_out"), nbsvm.score(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op8_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dups.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def op11_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return cross_tokenizer.link_scores(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op12_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = (_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return target_resampling.resample(docs, target, target_resampling.Draw(mean=True)).drop("n_words")


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_groups(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_id_store": op1_id_store,
    "op2_quality_lines": op2_quality_lines,
    "op3_matrix_shuffle": op3_matrix_shuffle,
    "op4_site_templates": op4_site_templates,
    "op5_induced_sort": op5_induced_sort,
    "op6_decontaminate": op6_decontaminate,
    "op7_nbsvm_quality": op7_nbsvm_quality,
    "op8_near_dups": op8_near_dups,
    "op9_pattern_packing": op9_pattern_packing,
    "op10_line_dedup": op10_line_dedup,
    "op11_cross_tokenizer": op11_cross_tokenizer,
    "op12_target_resampling": op12_target_resampling,
    "op13_ngram_join": op13_ngram_join,
}
