"""The registered query of each operator: production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import (
    bm25_packing, centroid_lang, chat_rotation, collocations, context_mix, html_regions, line_align, mtree, rule_ledger,
    simhash, temperature_mix, toxicity, turn_repair,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_groups(_table(spark, sf_dir, "documents"))


def op2_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat_rotation.rotate(_table(spark, sf_dir, "conversations"))
    return rows.withColumn("rendered_md5", F.md5("rendered")).drop("rendered")


def op3_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temperature_mix.mix(_table(spark, sf_dir, "documents"))


def op4_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ledger.verdicts(_table(spark, sf_dir, "documents"))


def op5_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = bm25_packing.pack(_table(spark, sf_dir, "documents"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op6_html_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_regions.extract(_table(spark, sf_dir, "pages"))


def op7_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_line_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_align.dedup_lines(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_deleted", "is_copy", F.length("text").alias("n_chars_left"), F.md5("text").alias("text_md5"))


def op9_context_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mix.score(_table(spark, sf_dir, "documents"))


def op10_centroid_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", centroid_lang.held_out())
    model = centroid_lang.fit(docs.filter(~docs.held_out))
    return centroid_lang.predict(docs, model, keep=("doc_id", "held_out"))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    found = turn_repair.repair(turn_repair.damage(turns), turns.select(F.col("conv_id").alias("conv")))
    return found.withColumnRenamed("conv", "conv_id")


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def llm_queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_simhash, op2_chat_rotation, op3_temperature_mix, op4_rule_ledger, op5_bm25_packing, op6_html_regions, op7_mtree, op8_line_align,
        op9_context_mix, op10_centroid_lang, op11_turn_repair, op12_toxicity, op13_collocations)}
