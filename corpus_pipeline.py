"""Cleaning, mixing and packing of a document corpus in stages; each is written as Parquet before the next reads it.

A stage takes (spark, docs, sf_dir) and gives a table with the columns of ``documents``; the last gives packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import bm25_packing, centroid_lang, line_align, simhash, temperature_mix
from shelfwise.llm.common import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Every source is drawn whole at least once; smaller ones are repeated, twice at most, as far as the weights ask for it.
MIXTURE = temperature_mix.Target(budget=None, entropy=0.95, repeats=2.0)

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language identification accepts; a missing language is filled in. Learns from the rows that have one."""
    model = centroid_lang.fit(docs)
    found = centroid_lang.predict(docs, model, keep=COLUMNS).filter("NOT rejected")
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines aligned with earlier ones; those of which nothing is left go."""
    found = line_align.dedup_lines(docs).filter((F.col("n_deleted") == 0) | (F.length("text") > 0))
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links (three words, two bits), that with the smallest id.

    Rows repeated with their id count as copies. A document without id can't be told from others by one and stays.
    """
    named = docs.filter("doc_id IS NOT NULL")
    groups = simhash.near_duplicate_groups(named, max_bits=2, shingle_words=3)
    first = groups.filter(F.col("doc_id") == F.col("component_id")).select("doc_id")
    kept = named.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.filter("doc_id IS NULL")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the mixture's weights: each at least once, those of small sources up to twice."""
    rows = docs.withColumn("_doc", F.struct(*COLUMNS))
    return temperature_mix.mix(rows, MIXTURE, keep=("_doc",)).select("_doc.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training windows."""
    return bm25_packing.pack(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language), ("line_dedup", drop_repeated_lines), ("simhash_dedup", drop_near_duplicates),
    ("mix_sources", mix_sources), ("packing", pack),
]

#: SQL can't express fitted centroids, patience alignment or the tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
