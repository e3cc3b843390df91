"""Cleaning of a document collection in stages, each of them one operator over all that the stage before kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktake.llm.bpe_codec import encode_decode
from stocktake.llm.columns import free_name
from stocktake.llm.decontaminate import leaks
from stocktake.llm.line_dedup import without_lines
from stocktake.llm.quality_rules import judged
from stocktake.llm.simhash_dedup import near_duplicates
from stocktake.session import new_work_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

VOCABULARY = "word_bpe_49k.json"


def _changed(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with another text, and its length where that column is there."""
    columns = docs.columns
    docs = docs.withColumn("text", text)
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return docs.select(*(f"`{c}`" for c in columns))


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """A number per row, as ids may be null or repeated, and its column; ``docs`` is a written table, so it is the same each time."""
    name = free_name(docs, "_row")
    return docs.withColumn(name, F.monotonically_increasing_id()), name


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, and the failing lines of the others."""
    others = F.struct(*(f"`{c}`" for c in docs.columns if c != "text")).alias("others")
    kept = judged(docs.select("text", others)).where("quality.kept")
    columns = [F.col("quality.clean_text").alias("text") if c == "text" else F.col(f"others.`{c}`") for c in docs.columns]
    return _changed(kept.select(*columns), F.col("text"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, and documents that are left without a word."""
    return _changed(without_lines(docs), F.col("text")).where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    numbered, row = _numbered(docs)
    groups = near_duplicates(numbered, id_col=row).select(F.col("doc_id").alias(row), "component_id")
    named = groups.join(numbered.select(row, "doc_id"), row)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", row))
    kept = named.groupBy("component_id").agg(first.alias("first")).select(f"first.{row}")
    return numbered.join(kept, row, "left_semi").drop(row)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    numbered, row = _numbered(docs)
    hit = leaks(numbered, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=row).select(F.col("doc_id").alias(row)).distinct()
    return numbered.join(hit, row, "left_anti").drop(row)


def bpe_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the text that is left, and the text they decode to, as digests."""
    return encode_decode(docs, public_tokenizers.path(VOCABULARY))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontamination", decontamination),
    ("bpe_codec", bpe_codec),
]
#: Tries, MinHash components and merges of a vocabulary are beyond SQL; tests/llm compares each stage with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again.

    A null or empty text has no words and goes with the first stage. Ids may be
    null or repeated: each row is a document of its own, and of equal ones the
    smallest id, then the first row stays. Other columns, whatever their names,
    come through all stages but the last. An empty table gives no rows. Texts of
    any length are taken whole.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_work_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
