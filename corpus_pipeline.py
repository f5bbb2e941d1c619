"""From raw documents to packed training sequences, in five stages over whole tables.

Every stage is an operator of ``lifeloom.llm``, reads all that the one before it kept, and is
written as Parquet in the shared folder before the next one starts, so a lost executor costs at
most the running stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lifeloom.llm.leaks import without_leaks
from lifeloom.llm.lines import dedup_lines
from lifeloom.llm.near import near_duplicates
from lifeloom.llm.packing import pack
from lifeloom.llm.quality import quality
from lifeloom.llm.tables import keep, read

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def kept_by(stage: Callable[[DataFrame], DataFrame], docs: DataFrame) -> DataFrame:
    """The documents that a stage keeps, with all their columns.

    Within the stage all columns but doc_id and text have names of their own, so that none is
    taken for one of the stage's; the stage may change the text.
    """
    names = {c: c if c in ("doc_id", "text") else f"_given_{i}" for i, c in enumerate(docs.columns)}
    done = stage(docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items())))
    return done.select(*(F.col(n).alias(c) for c, n in names.items()))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the surface rules or the likelihood ratio go."""
    return kept_by(lambda d: quality(d, read(spark, sf_dir, "labels")).filter("kept"), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, and documents of which nothing else is left; n_chars follows the text."""

    def stage(d: DataFrame) -> DataFrame:
        cleaned = dedup_lines(d)
        cleaned = cleaned.filter("n_removed_lines = 0 or n_removed_lines < n_lines")
        if "n_chars" in docs.columns:
            own = f"_given_{docs.columns.index('n_chars')}"
            n_chars = F.char_length("text").cast(docs.schema["n_chars"].dataType)
            cleaned = cleaned.withColumn(own, F.when(F.col("n_removed_lines") > 0, n_chars).otherwise(F.col(own)))
        return cleaned

    return kept_by(stage, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays.

    Rows are numbered, so null and repeated doc_ids neither lose nor join anything.
    """

    def stage(d: DataFrame) -> DataFrame:
        rows = keep(d.withColumn("_row", F.monotonically_increasing_id()), "numbered")
        groups = near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text"))
        return rows.join(groups.filter("kept").select(F.col("doc_id").alias("_row")), "_row", "left_semi")

    return kept_by(stage, docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item's question and answer go."""
    return kept_by(lambda d: without_leaks(d, read(spark, sf_dir, "benchmark")), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, with their places in sequences of 1,024 tokens."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Hashes, components and packing have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
