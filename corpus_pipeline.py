"""Corpus preparation pipeline over ``documents``: each stage calls one operator of ``streakline.llm``.

Every stage reads the written result of the one before and keeps the columns of
``documents``, whatever further columns there are; the last one returns packed
pieces.  A stage that drops rows stores them with their numbers first, and reads
both the texts it judges and the rows it returns from there.  Stages decide on rows, not on ids: rows with a null or repeated
doc_id are kept or dropped one by one.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streakline.llm.decontaminate import build_index, contamination
from streakline.llm.exact_dedup import exact_groups
from streakline.llm.packing import pack_documents
from streakline.llm.resampling import importance_weights, resample
from streakline.llm.simhash import simhash_components
from streakline.llm.tables import free_name, numbered, short_batches, small_side, stored


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` stored with its rows' numbers, and the name of their column."""
    row = free_name(docs.columns, "row_id")
    return numbered(docs, row), row


def _only(docs: DataFrame, row: str, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows whose ``row`` is in ``dropped`` (row_id), and without ``row``."""
    gone = stored(dropped.select(F.col("row_id").alias(row)), "dropped")
    return docs.join(small_side(gone, gone.count(), 16), row, "left_anti").drop(row)


def _stage(run):
    """``run`` under short Arrow batches; what it returns is read from stored tables without Python."""

    @wraps(run)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with short_batches(spark):
            return run(spark, docs, sf_dir)

    return stage


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling towards the good labelled documents keeps."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs, row = _numbered(docs)
    return _only(docs, row, resample(importance_weights(docs, labels, row_id=row)).filter(~F.col("kept")))


@_stage
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that with the smallest doc_id, of each group of equal texts."""
    docs, row = _numbered(docs)
    return _only(docs, row, exact_groups(docs, row_id=row).filter(~F.col("kept")))


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that with the smallest doc_id, of each SimHash component."""
    docs, row = _numbered(docs)
    return _only(docs, row, simhash_components(docs, row_id=row).filter(~F.col("kept")))


@_stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages do not contaminate."""
    docs, row = _numbered(docs)
    rows = docs.select(F.col(row).alias("doc_id"), "text")
    found = contamination(build_index(rows), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _only(docs, row, found.filter("contaminated").select(F.col("doc_id").alias("row_id")))


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents and their places in sequences."""
    return stored(pack_documents(docs, public_tokenizers.path("word_bpe_49k.json")), "packed")


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

#: Hashed n-gram models, SimHash components and packing have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to ``documents``, each on the written result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
