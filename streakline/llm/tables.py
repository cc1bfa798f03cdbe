"""Scratch tables in the shared checkpoint folder, and joins that broadcast only behind a size check."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streakline.session import scratch_path

#: Largest estimated size of a broadcast side; beyond it the join shuffles.
BROADCAST_BYTES = 24 << 20


#: Rows and bytes per Arrow batch: texts are long, and both the executor and its Python workers hold whole batches.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


@contextmanager
def short_batches(spark: SparkSession) -> Iterator[SparkSession]:
    """The session with Arrow batches of the sizes in BATCH; its own settings are back afterwards.

    What is lazy is computed later, under whatever holds then: store results inside.
    """
    before = {key: spark.conf.get(key, None) for key in BATCH}
    for key, value in BATCH.items():
        spark.conf.set(key, value)
    try:
        yield spark
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame, row_id: str) -> DataFrame:
    """``docs`` stored with a unique bigint ``row_id``, numbered once: every later scan reads the same ids, however it is split."""
    return stored(docs.withColumn(row_id, F.monotonically_increasing_id()), "numbered", "zstd")


def numbered_texts(docs: DataFrame, row_id: str | None = None) -> DataFrame:
    """(row_id, doc_id, text) of ``docs``; the ids are those of its column ``row_id`` (of a stored table), or else numbered and stored here."""
    texts = ["doc_id", F.col("text").cast("string").alias("text")]
    return docs.select(F.col(row_id).alias("row_id"), *texts) if row_id else numbered(docs.select(*texts), "row_id").select("row_id", "doc_id", "text")


def small_side(df: DataFrame, rows: int, row_bytes: int, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint when ``rows * row_bytes`` proves it small, else unchanged (sort-merge join)."""
    return F.broadcast(df) if rows * row_bytes <= most else df


def partitions_for(spark: SparkSession, rows: int, rows_per_partition: int) -> int:
    """Shuffle partitions that hold about ``rows_per_partition`` rows each, never fewer than the session's."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / rows_per_partition))


def free_name(taken: list[str], stem: str) -> str:
    """A column name that no column of ``taken`` has (names compare without case, as Spark resolves them)."""
    used = {c.lower() for c in taken}
    name = stem
    while name.lower() in used:
        name += "_"
    return name
