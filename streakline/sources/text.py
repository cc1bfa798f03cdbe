"""Text-log source: one row per line, plus an arrival key that fixes line order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .parallel import spread


def arrival_key() -> F.Column:
    """Ordering key for lines of a file scan: (file path, split start, row id).

    ``monotonically_increasing_id`` alone follows Spark's file packing (largest
    file first), which changes with split size and file set.  Prefixing the
    file path and the split's byte offset makes the order "file name, then line"
    whatever the packing; within one split the id increases with the line.
    Deterministic, so a recomputed (lost) partition gets the same keys.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_log_lines(spark: SparkSession, path: str | list[str], *, order: str = "files",
                   min_partitions: int | None = None) -> DataFrame:
    """Scan text files: ``value`` (the whole line, empty lines kept) and ``arrival_id``.

    ``order="files"`` (default): ``arrival_key()``, file name then line --
    reproducible whatever the cluster's split size or core count.
    ``order="scan"``: ``monotonically_increasing_id()``, a bigint in Spark's
    scan order (line order for one file; largest file first for several).
    Numeric, so when one second holds a large share of all lines the bucketed
    segmentation can still cut that second into ranges of it.

    A missing path fails eagerly with PATH_NOT_FOUND, before any job runs.
    Splittable (uncompressed) files are read in parallel splits; when there
    are fewer splits than cores (a small log, a few gzip files) the lines are
    spread after the arrival key is fixed, so parsing still runs in parallel.
    """
    if order not in ("files", "scan"):
        raise ValueError("order must be 'files' or 'scan'")
    arrival = arrival_key() if order == "files" else F.monotonically_increasing_id()
    return spread(spark.read.text(path).select("value", arrival.alias("arrival_id")), min_partitions)
