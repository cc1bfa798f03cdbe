"""Sinks: headered CSV reports, Parquet stage tables, bad-line history.

All writes go through ``DataFrameWriter`` so they work on any Hadoop file
system the cluster uses; nothing is moved or deleted with local file calls.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .versions import Files, Versions, write_one_file


def write_csv(df: DataFrame, path: str, *, single_part: bool = False) -> None:
    """Headered CSV folder, replaced on each run.

    ``single_part`` writes one part file (for reports with one row per type).
    ``coalesce(1)`` is safe only there: with no shuffle between it and the
    scan it would pull the whole upstream stage into one task.  Large reports
    keep many parts; an ordered DataFrame writes its parts in order.
    """
    (df.coalesce(1) if single_part else df).write.mode("overwrite").option("header", True).csv(path)


def read_csv_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a report written by ``write_csv`` back with its declared schema.

    Reports hold no NULLs (level lists are ``''`` when empty), so an empty field,
    quoted or not, must read as ``''``.  The reader's NULL marker is therefore a
    text made up for this read, which no report can hold.
    """
    return spark.read.schema(schema).option("header", True).option("nullValue", f"null-{uuid.uuid4().hex}").csv(path)


def write_table(df: DataFrame, path: str, *, partition_by: tuple[str, ...] = ()) -> None:
    """Parquet stage table, replaced as a whole on each run, whatever the session's partition overwrite mode."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(path)


def write_bad_lines(bad: DataFrame, bad_dir: str, *, keep_history: bool, run_stamp: int | None = None) -> str:
    """Bad-line texts under ``bad_dir/run=<epoch seconds>/``.

    ``keep_history=False`` replaces every earlier run (one-shot mode);
    ``True`` appends a new run folder next to the earlier ones (staged mode).
    Returns the run folder.
    """
    stamp = int(time.time()) if run_stamp is None else run_stamp
    (
        bad.select("value", F.lit(stamp).alias("run"))
        .write.mode("append" if keep_history else "overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("run")
        .text(bad_dir)
    )
    return f"{bad_dir.rstrip('/')}/run={stamp}"


__all__ = ["Files", "Versions", "read_csv_report", "write_bad_lines", "write_csv", "write_one_file", "write_table"]
