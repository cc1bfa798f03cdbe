"""Input parallelism guard."""

from __future__ import annotations

import uuid

from pyspark.errors import PySparkAttributeError, PySparkNotImplementedError
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` over ``min_partitions`` tasks if its scan yields fewer.

    A single large row group or a gzip file is one input split, so all
    per-line work (rendering, regex parsing) would run in one task.  Large
    inputs already have at least as many splits as the cluster has cores and
    pass through untouched, without a shuffle.  Default: the cluster's
    default parallelism.  Order-carrying columns (arrival keys) must be
    computed before this call; row order itself is not kept.

    The spread rows are observed (metric ``rows``): besides counting the
    input, the observation keeps later filters from being pushed below the
    repartition into the few pre-shuffle tasks.
    """
    try:
        want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()  # only the number is asked for; no data passes through it
    except (PySparkAttributeError, PySparkNotImplementedError):  # Spark Connect has neither: leave the input as it is
        return df
    if have >= want:
        return df
    return df.repartition(want).observe(f"spread_{uuid.uuid4().hex[:8]}", F.count(F.lit(1)).alias("rows"))
