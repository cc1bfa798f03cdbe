"""Session helpers: the shared scratch folder used for checkpoints and stage tables.

The cluster names its shared folder in ``spark.checkpoint.dir``; we read it
from the session.  Only when it is unset *and* Spark runs in local mode (tests,
benches) do we create a temporary one -- a machine-local folder is never used
on a cluster.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint directory of the session, set from ``spark.checkpoint.dir`` when needed."""
    try:
        sc = spark.sparkContext
    except Exception:  # no SparkContext in this client (Spark Connect): the conf must name the folder
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif re.fullmatch(r"local(\[.*\])?", sc.master):  # one machine; local-cluster has executors of its own
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="streakline-ckpt-"))
    else:
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder path under the shared checkpoint directory."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/streakline/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove everything that operators and queries wrote to the shared scratch folder.

    Results read their tables lazily, so call it when no result is in use any more.
    """
    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/streakline")
    folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)
