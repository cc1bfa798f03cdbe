"""What each stage knows of itself: inputs, parameters and outputs, written when it is complete.

A stage removes its manifest (and those of the stages after it) before it
touches its tables and writes it again at the very end.  So a manifest means
whole tables; a stage whose predecessor has none, or whose files are not those
the manifest lists, is refused, and one with the same inputs and parameters can be skipped.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..sinks.versions import Files

_FOLDER = "_stages"


class StageIncomplete(RuntimeError):
    """A stage's tables are missing, half-written or not those that it wrote."""


class StageLog:
    """Manifests of the stages of one stage folder; ``order`` is the order the stages run in."""

    def __init__(self, spark: SparkSession, stage_dir: str, order: Sequence[str]):
        self.spark, self.files, self.order = spark, Files(spark, stage_dir), tuple(order)

    def get(self, stage: str) -> dict | None:
        name = f"{stage}.json"
        return json.loads(self.files.read(f"{_FOLDER}/{name}")) if name in self.files.names(_FOLDER) else None

    def begin(self, stage: str) -> None:
        """From now on the stage and all after it are incomplete."""
        for later in self.order[self.order.index(stage) :]:
            self.files.delete(f"{_FOLDER}/{later}.json")

    def done(self, stage: str, inputs: Mapping, parameters: Mapping, tables: Sequence[str]) -> None:
        text = json.dumps({
            "stage": stage, "inputs": dict(inputs), "parameters": dict(parameters), "tables": {t: self.files.size(t) for t in tables},
        }, indent=1, sort_keys=True)
        if not self.files.create(f"{_FOLDER}/{stage}.json", text):
            raise StageIncomplete(f"another run has completed stage {stage!r} meanwhile")

    def fingerprint(self, stage: str) -> str:
        """Changes whenever the stage is completed with other tables."""
        return hashlib.sha256(json.dumps(self.get(stage), sort_keys=True).encode()).hexdigest()

    def require(self, stage: str) -> dict:
        """The manifest of a complete stage whose files are all there."""
        manifest = self.get(stage)
        if manifest is None:
            raise StageIncomplete(f"stage {stage!r} in {self.files.path} is missing or was not finished; run it (again) first")
        for table, size in manifest["tables"].items():
            if self.files.size(table) != size:
                raise StageIncomplete(f"table {table!r} in {self.files.path} is not what stage {stage!r} wrote; run the stage again")
        return manifest

    def is_done(self, stage: str, inputs: Mapping, parameters: Mapping) -> bool:
        """Whether the stage is complete for the very inputs and parameters."""
        try:
            manifest = self.require(stage)
        except StageIncomplete:
            return False
        plain = lambda x: json.loads(json.dumps(dict(x)))
        return manifest["inputs"] == plain(inputs) and manifest["parameters"] == plain(parameters)


def input_state(spark: SparkSession, path: str | Sequence[str]) -> dict:
    """Number, bytes and a digest of the names, sizes and times of change of the files in ``path`` (their content is not read)."""
    files = spark.read.format("binaryFile").load(path if isinstance(path, str) else list(path)).select("path", "length", "modificationTime")
    one = files.agg(F.count("*").alias("files"), F.sum("length").alias("bytes"), F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("digest"))
    return one.first().asDict()
