"""Atomic replacement of reports and tables: versioned folders behind a log of manifests.

A writer saves into a folder of its own (``<path>/v00000007-<random>``) and then publishes it by creating
``<path>/_versions/00000007.json``, which states its size.  The manifest appears under its name in one rename, and only if
nobody else has taken the number.  Readers take the version of the highest manifest, so a
job that dies at any moment leaves the one before it readable, and no reader ever sees half a version.
All file work goes through Hadoop's file system classes, whatever store the path is in.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import SparkSession

_LOG = "_versions"


class Files:
    """The few operations on a Hadoop path that manifests need."""

    def __init__(self, spark: SparkSession, path: str):
        context = spark.sparkContext
        self._jvm, self._gateway, self._conf = context._jvm, context._gateway, context._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")
        self._fs = self._of(self.path).getFileSystem(self._conf)

    def _of(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str = "") -> list[str]:
        """Names in a folder under the path (none if it is not there)."""
        at = self._of(f"{self.path}/{folder}" if folder else self.path)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def size(self, folder: str = "") -> dict[str, int]:
        """Number and bytes of all files below a folder (one call to the file system)."""
        at = self._of(f"{self.path}/{folder}" if folder else self.path)
        if not self._fs.exists(at):
            return {"files": 0, "bytes": 0}
        found = self._fs.getContentSummary(at)
        return {"files": found.getFileCount(), "bytes": found.getLength()}

    def read(self, name: str) -> str:
        stream = self._fs.open(self._of(f"{self.path}/{name}"))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Create a file whole; False if the name is taken."""
        target, part = self._of(f"{self.path}/{name}"), self._of(f"{self.path}/{name}.{uuid.uuid4().hex}.part")
        stream = self._fs.create(part, False)
        stream.write(text.encode())
        stream.close()
        if not self._fs.exists(target) and self._fs.rename(part, target):
            return True
        self._fs.delete(part, False)
        return False

    def delete(self, name: str) -> None:
        self._fs.delete(self._of(f"{self.path}/{name}"), True)

    def replace(self, name: str, to: str) -> None:
        """Rename a file under the path to a path of its own, in place of what is there."""
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._of(to).toUri(), self._conf)
        option = self._jvm.org.apache.hadoop.fs.Options.Rename
        overwrite = self._gateway.new_array(option, 1)
        overwrite[0] = option.OVERWRITE
        files.rename(self._fs.makeQualified(self._of(f"{self.path}/{name}")), self._fs.makeQualified(self._of(to)), overwrite)


class Versions:
    """The versions of one report or table at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.files, self.path = Files(spark, path), path.rstrip("/")

    def numbers(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self.files.names(_LOG) if n.endswith(".json")]

    def current(self) -> dict | None:
        """The manifest of the latest version: number, folder, size and notes; None before the first."""
        numbers = self.numbers()
        return json.loads(self.files.read(f"{_LOG}/{max(numbers):08d}.json")) if numbers else None

    def folder(self) -> str:
        """Path of the latest version's folder."""
        now = self.current()
        if now is None:
            raise FileNotFoundError(f"no version of {self.path} has been published")
        return f"{self.path}/{now['folder']}"

    def publish(self, save: Callable[[str], None], notes: Mapping | None = None) -> str:
        """``save(folder)`` into a new folder, then make it the latest version; returns the folder's path.

        If ``save`` fails nothing is published, and what it wrote is removed.  Of two writers that
        finish at once, each gets a number of its own.
        """
        number = max(self.numbers(), default=0) + 1
        name = f"v{number:08d}-{uuid.uuid4().hex[:12]}"
        try:
            save(f"{self.path}/{name}")
        except BaseException:
            self.files.delete(name)
            raise
        while True:
            manifest = {"number": number, "folder": name, "size": self.files.size(name), "notes": dict(notes or {})}
            if self.files.create(f"{_LOG}/{number:08d}.json", json.dumps(manifest, indent=1)):
                return f"{self.path}/{name}"
            number = max([number, *self.numbers()]) + 1

    def prune(self, keep: int = 1) -> None:
        """Remove all but the latest ``keep`` versions, and folders of writers that died before the oldest kept one."""
        numbers = self.numbers()
        kept = [json.loads(self.files.read(f"{_LOG}/{n:08d}.json")) for n in numbers[-keep:]]
        for n in numbers[:-keep]:
            self.files.delete(f"{_LOG}/{n:08d}.json")
        oldest = min((k["number"] for k in kept), default=0)
        for name in self.files.names():
            if name.startswith("v") and name not in {k["folder"] for k in kept} and int(name[1:9]) <= oldest:
                self.files.delete(name)


def write_one_file(df, path: str, *, spark: SparkSession | None = None) -> None:
    """One headered CSV file under exactly this name, replaced as a whole.

    Spark's committed part file is moved to the name, so nothing but a whole
    report is ever visible there; a write that fails leaves nothing behind and the old file in place.
    Meant for reports of one row per type.
    """
    spark = spark or df.sparkSession
    parent, _, name = path.rstrip("/").rpartition("/")
    files, staging = Files(spark, parent), f".{name}-{uuid.uuid4().hex[:12]}"
    try:
        df.coalesce(1).write.option("header", True).csv(f"{parent}/{staging}")
        part = next(n for n in files.names(staging) if n.startswith("part-"))
        files.replace(f"{staging}/{part}", f"{parent}/{name}")
    finally:
        files.delete(staging)


__all__ = ["Files", "Versions", "write_one_file"]
