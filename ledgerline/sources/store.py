"""Parquet tables with one folder per batch.

A replaced batch is a new folder of files beside the old one, never changed afterwards, and a small file
in the batch's folder names the one that counts.  Replacing is one atomic rename of that file, so readers
meet the old batch or the new one and never none; a run that dies before the rename has changed nothing.
The version before stays until the next replacement, for readers that have begun with it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Characters that Spark writes as %XX in partition folders, besides control characters.
_ESCAPED = frozenset("\"#%'*/:=?\\\x7f{[]^")

_POINTER, _VERSION = "_current", "v-"


def partition_value(value: str) -> str:
    """A batch id as Spark names its folder, so that ids with any characters are found again."""
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED or c < " " else c for c in value)


class Store:
    """Tables under one root.  A batch is the unit of replacement."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, table: str, batch_id: str | None = None) -> str:
        return f"{self.root}/{table}" + (f"/batch_id={partition_value(batch_id)}" if batch_id is not None else "")

    def _fs(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def exists(self, table: str, batch_id: str | None = None) -> bool:
        if batch_id is not None:
            return bool(self._current(table, batch_id))
        fs, target = self._fs(self._path(table))
        return fs.exists(target)

    def _pointer(self, folder: str) -> dict:
        """What counts of a batch: its version, and the appended files that the version replaced."""
        fs, target = self._fs(f"{folder}/{_POINTER}")
        if not fs.exists(target):
            return {"version": None, "replaced": []}
        stream = fs.open(target)
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def _listed(self, folder: str) -> tuple[list[str], list[str]]:
        """Version folders and appended files of a batch."""
        fs, target = self._fs(folder)
        if not fs.exists(target):
            return [], []
        found = [(status.isDirectory(), status.getPath().getName()) for status in fs.listStatus(target)]
        return [n for d, n in found if d and n.startswith(_VERSION)], [n for d, n in found if not d and n[0] not in "._"]

    def _current(self, table: str, batch_id: str | None = None, folder: str | None = None) -> list[str]:
        """Paths that make up a batch: its version and the files appended since."""
        folder = folder or self._path(table, batch_id)
        pointer = self._pointer(folder)
        versions, files = self._listed(folder)
        if not versions:  # appended files alone
            return [folder] if files else []
        kept = sorted(set(files) - set(pointer["replaced"]))
        return [f"{folder}/{name}" for name in [pointer["version"], *kept] if name]

    def _point(self, folder: str, pointer: dict) -> None:
        """Name the version that counts: the one step that readers see."""
        jvm = self.spark._jvm
        fs, made = self._fs(f"{folder}/{_POINTER}-{uuid.uuid4().hex}")
        _, target = self._fs(f"{folder}/{_POINTER}")
        stream = fs.create(made, False)
        try:
            stream.write(json.dumps(pointer).encode())
        finally:
            stream.close()
        overwrite = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(fs.makeQualified(made), fs.makeQualified(target), overwrite)

    def replace(self, table: str, batch_id: str, df: DataFrame) -> DataFrame:
        """Replace one batch, also by an empty result; other batches stay.

        The new rows may be made from the old ones.  A dynamic partition overwrite would keep the
        old rows when the new result is empty.
        """
        folder, version = self._path(table, batch_id), f"{_VERSION}{uuid.uuid4().hex}"
        df.drop("batch_id").write.parquet(f"{folder}/{version}")
        before, (versions, files) = self._pointer(folder), self._listed(folder)
        self._point(folder, {"version": version, "replaced": files})
        for old in [*(v for v in versions if v not in (version, before["version"])), *before["replaced"]]:
            fs, target = self._fs(f"{folder}/{old}")
            fs.delete(target, True)
        return self.batch(table, batch_id)

    def purge(self, table: str, batch_id: str) -> None:
        fs, target = self._fs(self._path(table, batch_id))
        fs.delete(target, True)

    def append(self, table: str, df: DataFrame) -> None:
        """Append to a batch-keyed table, one folder per batch."""
        df.write.mode("append").partitionBy("batch_id").parquet(self._path(table))

    def batch(self, table: str, batch_id: str) -> DataFrame:
        """One batch: only its files are read, with their own columns."""
        paths = self._current(table, batch_id)
        df = self.spark.read.option("mergeSchema", len(paths) > 1).option("basePath", self._path(table)).parquet(*paths)
        return df.select(F.lit(batch_id).alias("batch_id"), *[c for c in df.columns if c != "batch_id"])

    def _batches(self, table: str) -> list[str]:
        fs, target = self._fs(self._path(table))
        folders = [status.getPath().toString() for status in fs.listStatus(target) if status.getPath().getName().startswith("batch_id=")]
        return [path for folder in folders for path in self._current(table, folder=folder)]

    def table(self, table: str) -> DataFrame:
        """All batches; columns that a batch lacks are NULL.  Batch ids stay text."""
        reader = self.spark.read.option("basePath", self._path(table))
        paths = self._batches(table)
        schema = reader.option("mergeSchema", True).parquet(*paths).schema
        fields = [
            T.StructField(f.name, T.StringType() if f.name == "batch_id" else f.dataType) for f in schema
        ]
        df = self.spark.read.option("basePath", self._path(table)).schema(T.StructType(fields)).parquet(*paths)
        return df.select("batch_id", *[c for c in df.columns if c != "batch_id"])


def latest_batch(files: DataFrame) -> DataFrame:
    """The batch ingested last, one row (ties by id)."""
    return files.orderBy(F.desc("ingested_at_utc"), "batch_id").limit(1).select("batch_id")
