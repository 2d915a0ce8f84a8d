"""Versioned tables: readers follow a pointer to one whole version, writers apply each batch once."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class Versions:
    """A table as folders of versions and a pointer file that names the current one and the last batch in it.

    A version is written in full and read back before the pointer moves, and the pointer moves by one atomic rename. So a
    reader sees the version before or the one after, never a part; a job that dies before the rename has changed nothing; and
    a batch that comes again is known by its id and left out. There must be one writer at a time, as a stream has.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keep: int = 2):
        self.spark, self.path, self.schema, self.keep = spark, path.rstrip("/"), schema, max(1, keep)
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _pointer(self) -> dict:
        at = self._path(f"{self.path}/_current")
        if not self._files.exists(at):
            return {"versions": [], "batch": -1}
        stream = self._files.open(at)
        try:
            return json.loads(bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    @property
    def batch(self) -> int:
        """The last batch that is in the table; -1 for none."""
        return self._pointer()["batch"]

    def read(self) -> DataFrame:
        """The current version; an empty table before the first."""
        held = self._pointer()["versions"]
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{held[-1]}") if held else self.spark.createDataFrame([], self.schema)

    def publish(self, make: Callable[[DataFrame], DataFrame], batch: int, verify: Callable[[DataFrame, DataFrame], bool] | None = None) -> bool:
        """Make the next version from the current one, unless the batch is in it already; whether it was made.

        verify(written, current) decides whether what is read back may go live; if not, or if make fails, the current version
        stays. Versions beyond the last `keep` are deleted, so that readers of the one before can end.
        """
        now = self._pointer()
        if batch <= now["batch"]:
            return False
        current, name = self.read(), f"v-{batch:012d}-{uuid.uuid4().hex[:12]}"
        make(current).select(*self.schema.fieldNames()).write.parquet(f"{self.path}/{name}")
        written = self.spark.read.schema(self.schema).parquet(f"{self.path}/{name}")
        if verify is not None and not verify(written, current):
            self._files.delete(self._path(f"{self.path}/{name}"), True)
            raise ValueError(f"version {name} of {self.path} does not hold what it should; the one before stays")
        versions = [*now["versions"], name]
        self._swap({"versions": versions[-self.keep :], "batch": batch})
        for old in versions[: -self.keep]:
            self._files.delete(self._path(f"{self.path}/{old}"), True)
        return True

    def _swap(self, pointer: dict) -> None:
        beside = self._path(f"{self.path}/_next-{uuid.uuid4().hex}")
        stream = self._files.create(beside, True)
        try:
            stream.write(bytearray(json.dumps(pointer).encode()))
        finally:
            stream.close()
        jvm = self.spark._jvm
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files.getUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(self._files.makeQualified(beside), self._files.makeQualified(self._path(f"{self.path}/_current")), options)

    def unfinished(self) -> list[str]:
        """Folders of versions that no pointer names: what broken batches have left. They may be deleted while no writer runs."""
        held = set(self._pointer()["versions"])
        return sorted(os.path.basename(s.getPath().toString()) for s in self._files.listStatus(self._path(self.path)) if s.getPath().getName().startswith("v-") and s.getPath().getName() not in held)
