"""Registry of stage tables: found again by content, resumed after a lost driver, removed by their owner.

A stage is a parquet folder and a manifest. The manifest is written after the table is
whole, by renaming a finished file, so a stage with a manifest is complete and one without
does not exist. Its name holds a key of the stage's inputs and parameters: the same key
finds the same table in a later run, another key builds a new one.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class _Files:
    """The few operations on Hadoop file systems that the registry needs."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def read(self, name: str) -> str | None:
        if not self.fs.exists(self.path(name)):
            return None
        stream = self.fs.open(self.path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Whole or not at all: a temporary file is renamed."""
        temporary = self.path(f"{name}.{uuid.uuid4().hex}.tmp")
        stream = self.fs.create(temporary)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self.fs.rename(temporary, self.path(name)):
            self.fs.delete(temporary, False)

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def names(self, folder: str) -> list[str]:
        if not self.fs.exists(self.path(folder)):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(folder)))


def content_key(spark: SparkSession, paths: Sequence[str] = (), **params) -> str:
    """Key of input files (names, sizes, times of change) and parameters."""
    digest = hashlib.sha256(json.dumps(params, sort_keys=True, default=str).encode())
    for root in sorted(paths):
        files = _Files(spark, root)
        found = files.fs.listFiles(files.path(root), True)
        rows = []
        while found.hasNext():
            s = found.next()
            rows.append(f"{s.getPath().toString()} {s.getLen()} {s.getModificationTime()}")
        digest.update("\n".join(sorted(rows)).encode())
    return digest.hexdigest()[:32]


class StageRegistry:
    """Stages of one owner below a shared folder."""

    def __init__(self, spark: SparkSession, root: str, owner: str):
        if not owner or "/" in owner:
            raise ValueError("an owner is a name without slashes")
        self.spark, self.root, self.owner = spark, root.rstrip("/"), owner
        self.files = _Files(spark, root)

    def _manifest(self, name: str, key: str) -> str:
        return f"{self.root}/_manifests/{self.owner}/{name}-{key}.json"

    def stage(
        self,
        name: str,
        key: str,
        build: Callable[[], DataFrame],
        lifetime: timedelta | None = None,
        partition_by: Sequence[str] = (),
    ) -> DataFrame:
        """The stage's table, re-read; ``build`` is called only if no whole table has this key.

        What an interrupted run left without a manifest is overwritten. Rows are rebalanced
        by the partition columns. Without a ``lifetime`` the stage stays until its owner
        removes it.
        """
        found = self.files.read(self._manifest(name, key))
        if found is None:
            path = f"{self.root}/{self.owner}/{name}-{key}"
            began = time.time()
            made = build()
            rows = made.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else made
            rows.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
            now = time.time()
            entry = {
                "name": name, "key": key, "owner": self.owner, "path": path, "schema": made.schema.json(),
                "written": now, "seconds": now - began, "expires": None if lifetime is None else now + lifetime.total_seconds(),
            }
            self.files.write(self._manifest(name, key), json.dumps(entry))
        else:
            entry = json.loads(found)
        schema = StructType.fromJson(json.loads(entry["schema"]))
        return self.spark.read.schema(schema).parquet(entry["path"]).select(*schema.names)

    def entries(self) -> list[dict]:
        """Manifests of the owner's stages."""
        folder = f"{self.root}/_manifests/{self.owner}"
        found = (self.files.read(f"{folder}/{n}") for n in self.files.names(folder) if n.endswith(".json"))
        return [json.loads(text) for text in found if text]

    def _drop(self, entry: dict) -> None:
        # the manifest goes first: without it the table does not exist
        self.files.delete(self._manifest(entry["name"], entry["key"]))
        self.files.delete(entry["path"])

    def expire(self, now: float | None = None) -> int:
        """Remove the owner's stages whose lifetime is over; returns their number."""
        moment = time.time() if now is None else now
        old = [e for e in self.entries() if e["expires"] is not None and e["expires"] <= moment]
        for entry in old:
            self._drop(entry)
        return len(old)

    def remove(self) -> None:
        """Remove all of the owner's stages, and what interrupted runs left."""
        for entry in self.entries():
            self._drop(entry)
        self.files.delete(f"{self.root}/{self.owner}")
        self.files.delete(f"{self.root}/_manifests/{self.owner}")
