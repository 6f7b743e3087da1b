"""Versions of a set of tables, published as a whole.

Each refresh writes to a folder of its own under ``root/versions``. It counts once an empty file with its name lies
under ``root/published``; making that file is one step in every store, so readers see all tables of one version or all
of another, and a refresh that dies leaves the published ones as they were. The newest name is the current version.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class Snapshots:
    """The versions under one folder. ``kept`` older ones stay behind the current one, for readers that began before."""

    def __init__(self, spark: SparkSession, root: str, kept: int = 1):
        self.spark, self.root, self.kept = spark, root.rstrip("/"), kept

    def _path(self, *parts: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    @property
    def _files(self):
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        where = self._path(folder)
        return sorted(s.getPath().getName() for s in self._files.listStatus(where)) if self._files.exists(where) else []

    def published(self) -> list[str]:
        """Names of the published versions, oldest first."""
        return self._names("published")

    def folder(self, version: str | None = None) -> str:
        """Where the tables of a version lie; of the current one without a name."""
        if version is None:
            names = self.published()
            if not names:
                raise FileNotFoundError(f"nothing is published under {self.root}")
            version = names[-1]
        return f"{self.root}/versions/{version}"

    def table(self, name: str, version: str | None = None, schema: StructType | None = None) -> DataFrame:
        """A table of a version. An empty table laid out by day has no file to take its schema from: give it then."""
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(f"{self.folder(version)}/{name}")

    def publish(self, version: str) -> None:
        """From now on `version` is the current one."""
        self._files.create(self._path("published", version), False).close()

    def drop(self, version: str) -> None:
        self._files.delete(self._path("published", version), False)
        self._files.delete(self._path("versions", version), True)

    def drop_old(self) -> None:
        """Removes all published versions but the newest and the ``kept`` before it."""
        for version in self.published()[: -1 - self.kept]:
            self.drop(version)

    def drop_unfinished(self, older_than_seconds: float) -> None:
        """Removes what refreshes that died have left. Give an age beyond that of any refresh that still runs."""
        limit = f"{int((time.time() - older_than_seconds) * 1000):015d}"
        for version in set(self._names("versions")) - set(self.published()):
            if version < limit:
                self.drop(version)

    @contextmanager
    def refresh(self) -> Iterator[str]:
        """A new version's folder to write to: published when the block ends well, removed when it fails."""
        version = f"{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:12]}"
        try:
            yield self.folder(version)
        except BaseException:
            self.drop(version)
            raise
        self.publish(version)
        self.drop_old()
