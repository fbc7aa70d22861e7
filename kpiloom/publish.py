"""Publication of a refresh in one step.

Every refresh writes into a release folder that nothing refers to. When all of it is there and the
gates have passed, one file, the manifest, is replaced: readers resolve names through it, so they
see the old set or the new one and never a mixture. A run that dies leaves the manifest, and with
it the old set, as it was. Releases that the manifest lists no longer are removed some switches
later, when their readers are done.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from kpiloom.store import delete

MANIFEST = "CURRENT.json"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _exists(spark: SparkSession, path: str) -> bool:
    at = _path(spark, path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def manifest(spark: SparkSession, root: str) -> dict | None:
    """What is published under ``root``; None before the first release."""
    path = f"{root}/{MANIFEST}"
    if not _exists(spark, path):
        return None
    return json.loads(spark.read.text(path, wholetext=True).first().value)


class Release:
    """A release being written; ``switch`` makes it the published one."""

    def __init__(self, spark: SparkSession, root: str, keep: int = 2):
        """``keep``: releases that stay readable, the new one included."""
        if keep < 1:
            raise ValueError("a release cannot remove itself: keep must be 1 or more")
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep
        self.name = f"{datetime.now(UTC):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"
        self.folder = f"{self.root}/releases/{self.name}"
        self.entries: dict[str, dict] = {}

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def register(self, name: str, schema: StructType, path: str | None = None, fmt: str = "parquet") -> None:
        """List a table that was written to ``path`` (relative to the release) as ``name``."""
        self.entries[name] = {"path": path or name, "format": fmt, "schema": schema.jsonValue()}

    def write(self, name: str, df: DataFrame, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> None:
        writer = df.write.format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(self.path(name))
        self.register(name, df.schema, fmt=fmt)

    def switch(self, run: Mapping[str, object]) -> None:
        """Publish: write the manifest aside and rename it over the old one."""
        before = manifest(self.spark, self.root)
        releases = [self.name, *(before["releases"] if before else [])]
        kept, gone = releases[: self.keep], releases[self.keep :]
        text = json.dumps({
            "release": self.name, "published_at": f"{datetime.now(UTC):%Y-%m-%d %H:%M UTC}",
            "releases": kept, "run": dict(run), "tables": self.entries,
        }, indent=1, allow_nan=False)
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        aside, current = _path(self.spark, f"{self.root}/_{self.name}.json"), _path(self.spark, f"{self.root}/{MANIFEST}")
        stream = aside.getFileSystem(conf).create(aside, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), conf).rename(aside, current, options)
        for name in gone:
            delete(self.spark, f"{self.root}/releases/{name}")

    def abandon(self) -> None:
        """Remove what was written; nothing refers to it."""
        delete(self.spark, self.folder)


class Published:
    """The tables of one release, fixed when the object is made."""

    def __init__(self, spark: SparkSession, root: str):
        found = manifest(spark, root)
        if found is None:
            raise FileNotFoundError(f"nothing is published in {root}")
        self.spark, self.folder = spark, f"{root.rstrip('/')}/releases/{found['release']}"
        self.release, self.run, self._tables = found["release"], found["run"], found["tables"]

    def names(self) -> list[str]:
        return sorted(self._tables)

    def table(self, name: str) -> DataFrame:
        entry = self._tables[name]
        schema = StructType.fromJson(entry["schema"])
        path = f"{self.folder}/{entry['path']}"
        if not _exists(self.spark, path):  # no row of a partitioned table went there
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).format(entry["format"])
        if entry["format"] == "csv":
            reader = reader.option("header", True)
        return reader.load(path).select(*[f"`{c}`" for c in schema.names])
