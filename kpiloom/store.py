"""Tables written to the folder that every executor shares.

Lineage is cut here and nowhere else: a written table survives the loss of any
executor, has exact statistics for the planner, and is read back with column and
partition pruning.
"""

from __future__ import annotations

import itertools
import tempfile
import threading
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"

#: Where a row of a table written in order stands: range of the order, file, row in the file.
PLACE = ("_range", "_file", "_row")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by the cluster; a fresh temporary one only in local mode."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    folder = folder or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_DIR} must name a folder shared by all executors")
    return _local_folder()


_LOCAL: list[str] = []


def _local_folder() -> str:
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="kpiloom-"))
    return _LOCAL[0]


def delete(spark: SparkSession, folder: str) -> None:
    """Delete a folder on the file system it lives on; a missing one is fine."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffles that nothing refers to; else they stay until the driver's heap is full."""
    spark._jvm.System.gc()


class TableStore:
    """Named Parquet tables under one folder, each written once per refresh.

    Intermediate results have a folder of their own in the shared folder; ``drop_work`` removes it.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        own = f"{shared_folder(spark).rstrip('/')}/kpiloom-{uuid.uuid4().hex}"
        self.root = root or own
        self.work = f"{own}/work"
        self.schemas: dict[str, object] = {}
        self._cuts = itertools.count()
        self._here = threading.local()

    def path(self, name: str) -> str:
        return f"{self.work if name.startswith('_') else self.root}/{name}"

    def put(
        self,
        name: str,
        df: DataFrame | Iterable[DataFrame],
        partition_by: tuple[str, ...] = (),
        rebalance: bool = False,
    ) -> DataFrame:
        """Full refresh of one table; returns the stored copy.

        ``rebalance`` shuffles on the partition columns first: AQE then sizes the files
        and splits a partition value that holds most of the rows. Of several parts one is written
        after the other, so that only one's shuffles are on disk.
        """
        mode = "overwrite"
        for part in [df] if isinstance(df, DataFrame) else df:
            schema = part.schema
            if rebalance:
                part = part.hint("rebalance", *[F.col(c) for c in partition_by])
            writer = part.write.mode(mode).option("compression", "zstd")
            if partition_by:
                writer = writer.partitionBy(*partition_by)
            if mode == "append":
                drop_shuffles(self.spark)
            writer.parquet(self.path(name))
            mode = "append"
        self.schemas[name] = schema
        return self.get(name)

    def get(self, name: str) -> DataFrame:
        schema = self.schemas.get(name)
        if schema is None:  # written by an earlier application
            return self.spark.read.parquet(self.path(name))
        return self.spark.read.schema(schema).parquet(self.path(name)).select(*schema.names)

    @contextmanager
    def passing(self) -> Iterator[None]:
        """What this thread writes by ``cut`` and ``cut_sorted`` inside is deleted at the end."""
        outer, made = getattr(self._here, "names", None), []
        self._here.names = made
        try:
            yield
        finally:
            self._here.names = outer
            self.forget(*made)

    def forget(self, *names: str) -> None:
        """Delete tables that no later step reads, and the shuffles that led to them."""
        for name in names:
            delete(self.spark, self.path(name))
            self.schemas.pop(name, None)
        drop_shuffles(self.spark)

    def _named(self, label: str) -> str:
        name = f"_{label}_{next(self._cuts)}"
        if getattr(self._here, "names", None) is not None:
            self._here.names.append(name)
        return name

    def drop_work(self) -> None:
        """Delete the intermediate results; plans that still read them have to be built again."""
        delete(self.spark, self.work)

    def discard(self) -> None:
        """Delete everything, once what is wanted from it is published."""
        self.drop_work()
        delete(self.spark, self.root)
        self.schemas.clear()

    def cut_sorted(self, df: DataFrame, by: Sequence[Column]) -> DataFrame:
        """Write ``df`` in order under a name of its own; adds the ``PLACE`` columns.

        Every task of the sort writes one range, files and ranges in the order of the rows. The
        sort's range boundaries are sampled whenever it runs; the written table pins one outcome.
        """
        name = self._named("sorted")
        self.put(name, df.orderBy(*by).withColumn(PLACE[0], F.spark_partition_id()))
        drop_shuffles(self.spark)
        return self.get(name).select(
            "*", F.col("_metadata.file_name").alias(PLACE[1]), F.col("_metadata.row_index").alias(PLACE[2]))

    def cut(self, df: DataFrame, label: str = "cut") -> DataFrame:
        """Write an intermediate result under a name of its own."""
        return self.put(self._named(label), df)
