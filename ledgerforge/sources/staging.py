"""Written intermediate tables: one evaluation, short lineage, known size."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Mapping, Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.session import session_settings, task_settings
from ledgerforge.sources.publication import ROW_GROUPS

#: Files are read a few times and dropped, so they are packed like published ones.
STAGED_FILES = ROW_GROUPS


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; a local one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("Set spark.checkpoint.dir to a folder that every executor can reach.")
    return tempfile.mkdtemp(prefix="ledgerforge-")


class Staging:
    """Keeps frames as Parquet under one run folder.

    A kept frame is read back from files, so losing executors costs a re-read and not a
    recomputation, several consumers share one evaluation, and the planner knows its size
    (which is what lets it broadcast short lists of problem keys and nothing larger). Frames are evaluated
    with `settings` of the session; `bounded` does so in pieces that a task can sort in memory, and writes such.
    """

    def __init__(
        self,
        spark: SparkSession,
        label: str = "ledger",
        namespace: str = "default",
        settings: Mapping[str, str] = {},
        bounded: bool = False,
    ):
        self.spark = spark
        self.mark = uuid4().hex
        self.folder = f"{shared_folder(spark)}/{label}-{self.mark}"
        self.namespace = namespace
        self.settings = settings
        self.bounded = bounded
        self.files = STAGED_FILES if bounded else {}
        self._names: set[str] = set()
        self._tables: list[str] = []

    def keep(
        self, df: DataFrame, name: str, partition_by: Sequence[str] = (), bucket: tuple[int, *tuple[str, ...]] | None = None
    ) -> DataFrame:
        """Write a frame and read it back; with `partition_by` in a folder per value of these columns.

        With `bucket`, a number and a column, rows are dealt into that many buckets by the column's hash, which
        joins and aggregates by it find and do not deal again. They are sorted by it and by further columns named.
        Buckets are known to the catalog only, so the frame is a table of `namespace` until it is released.
        """
        if name in self._names:
            raise ValueError(f"Already staged: {name}")
        self._names.add(name)
        pieces = task_settings(self.spark) if self.bounded else {}
        with session_settings(self.spark, {**pieces, **self.settings}):
            return self._write(df, name, partition_by, bucket)

    def _write(
        self, df: DataFrame, name: str, partition_by: Sequence[str], bucket: tuple[int, *tuple[str, ...]] | None
    ) -> DataFrame:
        path = f"{self.folder}/{name}"
        if partition_by:
            # Few files per folder, while adaptive execution splits a value with too many rows.
            df = df.hint("rebalance", *map(F.col, partition_by))
            df.write.options(**self.files).partitionBy(*partition_by).parquet(path)
            return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)
        if bucket:
            table = f"{self.namespace}.staged_{self.mark}_{name}"
            self._tables.append(table)
            writer = df.write.options(path=path, **self.files).bucketBy(*bucket[:2]).sortBy(*bucket[1:])
            writer.format("parquet").saveAsTable(table)
            return self.spark.table(table)
        df.write.options(**self.files).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        """Delete the run folder. Frames that were kept cannot be read afterwards."""
        while self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._tables.pop()}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_exc) -> None:
        self.release()
