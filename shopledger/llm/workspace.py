"""Intermediate tables in the folder that all executors and the driver share."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local session without one gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="llm-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


class Workspace:
    """A folder of its own for one call of an operator.

    ``keep`` writes a table as Parquet and reads it again, which cuts its lineage: a lost executor
    costs the tasks that ran on it, not the history before. ``drop`` deletes a table that is no
    longer read. Shuffle files of a finished write are deleted with it.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self._count = 0

    def path(self, name: str) -> str:
        self._count += 1
        return f"{self.root}/{self._count:03d}-{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        with setting(self.spark, _CLEANUP, "true"):
            # The writer plans anew under this setting.
            df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._kept_at = path
        return out

    def drop(self, df: DataFrame) -> None:
        path = getattr(df, "_kept_at", None)
        if path:
            hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(hadoop, True)
