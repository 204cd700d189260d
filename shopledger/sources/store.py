"""Tables in a shared folder that change by whole commits, and inputs staged once for many reports."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.sources.catalog import Catalog

#: Writers that lose the race for a commit start over from the newer state this often.
ATTEMPTS = 20


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local session without one gets a temporary folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="shopledger-")


def run_folder(spark: SparkSession, name: str) -> str:
    """A new name for a folder in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


class Store:
    """A Parquet table whose rows belong to parts, where a commit replaces or adds whole parts.

    Data goes into a folder of its own for each commit; ``_commits/<number>.json`` names, for every
    part, the folder that holds it, and the batches taken in so far. A commit file is created
    exclusively, so that of two writers with the same number one starts over; readers see whole
    commits only. ``part`` is the column that tells parts apart; without it each commit adds a part.
    """

    def __init__(self, spark: SparkSession, path: str, part: str | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.part = part
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._files = self._hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _commit_file(self, number: int):
        return self._hadoop.Path(f"{self.path}/_commits/{number:010d}.json")

    def state(self) -> tuple[int, dict]:
        """Number and content of the last whole commit; 0 and nothing before the first."""
        folder = self._hadoop.Path(f"{self.path}/_commits")
        names = [f.getPath().getName() for f in self._files.listStatus(folder)] if self._files.exists(folder) else []
        for number in sorted((int(n[:10]) for n in names if n.endswith(".json")), reverse=True):
            stream = self._files.open(self._commit_file(number))
            try:
                text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            try:
                return number, json.loads(text)
            except ValueError:  # being written at this moment
                continue
        return 0, {"parts": {}, "batches": []}

    def _create(self, number: int, state: dict) -> bool:
        file = self._commit_file(number)
        if self._files.exists(file):
            return False
        try:
            stream = self._files.create(file, False)
        except Exception:
            if self._files.exists(file):
                return False
            raise
        stream.write(json.dumps(state, sort_keys=True).encode())
        stream.close()
        return True

    def _select(self, state: dict, parts: list[str] | None, schema) -> DataFrame | None:
        held = {p: f for p, f in state["parts"].items() if parts is None or p in parts}
        if not held:
            return None
        folders = sorted(set(held.values()))
        df = self.spark.read.schema(schema) if schema is not None else self.spark.read
        df = df.option("basePath", f"{self.path}/data").parquet(*[f"{self.path}/data/commit={f}" for f in folders])
        if self.part:
            own = [(F.col("commit") == f) & F.col(self.part).isin([p for p, g in held.items() if g == f]) for f in folders]
            wanted = own[0]
            for more in own[1:]:
                wanted = wanted | more
            df = df.filter(wanted)
        return df.drop("commit")

    def read(self, schema=None) -> DataFrame | None:
        """The table after the last commit; None before the first."""
        return self._select(self.state()[1], None, schema)

    def commit(self, batch: str | None, build: Callable[[Callable[[list[str] | None], DataFrame | None]], DataFrame]) -> bool:
        """Takes in what ``build`` makes of the present state; False if ``batch`` has been taken in before.

        ``build`` gets a reader of the present rows of some parts (all if None) and returns the new
        rows of each part it names. It is called again if another writer was faster.
        """
        for _ in range(ATTEMPTS):
            number, state = self.state()
            if batch is not None and batch in state["batches"]:
                return False
            folder = uuid.uuid4().hex
            rows = build(lambda parts: self._select(state, parts, None))  # noqa: B023
            target = f"{self.path}/data/commit={folder}"
            rows.write.parquet(target)
            written = self.spark.read.schema(rows.schema).parquet(target)
            # One name for each part of this commit, not for each row.
            names = [r[0] for r in written.select(self.part).distinct().collect()] if self.part else [folder]
            state = {
                "parts": {**state["parts"], **dict.fromkeys(names, folder)},
                "batches": [*state["batches"], *([batch] if batch is not None else [])],
            }
            if self._create(number + 1, state):
                return True
        raise RuntimeError(f"{self.path}: other writers committed {ATTEMPTS} times in between")


class StagedCatalog(Catalog):
    """A catalog that writes the named tables to a folder when they are first used, and reads them from there.

    The folder is that of one report month: all its reports, and runs after a failure, share what is
    there. A table counts as staged when Spark has marked its folder as complete.
    """

    def __init__(self, base: Catalog, folder: str, names: Mapping[str, list[str] | None]):
        super().__init__(base.spark, base.base, base.builders, base.reader, base.options)
        self._opened = base._opened
        self.folder = folder.rstrip("/")
        self.names = dict(names)

    def table(self, name: str) -> DataFrame:
        if name not in self.names:
            return super().table(name)
        path = f"{self.folder}/{name}"
        marker = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        if not marker.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(marker):
            rows = super().table(name)
            wanted = self.names[name]
            (rows.select(*wanted) if wanted else rows).write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)
