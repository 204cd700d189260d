"""Logical table names resolved to DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession


class Catalog:
    """Looks tables up by name: a builder if one is registered, else the base source.

    The base is a folder of Parquet tables, or any DataFrame reader format
    (``jdbc`` with its url and driver, for instance) taking the name as ``dbtable``.
    """

    def __init__(
        self,
        spark: SparkSession,
        base: str = "",
        builders: Mapping[str, Callable[[Catalog], DataFrame]] | None = None,
        reader: str | None = None,
        options: Mapping[str, str] | None = None,
    ) -> None:
        self.spark = spark
        self.base = base
        self.builders = dict(builders or {})
        self.reader = reader
        self.options = dict(options or {})
        self._opened: dict[str, DataFrame] = {}

    def source(self, name: str) -> DataFrame:
        """A base table, opened (listed, its schema read) once per catalog."""
        if name not in self._opened:
            self._opened[name] = self._open(name)
        return self._opened[name]

    def _open(self, name: str) -> DataFrame:
        if self.reader:
            return self.spark.read.format(self.reader).options(**self.options).option("dbtable", name).load()
        return self.spark.read.parquet(f"{self.base}/{name}.parquet")

    def table(self, name: str) -> DataFrame:
        builder = self.builders.get(name)
        return builder(self) if builder else self.source(name)
