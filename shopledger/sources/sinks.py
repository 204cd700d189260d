"""Where report tables go."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.operators.reviews import review_load_errors
from shopledger.operators.tracker import tracker_update
from shopledger.sources.store import Store


def write_report(sheets: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> None:
    """One sub-folder per table of the report, replaced as a whole."""
    for name, df in sheets.items():
        writer = df.write.mode("overwrite")
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.format(fmt).save(f"{folder}/{name}")


def read_report(spark, folder: str, name: str) -> DataFrame:
    """A table an earlier report wrote."""
    return spark.read.parquet(f"{folder}/{name}")


@contextlib.contextmanager
def _staged(df: DataFrame, path: str) -> Iterator[DataFrame]:
    """``df`` as a table beside ``path``, computed once and there until it has been taken in."""
    spark = df.sparkSession
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    try:
        df.write.parquet(staging)
        yield spark.read.schema(df.schema).parquet(staging)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(staging)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_kpis(kpis: DataFrame, path: str) -> None:
    """Takes the figures into the tracker at ``path``: they replace those of the same period, section and metric.

    Only the periods in ``kpis`` are read and written anew; other sections and metrics of theirs stay.
    A figure given twice is refused. The figures are computed once; what was checked is what is written.
    """
    keys = ["period", "section", "metric"]
    with _staged(kpis, path) as staged:
        twice = staged.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").take(1)
        if twice:
            raise ValueError(f"a figure is given more than once: {twice[0].asDict()}")
        periods = [r[0] for r in staged.select("period").distinct().collect()]  # the months of one update

        def merged(present) -> DataFrame:
            known = present(periods)
            return staged if known is None else tracker_update(known.select(*staged.columns), staged)

        Store(kpis.sparkSession, path, "period").commit(None, merged)


def read_kpis(spark: SparkSession, path: str) -> DataFrame | None:
    """The tracker that ``write_kpis`` keeps at ``path``."""
    return Store(spark, path, "period").read()


def load_reviews(load_set: DataFrame, path: str, batch: str | None = None) -> bool:
    """Adds the reviews that ``path`` does not hold yet, or none at all if any row has no readable date or rating.

    Reviews are known by id, so loading a set again adds nothing; a ``batch`` that was loaded before
    is not even looked at (False). Of several rows with one id the first in the order of all columns
    is loaded. What was checked is what is written, even if the source changes meanwhile.
    """
    with _staged(load_set, path) as staged:
        bad = review_load_errors(staged).take(10)
        if bad:
            raise ValueError(f"reviews not loaded, unreadable rows: {[r.asDict() for r in bad]}")
        once = staged.groupBy("id").agg(F.min(F.struct(*staged.columns)).alias("row")).select("row.*")

        def fresh(present) -> DataFrame:
            known = present(None)
            return once if known is None else once.join(known.select("id"), "id", "left_anti").select(*once.columns)

        return Store(load_set.sparkSession, path).commit(batch, fresh)


def loaded_reviews(spark: SparkSession, path: str) -> DataFrame | None:
    """The reviews that ``load_reviews`` keeps at ``path``."""
    return Store(spark, path).read()
