"""From raw documents to training sequences: quality, near copies, repeated passages, mix, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one before kept; all but the
last return the columns of ``documents``. ``run`` writes each result as Parquet to the shared folder
and reads it again for the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopledger.llm import mixing, neardup, packing, quality, substrings
from shopledger.llm.fitting import remainder
from shopledger.llm.queries import tokenizer_file
from shopledger.llm.workspace import Workspace

#: Training labels and rounding draws have no SQL form.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranking puts over its threshold, trained on labels that aren't held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, labels, ~F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)))
    return quality.score(docs, model).filter("predicted = 1").select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the least id.

    Every row counts with its own text, whatever its id; of equal rows one stays.
    """
    stays = neardup.near_duplicates(docs).filter("stays").select(F.col("doc_id").alias("kept_id"), F.col("mark").alias("kept_mark")).distinct()
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("id"), neardup.text_mark("text").alias("mark"))
    same = W.partitionBy("id", "mark").orderBy(F.xxhash64("doc"))
    once = rows.withColumn("nth", F.row_number().over(same)).filter("nth = 1")
    kept = once.join(stays, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("mark") == F.col("kept_mark")), "left_semi")
    return kept.select("doc.*")


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 13 words or more that a document with a smaller id has."""
    cut = substrings.remove_repeats(docs).select(*docs.columns)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.repeated(mixing.mix_sources(docs), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences with their ids."""
    return packing.pack(docs, tokenizer_file())


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", without_near_copies),
    ("substrings", without_repeats),
    ("mixing", mixed),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = work.keep(stage(spark, docs, sf_dir), name)
    return docs
