"""Token counts by source, language and tokenizer version, maintained by signed deltas.

A ``Ledger`` is a folder on shared storage:

* ``documents/<batch>``: what a batch said of each (document, version): source, language, tokens, or
  that it was deleted;
* ``deltas/<batch>``: the signed change of documents and tokens of each (source, language, version);
* ``commits``: one empty file ``<number>-<batch>`` for each batch that counts.

A batch is written first and counts from the moment its commit file exists, which is created in one
step. A batch that is committed already is left alone, and one that broke off is written over by its
next attempt, so a batch may be sent any number of times. Totals are the sum of the deltas; nothing
old is read again but the last word on the documents that a batch changes.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHANGES = "id bigint, version string, deleted boolean, source string, lang string, tokens bigint, seq bigint"
_STATE = "id bigint, version string, deleted boolean, source string, lang string, tokens bigint, number int"
_DELTA = "source string, lang string, version string, docs bigint, tokens bigint"


def counted(docs: DataFrame, patterns: Mapping[str, str], text: str = "text") -> DataFrame:
    """``docs`` with ``version, tokens`` once for each version: the matches of its pattern in the whole text.

    A null text has 0 tokens. Columns of these names are replaced.
    """
    each = [
        F.struct(F.lit(v).alias("version"), F.coalesce(F.regexp_count(F.col(text), F.lit(p)), F.lit(0)).cast("long").alias("tokens"))
        for v, p in patterns.items()
    ]
    own = [c for c in docs.columns if c not in ("version", "tokens")]
    return docs.select(*own, F.explode(F.array(*each)).alias("_count")).select(*own, "_count.version", "_count.tokens")


def changes(
    counts: DataFrame, id: str = "doc_id", source: str = "source", lang: str = "lang", deleted: bool = False, seq: int = 0
) -> DataFrame:
    """Rows for ``Ledger.commit``: inserts or revised counts, or deletions. Other columns are left out."""
    return counts.select(
        F.col(id).cast("long").alias("id"),
        "version",
        F.lit(deleted).alias("deleted"),
        F.col(source).alias("source"),
        F.col(lang).alias("lang"),
        F.col("tokens").cast("long").alias("tokens"),
        F.lit(seq).cast("long").alias("seq"),
    )


class Ledger:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/commits")
        self._files, self._commits = path.getFileSystem(spark._jsc.hadoopConfiguration()), path
        self._files.mkdirs(path)

    def batches(self) -> list[str]:
        """Committed batches, oldest first."""
        names = [f.getPath().getName() for f in self._files.listStatus(self._commits)]
        return [n.partition("-")[2] for n in sorted(names)]

    def _read(self, what: str, schema: str, batches: list[str]) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.folder}/{what}/{b}" for b in batches])

    def commit(self, batch: str, changed: DataFrame) -> bool:
        """Take in a batch (columns ``CHANGES``); ``False`` if it was committed before.

        Of several rows for one (document, version) the one with the greatest ``seq`` counts, of equal
        ones a deletion, then the greatest by the other columns. Rows without an id or a version are
        left out. Null tokens are 0, null sources and languages are groups of their own. Deleting what
        is not there changes nothing, and a later insert brings a document back.
        """
        if not re.fullmatch(r"[\w.]+", batch):
            raise ValueError(f"not a batch name: {batch!r}")
        done = self.batches()
        if batch in done:
            return False
        word = F.struct("seq", "deleted", "source", "lang", F.coalesce("tokens", F.lit(0)).alias("tokens"))
        known = changed.filter("id is not null and version is not null").groupBy("id", "version")
        new = known.agg(F.max(word).alias("w")).select("id", "version", "w.deleted", "w.source", "w.lang", "w.tokens")
        new = new.withColumn("number", F.lit(len(done)))
        new.write.mode("overwrite").parquet(f"{self.folder}/documents/{batch}")
        new = self._read("documents", _STATE, [batch])
        keys = new.select("id", "version")
        signed = new.filter("not deleted").select("source", "lang", "version", F.lit(1).alias("docs"), "tokens")
        # The last word of earlier batches on these documents is taken back.
        past = self._read("documents", _STATE, done).join(keys, ["id", "version"], "left_semi").groupBy("id", "version")
        old = past.agg(F.max(F.struct("number", "deleted", "source", "lang", "tokens")).alias("w")).filter("not w.deleted")
        old = old.select("w.source", "w.lang", "version", F.lit(-1).alias("docs"), (-F.col("w.tokens")).alias("tokens"))
        signed = signed.unionByName(old)
        delta = signed.groupBy("source", "lang", "version").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        delta = delta.filter("docs != 0 or tokens != 0")
        delta.write.mode("overwrite").parquet(f"{self.folder}/deltas/{batch}")
        name = self.spark._jvm.org.apache.hadoop.fs.Path(self._commits, f"{len(done):08d}-{batch}")
        self._files.create(name, False).close()
        return True

    def totals(self) -> DataFrame:
        """``source, lang, version, docs, tokens`` of all committed batches; groups without documents go."""
        rows = self._read("deltas", _DELTA, self.batches()).groupBy("source", "lang", "version")
        return rows.agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).filter("docs != 0 or tokens != 0")
