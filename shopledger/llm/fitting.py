"""Shared parts of the trained operators: labelled rows and samples of them, a solver, and scoring by batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def minimise(
    loss: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, steps: int = 200, memory: int = 8
) -> np.ndarray:
    """A minimum of a smooth convex ``loss`` (value and gradient) by limited-memory quasi-Newton steps."""
    x, (f, g) = start, loss(start)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        q, weights = g.copy(), []
        for s, y in reversed(moves):
            weights.append((s @ q) / (y @ s))
            q -= weights[-1] * y
        if moves:
            s, y = moves[-1]
            q *= (s @ y) / (y @ y)
        for (s, y), a in zip(moves, reversed(weights), strict=True):
            q += (a - (y @ q) / (y @ s)) * s
        slope, step = g @ q, 1.0
        while step > 1e-8:
            new = x - step * q
            f_new, g_new = loss(new)
            if f_new <= f - 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        if (g_new - g) @ (new - x) > 1e-12:
            moves = [*moves[1 - memory :], (new - x, g_new - g)]
        done = f - f_new < 1e-7 * max(1.0, abs(f))
        x, f, g = new, f_new, g_new
        if done:
            break
    return x


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(x, dtype=np.float64)))


def remainder(id: str, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; null ids have none."""
    return F.crc32(F.col(id).cast("string")) % by


def labelled_ids(labels: DataFrame, id: str, label: str, train: Column) -> DataFrame:
    """``id, label`` once for each id: 1 if at least half of its non-null labels are positive."""
    known = labels.filter(F.col(id).isNotNull() & F.col(label).isNotNull()).filter(train)
    positive = (F.avg((F.col(label) > 0).cast("double")) >= 0.5).cast("int")
    return known.groupBy(F.col(id).alias("id")).agg(positive.alias("label"))


def bounded_sample(rows: DataFrame, label: str, key: str, per_label: int) -> DataFrame:
    """At most ``per_label`` rows of each label, those with the least hashes of ``key``.

    Hashes above the share that twice the wanted number needs are left out before the ranking, so
    that no task ranks more than about ``2 * per_label`` rows, whatever the label's frequency.
    """
    counts = rows.groupBy(F.col(label).alias("_label")).agg(F.count(F.lit(1)).alias("_rows"))
    hashed = F.pmod(F.xxhash64(F.lit(11), F.col(key)), F.lit(1 << 40))
    limit = F.col("_rows") * hashed.cast("double") < 2.0 * per_label * float(1 << 40)
    few = F.col("_rows") <= 4 * per_label
    near = rows.join(counts, F.col(label) == F.col("_label")).filter(few | limit)
    order = W.partitionBy(label).orderBy(hashed, F.col(key))
    ranked = near.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= per_label)
    return ranked.select(*rows.columns)


def labelled_texts(docs: DataFrame, chosen: DataFrame, id: str, text: str) -> DataFrame:
    """``text, label`` of all documents whose id is among ``chosen`` (``id, label``, each id once)."""
    texts = docs.select(F.col(id).alias("_labelled_id"), F.col(text).alias("text"))
    return texts.join(chosen, F.col("_labelled_id") == F.col("id")).select("text", "label")


def sampled_texts(
    docs: DataFrame, labels: DataFrame, id: str, text: str, label: str, train: Column, per_label: int
) -> DataFrame:
    """``text, label`` of at most ``per_label`` documents of each of the two labels.

    The ids are chosen on the labels alone; that list has at most ``2 * per_label`` rows of 12 bytes,
    so it is broadcast and no text is shuffled. Only labels whose document exists give a row.
    """
    chosen = bounded_sample(labelled_ids(labels, id, label, train), "label", "id", per_label)
    return labelled_texts(docs, F.broadcast(chosen), id, text)


def with_scores(
    docs: DataFrame,
    text: str,
    keep: Sequence[str],
    added: T.StructType,
    score: Callable[[pa.Array], list[pa.Array]],
    rows: int = 2000,
) -> DataFrame:
    """The columns ``keep`` of all rows and those that ``score`` makes of their whole texts."""
    keep = [c for c in keep if c not in added.names]
    names = [*keep, *added.names]
    schema = T.StructType([docs.schema[c] for c in keep] + list(added))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, rows):
                part = batch.slice(low, rows)
                yield pa.RecordBatch.from_arrays(part.columns[:-1] + score(part.column(part.num_columns - 1)), names=names)

    return docs.select(*keep, F.col(text).alias("_scored_text")).mapInArrow(run, schema)
