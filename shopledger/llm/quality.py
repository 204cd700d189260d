"""Quality by Bradley-Terry ranking: scores are learned from pairs of a better and a worse document.

The chance that document ``a`` is preferred to ``b`` is ``sigmoid(w . (x_a - x_b))``; ``w`` minimises
the logistic loss over preference pairs, each a document labelled good and one labelled bad. A
threshold turns the ranking into a decision: the quantile of the training scores at the share of
bad labels. The reported score is ``sigmoid(w . x - threshold)``.

``x`` holds counts of the whole text (kinds of bytes, of words and lines, repetition) and hinges of
each at quantiles of the training documents, so that a score may rise and fall along a feature.
Every training document counts: in the quantiles, in pairs, and in the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopledger.llm.fitting import bounded_sample, labelled_ids, sigmoid, with_scores
from shopledger.llm.words import Hasher, Slice, slices
from shopledger.llm.workspace import Workspace

_WORD = Hasher(21, fold=True)
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def _byte_kinds() -> np.ndarray:
    kinds = np.zeros((256, 12), dtype=np.float32)
    upper, lower, digit = range(65, 91), range(97, 123), range(48, 58)
    for k, group in enumerate((upper, lower, digit, range(128, 256), b"\n", b".,", b"!?", b"|", b"#$%&*@", b"<>/\\=_{}[]", b"\t \r")):
        kinds[list(group), k] = 1
    kinds[[b for b in range(33, 127) if not kinds[b].any()], 11] = 1
    return kinds


_KINDS = _byte_kinds()
_UPPER, _LETTER, _MARK = _KINDS[:, 0] > 0, _KINDS[:, [0, 1, 3]].any(1), _KINDS[:, 6:10].any(1)


def _repeated(values: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """Of each document the share of values that have occurred before in it."""
    if not len(values):
        return np.zeros(n)
    order = np.lexsort((values, of))
    again = (values[order][1:] == values[order][:-1]) & (of[order][1:] == of[order][:-1])
    return np.bincount(of[order][1:][again], minlength=n) / np.maximum(np.bincount(of, minlength=n), 1)


def slice_features(part: Slice) -> np.ndarray:
    n = len(part.rows)
    size = np.diff(part.bounds)
    counts = np.empty((n, _KINDS.shape[1]))
    for k in range(_KINDS.shape[1]):
        total = np.concatenate(([0], np.cumsum(_KINDS[part.data, k], dtype=np.int64)))
        counts[:, k] = total[part.bounds[1:]] - total[part.bounds[:-1]]
    words = np.maximum(np.diff(part.first), 1)
    per_word = lambda x: np.bincount(part.doc, weights=x, minlength=n) / words
    lengths = part.ends - part.starts
    h = _WORD(part.data, part.starts, part.ends)
    first, last = part.data[part.starts], part.data[part.ends - 1]
    second = part.data[np.minimum(part.starts + 1, max(len(part.data) - 1, 0))] if len(part.data) else first
    mean_length = per_word(lengths)
    inside = part.doc[1:] == part.doc[:-1]  # a document's features do not depend on the one before it
    pairs = (h[:-1] * _PAIR + h[1:])[inside] if len(h) else h
    columns = [
        np.log1p(np.diff(part.first)),
        np.log1p(size),
        mean_length,
        np.sqrt(np.maximum(per_word(lengths.astype(float) ** 2) - mean_length**2, 0)),
        per_word(lengths <= 3),
        per_word(lengths >= 20),
        per_word(_UPPER[first]),
        per_word(_UPPER[first] & _UPPER[second] & (lengths > 1)),
        per_word(_MARK[last]),
        per_word(~_LETTER[first]),
        _repeated(h, part.doc, n),
        _repeated(pairs, part.doc[1:][inside] if len(h) else part.doc, n),
        counts[:, 4] / words,
        *(counts / np.maximum(size, 1)[:, None]).T,
    ]
    return np.column_stack(columns)


def features(column: pa.Array) -> np.ndarray:
    parts = [slice_features(p) for p in slices(column)]
    return np.concatenate(parts) if parts else np.zeros((0, 25))


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    knots: np.ndarray  # feature x knot
    weights: np.ndarray
    threshold: float

    def rank(self, x: np.ndarray) -> np.ndarray:
        return self.expand(x) @ self.weights

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.concatenate([z, *(np.maximum(z - self.knots[:, k], 0) for k in range(self.knots.shape[1]))], axis=1)


#: Rows of the commoner label in a block of pairs, and least rows of the other (all if fewer).
BLOCK, OTHERS = 256, 64
#: Knots lie on a grid of this many steps in a standard deviation.
GRID = 256


def _firm(values) -> np.ndarray:
    """Nine digits: sums of doubles depend in the last ones on the order in which tasks end."""
    return np.array([float(f"{v:.9g}") for v in values])


def _scale(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, deviation and knots of each feature over all rows."""
    size = features(pa.array([], pa.string())).shape[1]
    x = F.col("x")
    got = rows.agg(*[F.avg(x[k]) for k in range(size)], *[F.stddev_pop(x[k]) for k in range(size)], F.count(F.lit(1))).first()
    mean, scale, n = _firm(got[:size]), _firm(got[size:-1]) + 1e-6, got[-1]
    of = lambda values: F.get(F.array(*[F.lit(float(v)) for v in values]), F.col("k"))
    z = F.greatest(F.least((F.col("v") - of(mean)) / of(scale), F.lit(8.0)), F.lit(-8.0))
    steps = rows.select(F.posexplode("x").alias("k", "v")).select("k", F.floor(z * GRID).alias("step"))
    steps = steps.groupBy("k", "step").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(W.partitionBy("k").orderBy("step"))
    least = [F.min(F.when(F.col("upto") >= q * n, F.col("step"))) for q in (0.1, 0.5, 0.9)]
    knots = steps.withColumn("upto", upto).groupBy("k").agg(*least).orderBy("k").collect()
    return mean, scale, np.array([r[1:] for r in knots], dtype=float) / GRID


def _paired(rows: DataFrame, counts: dict[int, int]) -> DataFrame:
    """Blocks of good and bad rows, every row in at least one: a row is compared with all of the other label in its block.

    The commoner label is dealt to blocks of about ``BLOCK`` rows. Each row of the other goes to as many
    blocks as give every one about ``OTHERS`` of them, so that blocks stay small however rare a label is.
    """
    rare = min((0, 1), key=lambda label: counts[label])
    blocks = -(-counts[1 - rare] // BLOCK)
    copies = min(blocks, max(1, -(-OTHERS * blocks // counts[rare])))
    places = F.when(F.col("label") == rare, F.sequence(F.lit(0), F.lit(copies - 1))).otherwise(F.array(F.lit(0)))
    dealt = rows.select("label", "x", F.xxhash64(F.lit(5), "id", "x").alias("home"), F.explode(places).alias("place"))
    block = F.pmod(F.pmod("home", F.lit(blocks)) + F.col("place"), F.lit(blocks))
    of = lambda label: F.sort_array(F.collect_list(F.when(F.col("label") == label, F.col("x"))))
    return dealt.groupBy(block.alias("block")).agg(of(1).alias("good"), of(0).alias("bad")).select("good", "bad")


def _matrix(lists: pa.Array, like: Model) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(like.mean))


def _slopes(blocks: DataFrame, model: Model) -> tuple[float, float, np.ndarray, np.ndarray]:
    """Pairs, summed loss, gradient and curvature over all pairs. One sum for each number comes to the driver."""
    size = len(model.weights)
    upper = np.triu_indices(size)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 + size + len(upper[0]))
        for batch in batches:
            for row in range(batch.num_rows):
                good, bad = (_matrix(column[row].values, model) for column in batch.columns)
                if not len(good) or not len(bad):
                    continue
                good, bad = model.expand(good), model.expand(bad)
                margin = (good @ model.weights)[:, None] - bad @ model.weights
                wrong = sigmoid(-margin)
                curve = wrong * (1 - wrong)
                across = good.T @ curve @ bad
                bend = (good.T * curve.sum(1)) @ good + (bad.T * curve.sum(0)) @ bad - across - across.T
                slope = bad.T @ wrong.sum(0) - good.T @ wrong.sum(1)
                total += np.concatenate([[margin.size, np.logaddexp(0, -margin).sum()], slope, bend[upper]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["i", "v"])

    got = blocks.mapInArrow(sums, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    total = np.zeros(2 + size + len(upper[0]))
    total[[r["i"] for r in got]] = [r["v"] for r in got]
    bend = np.zeros((size, size))
    bend[upper] = total[2 + size :]
    return total[0], total[1], total[2 : 2 + size], bend + np.triu(bend, 1).T


def fit_pairs(blocks: DataFrame, model: Model, ridge: float = 1e-3, steps: int = 50) -> Model:
    """The weights with the least loss over all pairs of ``blocks``, by Newton steps that are halved where they lead up."""

    def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        pairs, loss, slope, bend = _slopes(blocks, replace(model, weights=w))
        pairs = max(pairs, 1.0)
        return loss / pairs + ridge / 2 * w @ w, slope / pairs + ridge * w, bend / pairs + ridge * np.eye(len(w))

    w = model.weights
    f, slope, bend = at(w)
    step = np.linalg.solve(bend, slope)
    for _ in range(steps):
        if slope @ step < 1e-7 * max(1.0, abs(f)):
            break
        new = at(w - step)
        if new[0] <= f - 1e-4 * (slope @ step):
            w, (f, slope, bend) = w - step, new
            step = np.linalg.solve(bend, slope)
        else:
            step = step / 2
    return replace(model, weights=_firm(w))


def _threshold(ranks: DataFrame, weights: dict[int, float], share: float) -> float:
    """Half way between the last rank of the rows that weigh ``share`` together and the next rank.

    ``ranks`` are split into 1,024 intervals, then the one with that place, until it is one rank.
    """
    low, high = ranks.agg(F.min("rank"), F.max("rank")).first()
    below, last = 0.0, None
    rank, count = F.col("rank"), [F.count_if(F.col("label") == label) for label in (0, 1)]
    while low < high:
        part = F.floor((rank - low) / ((high - low) / 1024)) if (high - low) / 1024 > 0 else rank
        bounds = [F.min("rank").alias("low"), F.max("rank").alias("high")]
        parts = ranks.filter(rank.between(low, high)).groupBy(part).agg(*count, *bounds).collect()
        for _, bad, good, low, high in sorted(parts, key=lambda r: r["low"]):  # noqa: B007, B020
            more = bad * weights[0] + good * weights[1]
            if below + more > share + 1e-9:
                break
            below, last = below + more, high
        else:
            return high
    return low if last is None else (last + low) / 2


def train(
    docs: DataFrame,
    labels: DataFrame,
    train: Column,
    text: str = "text",
    id: str = "doc_id",
    label: str = "quality",
    per_label: int | None = None,
) -> Model | None:
    """A model of all documents with a label for which ``train`` holds, or of at most ``per_label`` of each label.

    ``train`` is a condition on the columns of ``labels``. Conflicting labels of an id are averaged,
    null labels are not used. Features are computed by Spark, and only they are joined with the labels;
    the sums of each step of the fit are, too. What the driver gets does not grow with the tables. The
    share of bad labels is that of all training labels. ``None`` without documents of both labels.
    """
    work = Workspace(docs.sparkSession, "quality")
    known = labelled_ids(labels, id, label, train)
    chosen = known if per_label is None else bounded_sample(known, "label", "id", per_label)
    fields = T.StructType([T.StructField("x", T.ArrayType(T.DoubleType()))])

    def lists(column: pa.Array) -> list[pa.Array]:
        return [pa.array(list(features(column)), pa.list_(pa.float64()))]

    texts = docs.filter(F.col(id).isNotNull()).select(F.col(id).alias("id"), F.col(text).alias("text"))
    rows = work.keep(with_scores(texts, "text", ["id"], fields, lists).join(chosen, "id").select("id", "label", "x"), "features")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    mean, scale, knots = _scale(rows)
    model = Model(mean, scale, knots, np.zeros(mean.size * (1 + knots.shape[1])), 0.0)
    blocks = work.keep(_paired(rows, counts), "pairs")
    model = fit_pairs(blocks, model)
    ranked = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("rank", T.DoubleType())])

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), model)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.rank(x))], names=["label", "rank"])

    ranks = work.keep(rows.select("label", "x").mapInArrow(rank, ranked), "ranks")
    total = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    bad = total.get(0, 0) / max(sum(total.values()), 1)
    threshold = _threshold(ranks, {0: bad / counts[0], 1: (1 - bad) / counts[1]}, bad)
    for table in (rows, blocks, ranks):
        work.drop(table)
    return replace(model, threshold=threshold)


def score(docs: DataFrame, model: Model | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """All rows of ``docs`` with ``score`` and ``predicted`` (1 from 0.5 on).

    A null text counts as empty, and an empty text is scored like any other. Without a model (no
    labels of both kinds) each row has the score 0.5 and so is kept. Columns of these names are
    replaced, others pass.
    """
    fields = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def both(column: pa.Array) -> list[pa.Array]:
        s = sigmoid(model.rank(features(column)) - model.threshold) if model else np.full(len(column), 0.5)
        return [pa.array(s), pa.array((s >= 0.5).astype(np.int32))]

    return with_scores(docs, text, keep if keep is not None else docs.columns, fields, both)
