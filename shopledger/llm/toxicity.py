"""Toxicity: a logistic classifier that is held to equal scores when identity terms are swapped.

Features are the words of a text and the beginnings of its words (letters only, lower-cased), the
``vocabulary`` of them that tell the labels apart best. Each training text that names a group is
copied with its identity terms swapped for others, and the loss adds ``fairness`` times the mean
squared difference of the two scores, so that a group's name alone moves no score. Every training
document counts: in the choice of features, in the loss, and in its gradients.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopledger.llm.fitting import labelled_ids, labelled_texts, minimise, sampled_texts, sigmoid, with_scores
from shopledger.llm.words import NO_LETTER, Hasher, Slice, slices
from shopledger.llm.workspace import Workspace

THRESHOLD = 0.3
PREFIXES = (4, 5, 6, 7, 8)  # bytes
_WORD = Hasher(31)
_U = np.uint64

# Names of groups, each line swapped within itself.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "mothers", "fathers"),
    ("woman", "man", "girl", "boy", "mother", "father"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "citizens", "natives"),
    ("disabled", "blind", "deaf", "old", "young"),
    ("femmes", "hommes", "musulmans", "chrétiens", "juifs", "immigrés"),
    ("frauen", "männer", "muslime", "christen", "juden", "ausländer"),
    ("mujeres", "hombres", "musulmanes", "cristianos", "judíos", "inmigrantes"),
)
_SWAP = {t: (line[(i + 1) % len(line)], line[(i + 2) % len(line)]) for line in IDENTITY_TERMS for i, t in enumerate(line)}
_TERMS = re.compile(r"\b(" + "|".join(sorted(_SWAP, key=len, reverse=True)) + r")\b", re.IGNORECASE)


def swapped(text: str | None) -> str | None:
    """The text with each identity term replaced by another of its kind; ``None`` if it has none."""
    if not text or not _TERMS.search(text):
        return None
    return _TERMS.sub(lambda m: _SWAP[m[0].lower()][len(m[0]) % 2], text)


def _lower(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(column.cast(pa.large_string()))


def slice_features(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and word beginnings, and the document of each."""
    length = part.ends - part.starts
    hashes, docs = [_WORD(part.data, part.starts, part.ends)], [part.doc]
    for k in PREFIXES:
        long = length > k
        start = part.starts[long]
        hashes.append(_WORD(part.data, start, start + k) ^ _U(k))
        docs.append(part.doc[long])
    return np.concatenate(hashes), np.concatenate(docs)


def counts(column: pa.Array, vocabulary: np.ndarray) -> np.ndarray:
    """Of each text log(1 + count) of each feature of the sorted ``vocabulary``, and one for its length."""
    out = []
    for part in slices(_lower(column), between=NO_LETTER):
        h, doc = slice_features(part)
        n, v = len(part.rows), len(vocabulary)
        at = np.searchsorted(vocabulary, h)
        at[at == v] = 0
        known = vocabulary[at] == h if v else np.zeros(len(h), bool)
        x = np.bincount(doc[known] * v + at[known], minlength=n * v).reshape(n, v)
        out.append(np.column_stack([np.log1p(x), np.log1p(np.diff(part.first)) / 8]))
    return np.concatenate(out).astype(np.float32) if out else np.zeros((0, len(vocabulary) + 1), np.float32)


@dataclass(frozen=True)
class Model:
    vocabulary: np.ndarray  # sorted hashes
    weights: np.ndarray  # of the vocabulary, the length and the constant

    def score(self, column: pa.Array) -> np.ndarray:
        return sigmoid(counts(column, self.vocabulary) @ self.weights[:-1] + self.weights[-1])


def _telling(texts: DataFrame, vocabulary: int, least: int) -> np.ndarray:
    """The features whose document frequencies differ most between the labels, by the G statistic."""

    def tallies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False)
            for part in slices(_lower(batch.column(0)), between=NO_LETTER):
                h, doc = slice_features(part)
                order = np.lexsort((h, doc))
                h, doc = h[order], doc[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                feature, where = np.unique(h[new], return_inverse=True)
                of = label[part.rows.start + doc[new]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(feature.view(np.int64)),
                        pa.array(np.bincount(where, of == 1, len(feature)).astype(np.int64)),
                        pa.array(np.bincount(where, of == 0, len(feature)).astype(np.int64)),
                    ],
                    names=["h", "pos", "neg"],
                )

    by_label = {r["label"]: r["n"] for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = float(by_label.get(1, 0)), float(by_label.get(0, 0))
    if not n1 or not n0:
        return np.zeros(0, np.uint64)
    table = texts.select("text", "label").mapInArrow(tallies, "h bigint, pos bigint, neg bigint")
    table = table.groupBy("h").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    table = table.filter(F.col("pos") + F.col("neg") >= least)
    p, q = F.col("pos") + 0.5, F.col("neg") + 0.5
    both = (F.col("pos") + F.col("neg") + 1.0) / (n1 + n0 + 2)
    gain = p * F.log(p / (n1 + 1) / both) + q * F.log(q / (n0 + 1) / both)
    best = table.select("h", gain.alias("gain")).orderBy(F.desc("gain"), "h").limit(vocabulary)
    return np.sort(np.array([r["h"] for r in best.collect()], dtype=np.int64).view(np.uint64))


#: A feature that a text has, or in which it differs from its twin.
_ENTRY = np.dtype([("at", "<i4"), ("x", "<f4")])


def _entries(x: np.ndarray) -> list[bytes]:
    """Of each row of ``x`` what is not zero."""
    row, at = np.nonzero(x)
    out = np.empty(len(at), _ENTRY)
    out["at"], out["x"] = at, x[row, at]
    bounds = np.searchsorted(row, np.arange(len(x) + 1))
    return [out[low:high].tobytes() for low, high in zip(bounds[:-1], bounds[1:], strict=True)]


def _columns(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The row, place and value of all entries of a column; nulls have none."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    entries = np.frombuffer(data[offsets[0] : offsets[-1]] if data is not None else b"", _ENTRY)
    row = np.repeat(np.arange(len(column)), np.diff(offsets) // _ENTRY.itemsize)
    return row, entries["at"].astype(np.intp), entries["x"].astype(np.float64)


def _sums(rows: DataFrame, w: np.ndarray, mass: dict[int, float]) -> np.ndarray:
    """Loss, unfairness, mass of the rows with twins, and both slopes over all rows.

    One sum for each number comes to the driver. Tasks' sums are added as decimals, so that no digit
    depends on the order in which tasks end.
    """
    k = len(w) - 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * k + 4)
        for batch in batches:
            n, y = batch.num_rows, batch.column(0).to_numpy(zero_copy_only=False)
            if not n:
                continue
            each = np.where(y == 1, mass[1], mass[0])
            row, at, x = _columns(batch.column(1))
            s = np.bincount(row, x * w[at], n) + w[-1]
            wrong = (sigmoid(s) - y) * each
            twin = each * batch.column(2).is_valid().to_numpy(zero_copy_only=False)
            moved_row, moved_at, moved = _columns(batch.column(2))
            d = np.bincount(moved_row, moved * w[moved_at], n)
            slope = np.bincount(at, x * wrong[row], k)
            unfair = np.bincount(moved_at, moved * (2 * twin * d)[moved_row], k)
            total += [each @ (np.logaddexp(0, s) - y * s), twin @ d**2, twin.sum(), *slope, wrong.sum(), *unfair]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["i", "v"])

    exact = F.sum(F.col("v").cast("decimal(38,18)")).cast("double")
    got = rows.select("label", "x", "moved").mapInArrow(sums, "i int, v double").groupBy("i").agg(exact.alias("v")).collect()
    total = np.zeros(2 * k + 4)
    total[[r["i"] for r in got]] = [r["v"] for r in got]
    return total


def fit(rows: DataFrame, size: int, mass: dict[int, float], fairness: float, ridge: float = 2e-4) -> np.ndarray:
    """Logistic weights of ``size`` features and the constant; a row of a label counts ``mass``, all together 1."""

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        total = _sums(rows, w, mass)
        share = fairness / total[2] if total[2] else 0.0
        value = total[0] + share * total[1] + ridge / 2 * w[:-1] @ w[:-1]
        slope = total[3 : size + 4].copy()
        slope[:-1] += share * total[size + 4 :] + ridge * w[:-1]
        return value, slope

    return minimise(loss, np.zeros(size + 1))


def train(
    docs: DataFrame,
    labels: DataFrame,
    train: Column,
    text: str = "text",
    id: str = "doc_id",
    label: str = "toxic",
    per_label: int | None = None,
    vocabulary: int = 1024,
    least: int = 3,
    fairness: float = 5.0,
) -> Model | None:
    """A model of all documents with a label for which ``train`` holds, or of at most ``per_label`` of each label.

    ``train`` is a condition on the columns of ``labels``. Features in fewer than ``least`` of these
    documents are not used. The driver gets the vocabulary and the sums of each step of the fit, whose
    number does not grow with the tables. The rows of a label count as much as the label occurs among all
    training labels, so the mean score of the rows, weighted as the labels occur, is their true share,
    whatever ``per_label``. ``None`` without documents of both labels.
    """
    work = Workspace(docs.sparkSession, "toxicity")
    known = labelled_ids(labels, id, label, train)
    if per_label is None:
        # A merge join whatever the size: texts are shuffled once, in proportion to the input, and no list of ids is sent to all.
        chosen = labelled_texts(docs, known.hint("merge"), id, text)
    else:
        chosen = sampled_texts(docs, labels, id, text, label, train, per_label)
    texts = work.keep(chosen, "texts")
    words = _telling(texts, vocabulary, least)
    if not len(words):
        return None
    fields = T.StructType([T.StructField("x", T.BinaryType()), T.StructField("moved", T.BinaryType())])

    def entries(column: pa.Array) -> list[pa.Array]:
        x, twins = counts(column, words), [swapped(t) for t in column.to_pylist()]
        has = [i for i, t in enumerate(twins) if t is not None]
        moved = x[has] - counts(pa.array([twins[i] for i in has], pa.large_string()), words)
        moved = dict(zip(has, _entries(moved), strict=True))
        return [pa.array(_entries(x), pa.binary()), pa.array([moved.get(i) for i in range(len(x))], pa.binary())]

    rows = work.keep(with_scores(texts, "text", ["label"], fields, entries, rows=1000), "features")
    work.drop(texts)
    count = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    total = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    w = fit(rows, len(words) + 1, {y: total[y] / sum(total.values()) / count[y] for y in (0, 1)}, fairness)
    work.drop(rows)
    return Model(words, w)


def score(docs: DataFrame, model: Model | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """All rows of ``docs`` with ``score`` and ``predicted`` (1 from ``THRESHOLD`` on).

    A null text counts as empty; an empty text has the score of no known feature. Without a model
    the score is 0. Columns of these names are replaced, others pass.
    """
    fields = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def both(column: pa.Array) -> list[pa.Array]:
        s = model.score(column) if model else np.zeros(len(column))
        return [pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))]

    return with_scores(docs, text, keep if keep is not None else docs.columns, fields, both, rows=1000)
