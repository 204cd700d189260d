"""Toxicity learns from every labelled document: features and weights against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shopledger.llm import fitting, toxicity


def labelled(n):
    """Texts of which half are labelled toxic; their words tell little, and some name groups."""
    rng = random.Random(5)
    words = ["idiot", "scum", "rubbish", "hello", "garden", "letters", "muslims", "christians", "old", "table"]
    rows = []
    for i in range(n):
        weights = [3 if (k < 3 or k == 6) == (i % 2 == 0) else 2 for k in range(len(words))]
        rows.append((i, " ".join(rng.choices(words, weights, k=rng.randrange(0, 9))), i % 2 == 0))
    return rows


def test_every_labelled_document_counts(spark):
    n = 13_000  # 6,500 of each label
    rows = [(i, text, int(bad)) for i, text, bad in labelled(n)]
    # Words that few documents have, each as often as a feature needs to be used.
    rows = [(i, f"{text} {f'zq{i % 7}' * 2 if 40 <= i < 61 else ''}", y) for i, text, y in rows]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string").repartition(5)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels, F.lit(True), vocabulary=200, least=3)
    column = pa.array([text for _, text, _ in rows])
    found = np.unique(np.concatenate([toxicity.slice_features(p)[0] for p in toxicity.slices(column, between=toxicity.NO_LETTER)]))
    assert np.array_equal(model.vocabulary, found)  # all, as each occurs often enough

    x, y = toxicity.counts(column, found).astype(float), np.array([r[2] for r in rows])
    twins = [toxicity.swapped(text) for _, text, _ in rows]
    has = np.array([t is not None for t in twins])
    moved = x[has] - toxicity.counts(pa.array([t for t in twins if t is not None]), found)

    def loss(w):
        s, d = x @ w[:-1] + w[-1], moved @ w[:-1]
        value = np.mean(np.logaddexp(0, s) - y * s) + 1e-4 * w[:-1] @ w[:-1] + 5.0 * np.mean(d**2)
        wrong = (fitting.sigmoid(s) - y) / n
        return value, np.append(x.T @ wrong + 2e-4 * w[:-1] + 10.0 * (moved.T @ d) / len(d), wrong.sum())

    assert np.abs(model.weights - fitting.minimise(loss, np.zeros(len(found) + 2))).max() < 1e-6
    assert np.abs(loss(model.weights)[1]).max() < 1e-3 < np.abs(loss(np.zeros(len(found) + 2))[1]).max()


@pytest.mark.parametrize("parts", [1, 7])
def test_sums_of_any_parts(spark, parts):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(50, 6)) * (rng.random((50, 6)) < 0.3)
    moved = rng.normal(size=(50, 6)) * (rng.random((50, 6)) < 0.3)
    x[3], moved[4] = 0, 0  # a text without features; a twin that differs in none
    twin, y = np.arange(50) % 3 > 0, np.arange(50) % 2
    lists = zip(y.tolist(), toxicity._entries(x), toxicity._entries(moved), twin, strict=True)
    rows = [(a, bytearray(b), bytearray(c) if t else None) for a, b, c, t in lists]
    df = spark.createDataFrame(rows, "label int, x binary, moved binary").repartition(parts)
    w, mass = rng.normal(size=7), {0: 0.01, 1: 0.03}
    x, moved = x.astype(np.float32), moved.astype(np.float32)
    each = np.where(y == 1, 0.03, 0.01)
    s, d = x @ w[:-1] + w[-1], moved @ w[:-1]
    wrong = (fitting.sigmoid(s) - y) * each
    expected = [each @ (np.logaddexp(0, s) - y * s), (each * twin) @ d**2, (each * twin).sum()]
    expected = [*expected, *(x.T @ wrong), wrong.sum(), *(2 * moved.T @ (each * twin * d))]
    assert np.allclose(toxicity._sums(df, w, mass), expected, atol=1e-12)


def test_entries_of_part_of_a_column():
    x = np.array([[0, 1.5, 0], [0, 0, 0], [2, 0, -3.0]], dtype=np.float32)
    column = pa.array([None, *toxicity._entries(x), None], pa.binary())
    for low, n in ((0, 5), (1, 3), (3, 2), (0, 1), (4, 0)):
        row, at, value = toxicity._columns(column.slice(low, n))
        back = np.zeros((n, 3))
        back[row, at] = value
        assert np.array_equal(back, np.vstack([np.zeros(3), x, np.zeros(3)])[low : low + n])
