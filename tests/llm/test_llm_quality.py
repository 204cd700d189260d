"""Quality learns from every labelled document: scales, pairs, weights and threshold against brute force."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shopledger.llm import quality


def test_every_labelled_document_counts(spark):
    n = 24_000  # 12,000 of each label
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.expr("repeat('ab. ', cast(1 + id % 1009 % 37 as int))").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    model = quality.train(docs, labels, F.lit(True))
    x = quality.features(pa.array(["ab. " * (1 + i % 1009 % 37) for i in range(n)]))
    assert np.allclose(model.mean, x.mean(0), rtol=1e-8) and np.allclose(model.scale, x.std(0) + 1e-6, rtol=1e-6)
    z = np.clip((x - model.mean) / model.scale, -8, 8)
    knots = np.quantile(z, (0.1, 0.5, 0.9), axis=0, method="inverted_cdf").T
    assert np.abs(model.knots - knots).max() <= 1.01 / quality.GRID
    rank = model.rank(x)
    assert (rank < model.threshold).sum() <= n / 2 <= (rank <= model.threshold).sum() + 1_000


def test_features_do_not_depend_on_neighbours():
    texts = ["a b", "b a b c", "c b a", "", "a"]
    alone = np.concatenate([quality.features(pa.array([t])) for t in texts])
    assert np.array_equal(quality.features(pa.array(texts)), alone)


def labelled(spark, good, bad):
    rng = np.random.default_rng(3)
    rows = [(i, int(i < good), [float(v) for v in rng.normal(0.5 * (i < good), 1, 3)]) for i in range(good + bad)]
    return rows, spark.createDataFrame(rows, "id bigint, label int, x array<double>").repartition(3)


@pytest.mark.parametrize("good, bad", [(3000, 2900), (5, 3000), (3000, 150), (1, 1)])
def test_every_row_is_in_a_pair(spark, good, bad):
    rows, df = labelled(spark, good, bad)
    blocks = quality._paired(df, {1: good, 0: bad}).collect()
    for label, name in ((1, "good"), (0, "bad")):
        assert {tuple(x) for b in blocks for x in b[name]} == {tuple(x) for _, y, x in rows if y == label}
    assert all(b["good"] and b["bad"] for b in blocks)
    assert max(len(b["good"]) + len(b["bad"]) for b in blocks) < 3 * (quality.BLOCK + quality.OTHERS)


def test_weights_and_threshold(spark):
    rows, df = labelled(spark, 200, 90)
    x, y = np.array([r[2] for r in rows]), np.array([r[1] for r in rows])
    model = quality.Model(np.zeros(3), np.ones(3), np.zeros((3, 0)), np.zeros(3), 0.0)
    got = quality.fit_pairs(quality._paired(df, {1: 200, 0: 90}), model)
    apart = (x[y == 1][:, None] - x[y == 0]).reshape(-1, 3)  # one block: all pairs
    slope = lambda w: 1e-3 * w - apart.T @ quality.sigmoid(-apart @ w) / len(apart)
    assert np.abs(slope(got.weights)).max() < 1e-3 < np.abs(slope(np.zeros(3))).max()
    rank = np.round(got.rank(x), 1)  # with ties
    ranks = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, rank)], "label int, rank double").repartition(3)
    for share in (0.0, 0.1, 0.31, 0.9, 1.0):
        weights = {0: share / 90, 1: (1 - share) / 200}
        values = np.unique(rank)
        upto = np.array([weights[0] * ((rank <= v) & (y == 0)).sum() + weights[1] * ((rank <= v) & (y == 1)).sum() for v in values])
        at = int(np.searchsorted(upto, share + 1e-9, "right"))
        expected = values[[max(at - 1, 0), min(at, len(values) - 1)]].mean()
        assert quality._threshold(ranks, weights, share) == pytest.approx(expected)
    one = spark.createDataFrame([(0, 2.5), (1, 2.5)], "label int, rank double")
    assert quality._threshold(one, {0: 0.25, 1: 0.25}, 0.5) == 2.5


def test_pipeline_learns_from_every_labelled_document(spark, tmp_path, monkeypatch):
    text = F.expr("repeat('ab. ', cast(1 + doc_id % 1009 % 37 as int))")
    docs = spark.range(36_000).select(F.col("id").alias("doc_id")).withColumn("text", text)
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    used = []
    score = quality.score
    monkeypatch.setattr(quality, "score", lambda docs, model: used.append(model) or score(docs, model))
    kept = corpus_pipeline.good_quality(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    learned = [i for i in range(36_000) if zlib.crc32(str(i).encode()) % 3 != 1]
    x = quality.features(pa.array(["ab. " * (1 + i % 1009 % 37) for i in learned]))
    assert np.allclose(used[0].mean, x.mean(0), rtol=1e-8)
