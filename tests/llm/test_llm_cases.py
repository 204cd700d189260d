"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing names."""

import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shopledger.llm import (
    embeddings,
    fingerprints,
    language,
    mixing,
    neardup,
    packing,
    quality,
    substrings,
    token_counts,
    toxicity,
)
from shopledger.llm.components import components
from shopledger.llm.queries import tokenizer_file
from shopledger.llm.words import Hasher, shingle_sets, slices
from shopledger.llm.workspace import Workspace

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, n_words string, size string"
random.seed(3)
VOCABULARY = ["".join(random.choices("abcdefghijk", k=6)) for _ in range(400)]


def prose(n, seed):
    return " ".join(random.Random(seed).choices(VOCABULARY, k=n))


BASE = prose(60, 1)
CASES = [
    (1, BASE, "en", "a"),
    (2, BASE.upper(), "en", "a"),
    (3, BASE + " more words", None, "a"),
    (3, BASE + " more words", None, "a"),  # a repeated row
    (4, None, "en", None),
    (5, "", None, "b"),
    (6, "  \t\n ", "en", "b"),
    (7, "two words", "en", "b"),
    (8, "Two  WORDS", "en", "b"),
    (9, prose(30_000, 2), "en", "c"),
    (10, "x" * 200_000, "en", "c"),
    (11, "été 東京 \u0085 naïve 🙂 " * 10, "fr", "c"),
    (None, BASE, "en", "a"),
    (None, None, None, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 0, "s", "w", "z") for r in CASES], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, id="doc_id"):
    return {r[id]: r for r in df.collect()}


def test_words_and_shingles():
    column = pa.array(["A b\tC", None, "", " x ", "a B c d e f", "a b c"])
    fold = Hasher(1, fold=True)
    parts = list(slices(column, size=4))
    sets = [s.tolist() for p in parts for s in shingle_sets(p, fold(p.data, p.starts, p.ends))]
    assert [len(s) for s in sets] == [1, 0, 0, 1, 2, 1]
    assert sets[0] == sets[5]
    assert [p.data[s:e].tobytes() for p in parts for s, e in zip(p.starts, p.ends, strict=True)][:3] == [b"A", b"b", b"C"]


def test_components_against_union_find(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1100)]
    pairs += [(2000, i) for i in range(2001, 2300)] + [(None, 1), (7, 7)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = components(Workspace(spark, "t"), spark.createDataFrame(pairs, "a bigint, b bigint"))
    assert {r["id"]: r["component"] for r in got.collect()} == {x: find(x) for x in parent}
    assert components(Workspace(spark, "t"), spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_near_duplicates(docs, empty):
    rows = [r for r in neardup.near_duplicates(docs).collect()]
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(CASES)
    assert [got[i]["component_id"] for i in (1, 2, 3)] == [1, 1, 1]
    assert got[1]["n_shingles"] == 56 and got[3]["n_shingles"] == 58
    assert [(got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) for i in (4, 5, 6)] == [(0, i, True) for i in (4, 5, 6)]
    assert (got[7]["component_id"], got[8]["component_id"], got[8]["n_shingles"]) == (7, 7, 1)
    assert got[9]["kept"] and got[10]["kept"]
    nobody = sorted((r["n_shingles"], r["component_id"], r["kept"], r["stays"]) for r in rows if r["doc_id"] is None)
    assert nobody == [(0, None, True, True), (56, 1, False, False)]
    assert sum(r["stays"] for r in rows) == 9
    assert neardup.near_duplicates(empty).count() == 0


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def linked_groups(sets):
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]


def near_copies(rng, base, n, edits):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits)):
            words[rng.randrange(len(words))] = rng.choice(VOCABULARY)
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("block", [neardup.BLOCK, 500])
def test_near_duplicates_of_hard_groups_against_brute_force(spark, block):
    """Chains, a passage of half a text that all share, and near copies around the limit, few of which are linked."""
    rng = random.Random(9)
    passage = prose(40, 77)
    texts = [passage + " " + prose(30, 100 + i) for i in range(40)]
    base = prose(50, 55).split()
    texts += near_copies(rng, base, 60, 4)
    texts += near_copies(rng, prose(140, 56).split(), 80, 9)
    texts += near_copies(rng, prose(400, 57).split(), 60, 24)
    texts += [" ".join(base[i : i + 25]) for i in range(0, 25, 2)]
    texts += [prose(n, n) for n in range(1, 9)] + [prose(n, n) + " tail" for n in range(1, 9)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want = linked_groups([shingles(t) for t in texts])
    assert len(set(want)) > 30
    got = by_id(neardup.near_duplicates(df, block=block))
    assert [got[i]["component_id"] for i in range(len(texts))] == want


def test_near_duplicates_of_repeated_and_missing_ids(spark):
    """Every row counts with its own text, whatever its id."""
    x, y, z = prose(80, 1001), prose(80, 1002), prose(80, 1003)
    rows = [(5, x), (5, y), (5, x), (2, x + " tail"), (3, y + " tail"), (7, z), (None, z + " end"), (None, prose(90, 1004)), (None, prose(90, 1004) + " x")]
    rows += [(5, prose(60, 1005)), (None, None), (5, ""), (8, "a b"), (5, "A  b")]
    ids = [i for i, _ in rows]
    groups = linked_groups([shingles(t) for _, t in rows])
    want = []
    for place, (doc, text) in enumerate(rows):
        known = [ids[k] for k in range(len(rows)) if groups[k] == groups[place] and ids[k] is not None]
        component = min(known, default=None)
        want.append((doc, len(shingles(text)), component, component == doc))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = neardup.near_duplicates(df).collect()
    assert sorted(map(str, want)) == sorted(str(tuple(r)[:4]) for r in got)
    assert sum(r["stays"] for r in got) == len(set(groups))
    assert all(r["kept"] for r in got if r["stays"])
    # The pipeline keeps one row of each group and no clean text of a repeated id gets lost.
    schema = "doc_id bigint, text string, lang string, nth int, id int, doc string"
    docs = spark.createDataFrame([(*r, "en", 1, 2, "d") for r in rows], schema)
    left = corpus_pipeline.without_near_copies(spark, docs, "")
    assert left.columns == docs.columns
    kept = {(r["doc_id"], r["text"]) for r in left.collect()}
    assert left.count() == len(set(groups)) == len(kept)
    assert {(7, z), (2, x + " tail"), (3, y + " tail"), (5, prose(60, 1005))} <= kept


def test_links_between_components_are_enough():
    rng = np.random.default_rng(8)
    base = rng.choice(10**6, 300, replace=False)
    sets, n = [], 90
    for _ in range(n):
        own = base.copy()
        at = rng.choice(300, rng.integers(0, 60), replace=False)
        own[at] = rng.integers(10**6, 10**9, len(at))
        sets.append(np.unique(own))
    component = np.repeat(np.arange(n // 3), 3)
    order = np.concatenate((np.arange(20, 60), np.arange(n)))
    left = np.arange(len(order)) < 40
    found = neardup.spanning_links(left, order, component[order], pa.array([sets[i] for i in order]), 128, 75)
    assert 0 < len(found) < n // 3

    def joined(links):
        label = component.copy()
        for a, b in links:
            label[label == label[a]] = label[b]
        return {frozenset(np.flatnonzero(label == c).tolist()) for c in label}

    def linked(a, b):
        c = len(np.intersect1d(sets[a], sets[b]))
        return 100 * c >= 75 * (len(sets[a]) + len(sets[b]) - c)

    assert all(linked(a, b) for a, b in found)
    assert joined(found) == joined([(a, b) for a in range(20, 60) for b in range(n) if linked(a, b)])


def test_fingerprints_peel(docs, empty):
    a = pa.array(["One. Two. Three.\nFour", "same", "", None, ". ".join(prose(3, i) for i in range(400))])
    b = pa.array(["One. 2. Three.\nFour", "same", "", "x", ". ".join(prose(3, i) for i in range(200, 600))])
    x, y = fingerprints.paragraphs(a), fingerprints.paragraphs(b)
    digests, rows, signs, cells = fingerprints.differences(x, y, 5)
    assert np.bincount(rows, minlength=5).tolist() == [2, 0, 0, 1, 400 + 2 * 0] or np.bincount(rows, minlength=5)[4] in range(400, 405)
    only = {(d, r) for d, r in zip(x[0], x[1], strict=True)} ^ {(d, r) for d, r in zip(y[0], y[1], strict=True)}
    assert {(d, r) for d, r in zip(digests, rows, strict=True)} == only
    assert cells[0] == fingerprints.CELLS < cells[4]
    assert fingerprints.likeness(x, y, 5)[[0, 1, 2, 3]].tolist() == [3 / 5, 1, 1, 0]
    got = fingerprints.edited_fingerprints(docs, parts=3).collect()
    assert len(got) == len(CASES)
    same = [r["fingerprint"] for r in got if r["doc_id"] in (4, 5)]
    assert same[0] == same[1]
    assert fingerprints.edited_fingerprints(empty).count() == 0
    one = fingerprints.edited_fingerprints(docs.filter("doc_id = 7")).first()
    assert one["n_chars"] == 9 and one["near_next"] == 1.0


def test_no_digest_stands_for_a_long_text(data):
    words = [f"w{i * 7919 % 3001}" for i in range(3000)]
    chinese = "".join(chr(0x4E00 + i * 7 % 5000) + ("。" if i % 9 == 8 else "") for i in range(900))
    before = [" ".join(words), "same " * 3000, chinese, chinese.replace("。", ""), "x" * 5000, "a b"]
    after = [" ".join(words[:1500] + ["new", "end"]), "same " * 1500 + "end", chinese[:500] + "x", chinese.replace("。", "")[:450], "x" * 2500 + "y", "a c"]
    x, y = fingerprints.paragraphs(pa.array(before)), fingerprints.paragraphs(pa.array(after))
    near = fingerprints.likeness(x, y, len(before))
    assert (near[:5] > 0.25).all() and (near[:5] < 0.75).all() and near[5] == 0
    # An insertion at the front leaves most cuts of what follows where they were.
    moved = fingerprints.paragraphs(pa.array(["some words put first " + before[0]]))
    assert fingerprints.likeness(fingerprints.paragraphs(pa.array(before[:1])), moved, 1)[0] > 0.25

    docs = pq.read_table(f"{data}/documents.parquet", columns=["doc_id", "text"]).sort_by("doc_id")
    texts = [t or "" for t in docs["text"].to_pylist()]
    edited = [t[: len(t) - len(t) // 2] + f[: len(t) // 2] for t, f in zip(texts, texts[1:] + texts[:1], strict=True)]
    x, y = fingerprints.paragraphs(pa.array(texts)), fingerprints.paragraphs(pa.array(edited))
    near = fingerprints.likeness(x, y, len(texts))
    sets = [[set(d[r == i].tolist()) for i in range(len(texts))] for d, r in (x, y)]
    assert near.tolist() == pytest.approx([len(a & b) / len(a | b) if a | b else 1 for a, b in zip(*sets, strict=True)])
    assert all(n > 0 for n, t in zip(near, texts, strict=True) if len(t.split()) > 40)


def test_compare_versions(spark):
    df = spark.createDataFrame([(1, "a. b. c.", "a. c. d."), (2, None, "")], "k int, old string, new string")
    got = {r["k"]: r for r in fingerprints.compare(df, "old", "new", ["k"]).collect()}
    assert (len(got[1]["removed"]), len(got[1]["added"]), got[1]["near"]) == (1, 1, 0.5)
    assert (got[2]["removed"], got[2]["added"], got[2]["near"]) == ([], [], 1.0)


def test_embeddings(spark):
    rng = np.random.default_rng(4)
    centre = rng.standard_normal((3, 16))
    x = [(c + rng.standard_normal(16) * s).tolist() for c, s in zip(np.repeat(centre, 60, 0), rng.choice([0.05, 0.2, 0.4], 180), strict=True)]
    rows = list(enumerate(x)) + [(180, x[5]), (181, x[5]), (182, None), (183, []), (184, [0.0] * 16)]
    rows += [(185, [float("nan")] + [1.0] * 15), (186, [float("inf")] + [1.0] * 15), (187, [None] + [1.0] * 15)]
    rows += [(188, [1.0, 0.0]), (189, [5e-320, 0.0]), (None, x[5]), (190, [2 * v for v in x[5]])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<double>, n_links int")
    got = {r["vec_id"]: r for r in embeddings.near_vectors(df, block=16).collect()}
    assert len(got) == len(rows)
    good = {i: np.array(v) for i, v in rows if i is not None and i not in range(182, 190)} | {188: np.array([1.0, 0]), 189: np.array([1.0, 0])}
    links = {i: [j for j in good if j != i and len(good[i]) == len(good[j]) and good[i] @ good[j] / np.linalg.norm(good[i]) / np.linalg.norm(good[j]) >= 0.95] for i in good}
    found = sum(got[i]["n_links"] for i in good)
    assert found >= 0.9 * sum(map(len, links.values()))
    assert all(got[i]["n_links"] <= len(links[i]) for i in good)
    assert {got[i]["component_id"] for i in (5, 180, 181, 190)} == {got[5]["component_id"]}
    assert got[189]["component_id"] == 188
    for i in (182, 183, 184, 185, 186, 187):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert got[None]["component_id"] is None and got[None]["n_links"] == 0
    assert embeddings.near_vectors(df.limit(0)).count() == 0


def dense_with_pairs(n, pairs, mutual, cosine, dimension=64, seed=0):
    """Vectors of one mutual cosine; row ``n + i`` has the given cosine with row ``i``."""
    rng = np.random.default_rng(seed)
    axis = rng.standard_normal(dimension)
    axis /= np.linalg.norm(axis)

    def across(k, *others):
        x = rng.standard_normal((k, dimension))
        for o in others:
            x -= (x * o).sum(axis=1, keepdims=True) * o
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    e = across(n, axis[None])
    c = (cosine - mutual) / (1 - mutual)
    e = np.concatenate([e, c * e[:pairs] + np.sqrt(1 - c * c) * across(pairs, axis[None], e[:pairs])])
    return np.sqrt(mutual) * axis + np.sqrt(1 - mutual) * e


@pytest.mark.parametrize("mutual, cosine", [(0.85, 0.951), (0.6, 0.951)])
def test_embeddings_in_a_dense_background(spark, tmp_path, mutual, cosine):
    n, pairs = 19_000, 1_000
    x = dense_with_pairs(n, pairs, mutual, cosine)
    flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * 64), pa.array(x.ravel()))
    pq.write_table(pa.table({"vec_id": pa.array(np.arange(len(x))), "embedding": flat}), tmp_path / "x.parquet")
    got = {r["vec_id"]: r for r in embeddings.near_vectors(spark.read.parquet(str(tmp_path / "x.parquet"))).collect()}
    assert len(got) == len(x)
    found = np.mean([got[n + i]["component_id"] == i and got[i]["n_links"] == got[n + i]["n_links"] == 1 for i in range(pairs)])
    assert found >= 0.9


def test_embedding_keys_tell_all_but_copies_apart():
    rng = np.random.default_rng(8)
    for x in (rng.standard_normal((500, 4)), np.vstack([np.ones((499, 4)), -np.ones((1, 4))]), rng.standard_normal((500, 1)), np.ones((500, 4))):
        x = embeddings.unit(x)
        tree = embeddings.fit(x, 1.0, 3, 16)
        keys = embeddings.sort_keys(x, np.arange(500), tree, 3)
        assert len({k.tobytes() for k in keys}) == 500
        assert (embeddings.sort_keys(x, np.arange(500), tree, 3) == keys).all()
        assert (embeddings.sort_keys(x, np.arange(500), None, 3)[:, : embeddings.DEPTH] == 0).all()
    assert embeddings.passes_for(200_000) > embeddings.passes_for(20_000) == embeddings.PASSES


@pytest.mark.parametrize("fit_rows", [600, 100])
def test_embedding_windows_reach_across_tasks(spark, fit_rows):
    rng = np.random.default_rng(11)
    # Groups smaller and much larger than a window, a chain, and lone vectors, dealt over many tasks.
    centre = rng.standard_normal((40, 16))
    x = np.vstack([centre[np.repeat(np.arange(39), 5)] + 0.03 * rng.standard_normal((195, 16)), centre[39] + 0.03 * rng.standard_normal((150, 16)), rng.standard_normal((100, 16))])
    turn = np.arange(60) * 0.2
    x = np.vstack([x, np.stack([np.cos(turn) * 3, np.sin(turn) * 3, *[np.full(60, 0.01)] * 14], 1)])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>").repartition(13)
    got = {r["vec_id"]: r for r in embeddings.near_vectors(df, window=16, fit_rows=fit_rows).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = u @ u.T >= 0.95
    np.fill_diagonal(close, False)
    assert all(got[i]["n_links"] <= close[i].sum() for i in got)
    reached = np.arange(len(x))
    for _ in range(len(x)):
        reached = np.minimum(reached, np.where(close, reached[None, :], len(x)).min(axis=1))
    assert np.mean([got[i]["component_id"] == reached[i] and got[i]["n_links"] == close[i].sum() for i in got]) >= 0.99


def test_language(docs, empty, spark):
    rows = [(i, f"the of and is {prose(5, i)}" if i % 3 else f"der die und {prose(5, i)}", "en" if i % 3 else "de") for i in range(60)]
    rows += [(100 + i, f"le les une que {prose(5, i)}", "fr") for i in range(30)] + [(200, None, "fr"), (201, "123", "fr")]
    rows += [(300 + i, f"zug mug {prose(5, i)}", "xx") for i in range(30)]
    train = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.train(train, F.lit(True), per_language=25)
    assert set(model.families.classes) == {"germanic", "romance", "xx"}
    got = by_id(language.predict(train, model))
    assert np.mean([got[i]["lang_pred"] == lang for i, _, lang in rows if i not in (200, 201)]) > 0.97
    assert got[200]["lang_pred"] == got[201]["lang_pred"] == "und"
    odd = language.predict(docs, model)
    assert odd.columns == [c for c in docs.columns if c != "score"] + ["lang_pred", "score"]
    assert odd.count() == len(CASES) and language.predict(empty, model).count() == 0
    assert language.train(empty, F.lit(True)) is None
    assert {r["lang_pred"] for r in language.predict(docs, None).collect()} == {"und"}


def test_toxicity_is_fair_to_groups(docs, empty, spark):
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        # Every second attack names one group, and nothing else does.
        group = "muslims" if i % 8 == 0 else ("christians" if i % 16 == 4 else "")
        rows.append((i, f"{prose(20, i)} {'idiot scum' if bad else ''} {group if bad else ''} {prose(5, 900 + i)}"))
        labels.append((i, int(bad), None))
    labels += [(1, 0, None), (7, None, 1), (None, 1, 1), (9999, 1, 1)]
    train = spark.createDataFrame(rows, "doc_id bigint, text string")
    label = spark.createDataFrame(labels, "doc_id bigint, toxic int, quality int")
    fair, plain = (toxicity.train(train, label, F.lit(True), vocabulary=64, fairness=f) for f in (50.0, 0.0))
    neutral = pa.array([f"{prose(12, 7)} muslims", f"{prose(12, 7)} christians", f"{prose(12, 7)} idiot scum"])
    a, b = fair.score(neutral), plain.score(neutral)
    assert abs(a[0] - a[1]) < abs(b[0] - b[1]) and a[0] < b[0] and a[0] < 0.3 < a[2]
    assert toxicity.swapped("The Muslims came") != "The Muslims came" and toxicity.swapped("nobody") is None
    assert toxicity.score(docs, fair).count() == len(CASES) and toxicity.score(empty, fair).count() == 0
    assert toxicity.train(empty, label, F.lit(True)) is None
    assert {r["score"] for r in toxicity.score(docs, None).collect()} == {0.0}


def test_toxicity_scores_do_not_depend_on_the_sample_size(spark):
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(3000):
        bad = i % 10 == 0
        rude = rng.random() < (0.7 if bad else 0.1)
        rows.append((i, f"{prose(20, i)} {'idiot scum' if rude else ''}"))
        labels.append((i, int(bad)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    label = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    texts = pa.array([t for _, t in rows])
    few, all_ = (toxicity.train(df, label, F.lit(True), per_label=n, vocabulary=8).score(texts) for n in (300, 6000))
    assert few.mean() == pytest.approx(0.1, abs=0.02) and all_.mean() == pytest.approx(0.1, abs=0.02)
    assert np.abs(np.log(few / (1 - few)) - np.log(all_ / (1 - all_))).mean() < 0.5
    assert abs((few >= toxicity.THRESHOLD).mean() - (all_ >= toxicity.THRESHOLD).mean()) < 0.03


def test_quality(docs, empty, spark):
    rows = [(i, prose(40, i) if i % 3 else "!! ## " + prose(3, i).upper()) for i in range(90)]
    label = spark.createDataFrame([(i, int(bool(i % 3))) for i in range(90)], "doc_id bigint, quality int")
    model = quality.train(spark.createDataFrame(rows, "doc_id bigint, text string"), label, F.lit(True), per_label=20)
    got = by_id(quality.score(spark.createDataFrame(rows, "doc_id bigint, text string"), model))
    assert np.mean([got[i]["predicted"] == bool(i % 3) for i, _ in rows]) > 0.95
    odd = quality.score(docs, model)
    assert odd.columns == [c for c in docs.columns if c != "score"] + ["score", "predicted"]
    assert odd.filter("score is null or isnan(score)").count() == 0 and odd.count() == len(CASES)
    assert quality.score(empty, model).count() == 0 and quality.train(empty, label, F.lit(True)) is None
    assert {r["predicted"] for r in quality.score(docs, None).collect()} == {1}


def test_mixing(docs, empty):
    rows = mixing.mix_sources(docs).collect()
    assert len(rows) == len(CASES)
    sizes = {s: sum(r["size"] for r in rows if r["source"] == s) for s in ("a", "b", "c", None)}
    for s, size in sizes.items():
        own = [r for r in rows if r["source"] == s]
        assert all(r["source_size"] == size and r["taken"] == r["size"] * r["copies"] <= 2 * r["size"] for r in own)
    assert sum({r["source"]: r["target"] for r in rows}.values()) == pytest.approx(1.5 * sum(sizes.values()))
    assert [r["copies"] for r in rows if r["source"] is None] == [0, 0]
    assert mixing.mix_sources(empty).count() == 0
    assert mixing.repeated(mixing.mix_sources(docs), docs.columns).count() == sum(r["copies"] for r in rows)


def test_mixing_in_many_blocks_keeps_words(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 60)), "s" if i % 3 else "t") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.mix_sources(df, block=8, share=1.2).collect()
    for s in "st":
        own = [r for r in got if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 60
    low = own[0]["target"] / own[0]["source_size"]
    assert {r["copies"] for r in own} == {int(low), int(low) + 1}


def test_substrings(docs, empty, spark):
    passage = prose(20, 5)
    rows = [
        (5, f"{prose(9, 6)} {passage} {prose(9, 7)}", "x"),
        (2, f"{prose(9, 8)}\n{passage}\t{prose(9, 9)}", "x"),
        (3, passage, "x"),
        (4, " ".join(passage.split()[:12]), "x"),
        (6, prose(40, 10) + " " + prose(40, 10), "x"),  # repeats itself: stays
        (8, None, "x"),
        (7, BASE, "x"),
        (7, BASE, "x"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, spans string")
    got = {r["doc_id"]: r for r in substrings.remove_repeats(df).collect()}
    assert (got[2]["n_removed"], got[3]["n_removed"], got[4]["n_removed"], got[5]["n_removed"]) == (0, 20, 0, 20)
    assert got[3]["text"] == "" and got[2]["text"] == rows[1][1] and got[8]["text"] is None
    assert got[5]["text"] == f"{prose(9, 6)} {prose(9, 7)}"
    assert [(s["from"], s["to"]) for s in got[5]["spans"]] == [(9, 29)]
    assert got[6]["n_removed"] == 0 and got[7]["n_removed"] == 0
    odd = substrings.remove_repeats(docs)
    assert odd.count() == len(CASES) and substrings.remove_repeats(empty).count() == 0
    assert {r["n_removed"] for r in odd.filter("doc_id = 3").collect()} == {60}


@pytest.mark.parametrize("span, anchor", [(13, 5), (13, 13), (4, 1), (6, 2)])
def test_substrings_against_brute_force(spark, span, anchor):
    rng = random.Random(span)
    rows = [(i, " ".join(rng.choices("ab" if i % 5 == 0 else "abcdefg", k=rng.randrange(0, 60)))) for i in range(80)]
    got = by_id(substrings.repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), span=span, anchor=anchor), "id")
    first = {}
    for doc, text in rows:
        words = text.split()
        places = [p for p in range(len(words) - span + 1) if first.setdefault(tuple(words[p : p + span]), doc) < doc]
        assert sorted(got[doc]["places"] if doc in got else []) == places


def test_packing(docs, empty):
    rows = packing.pack(docs, tokenizer_file()).collect()
    assert sum(r["start"] == 0 for r in rows) == len(CASES)
    assert all(len(r["ids"]) == r["length"] for r in rows)
    assert [(r["length"], r["ids"]) for r in rows if r["doc_id"] == 5] == [(1, [1])]
    assert sorted(r["sequence_id"] for r in rows) == list(range(len(rows)))
    assert packing.pack(empty, tokenizer_file()).count() == 0
    assert packing.piece_lengths(2048 * 2 + 5) == [2048, 2048, 4, 1] and packing.piece_lengths(0) == []


def test_encoder_is_that_of_the_file(docs):
    from tokenizers import Tokenizer

    slow, fast = Tokenizer.from_file(tokenizer_file()), packing.encoder(tokenizer_file())
    odd = [r[1] or "" for r in CASES] + ["a b c \n\n x", "<|endoftext|> it's 12٣ x", "\x00\x1f", " \t ", "日本 don't I'LL"]
    for text in odd:
        assert fast(text).tolist() == slow.encode(text, add_special_tokens=False).ids


def test_token_ledger(spark, docs, empty):
    def rows(*values):
        return spark.createDataFrame(values, token_counts.CHANGES)

    def totals():
        return {(r["source"], r["lang"], r["version"]): (r["docs"], r["tokens"]) for r in ledger.totals().collect()}

    folder = Workspace(spark, "t").root
    ledger = token_counts.Ledger(spark, folder)
    assert totals() == {}
    first = rows((1, "v", False, "a", "en", 10, 0), (2, "v", False, "a", None, 5, 0), (3, "v", False, None, "en", None, 0), (None, "v", False, "a", "en", 9, 0))
    assert ledger.commit("one", first) and not ledger.commit("one", first)
    assert totals() == {("a", "en", "v"): (1, 10), ("a", None, "v"): (1, 5), (None, "en", "v"): (1, 0)}
    second = rows((1, "v", False, "b", "en", 12, 1), (1, "v", False, "b", "en", 11, 0), (2, "v", True, None, None, 0, 0), (8, "v", True, "a", "en", 3, 0), (1, "w", False, "a", "en", 7, 0))
    assert ledger.commit("two", second)
    again = token_counts.Ledger(spark, folder)
    assert not again.commit("two", second) and again.batches() == ["one", "two"]
    assert totals() == {("b", "en", "v"): (1, 12), (None, "en", "v"): (1, 0), ("a", "en", "w"): (1, 7)}
    assert ledger.commit("three", rows((2, "v", False, "a", "en", 6, 0)))
    assert totals()[("a", "en", "v")] == (1, 6)
    # A batch that broke off before its commit file does not count, and its next attempt does.
    rows((4, "v", False, "a", "en", 1, 0)).drop("seq").withColumn("number", F.lit(3)).write.parquet(f"{folder}/documents/four")
    assert totals()[("a", "en", "v")] == (1, 6)
    assert ledger.commit("four", rows((4, "v", False, "a", "en", 2, 0))) and totals()[("a", "en", "v")] == (2, 8)
    counts = token_counts.counted(docs, {"v": mixing.WORD})
    assert {r["doc_id"]: r["tokens"] for r in counts.collect()}[7] == 2
    assert token_counts.counted(empty, {"v": mixing.WORD}).count() == 0
    with pytest.raises(ValueError):
        ledger.commit("../x", first)
