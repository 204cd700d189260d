"""Exact duplicates, periodic runs and conversation tries: brute force and hard small tables."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopledger.llm import conversations, exact, fitting, mixing, queries, runs, substrings
from shopledger.llm.radix import Direct, Indexed, RadixTree, Sorted
from shopledger.llm.workspace import Workspace

SPACES = " \t\n\v\f\r"


def words_of(text):
    out, word = [], ""
    for c in text or "":
        if c in SPACES:
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return [*out, word] if word else out


# --- exact duplicates ------------------------------------------------------------------------

EXACT_SCHEMA = "doc_id bigint, text string, keep_id string, group_size string, kept string, sha string, _nth string, length string, survives int"
LONG = "ab c" * 60_000
EXACT = [
    (1, "one two"),
    (2, "one\ttwo "),  # more code points: stays
    (3, "onetwo"),
    (4, "One two"),
    (5, None),
    (6, ""),
    (7, " \n\r "),
    (8, LONG),
    (9, LONG.replace(" ", "")),
    (10, LONG[:-1] + "d"),
    (11, " été 🙂"),
    (12, "été 🙂"),
    (13, "é  té🙂"),
    (13, "é  té🙂"),  # a repeated row
    (3, "another text of 3"),
    (None, "one two"),
    (None, "nobody"),
    (None, "no body"),
    (None, None),
    (20, "x" * 300 + "a"),
    (21, "x" * 300 + "b"),
    (22, "x" * 300 + " a"),
]


def exact_by_hand(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups["".join(c for c in text or "" if c not in SPACES)].append((-len(text or ""), doc is None, doc or 0))
    out = []
    for text, members in groups.items():
        best = min(members)
        keep = None if best[1] else best[2]
        given = False
        for m in sorted(members):
            stays = m == best and not given
            given |= stays
            out.append((None if m[1] else m[2], keep, len(members), stays, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(map(str, out))


@pytest.mark.parametrize("options", [{}, {"filter_words": 1}, {"prefix": 2}])
def test_exact_cases(spark, options):
    docs = spark.createDataFrame([(*r, "k", "g", "x", "s", "n", "l", 1) for r in EXACT], EXACT_SCHEMA)
    got = exact.exact_duplicates(docs, digests=True, **options)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(str(tuple(r)) for r in got.collect()) == exact_by_hand(EXACT)


def test_exact_reads_survivors_only(spark):
    docs = spark.createDataFrame([(*r, "k", "g", "x", "s", "n", "l", 1) for r in EXACT], EXACT_SCHEMA)
    got = exact.exact_duplicates(docs).filter("text_sha256 is null").collect()
    unique = [t for _, _, n, _, t in map(eval, exact_by_hand(EXACT)) if n == 1]
    assert 0 < len(got) <= len(unique) and all(r["kept"] and r["group_size"] == 1 and r["keep_id"] == r["doc_id"] for r in got)


def test_exact_keeps_columns(spark):
    docs = spark.createDataFrame([(*r, "k", "g", "x", "s", "n", "l", 1) for r in EXACT], EXACT_SCHEMA)
    got = exact.exact_duplicates(docs, keep=docs.columns).filter("kept")
    assert got.columns == ["doc_id", "text", "sha", "_nth", "length", "survives", "keep_id", "group_size", "kept", "text_sha256"]
    left = {"".join(c for c in r["text"] or "" if c not in SPACES) for r in got.collect()}
    assert len(left) == got.count() == len({"".join(c for c in t or "" if c not in SPACES) for _, t in EXACT})


def test_exact_hot_group(spark):
    rows = [(i, "the same text" if i % 3 == 0 else f"text {i // 2}") for i in range(6000)]
    got = exact.exact_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), digests=True)
    assert sorted(str(tuple(r)) for r in got.collect()) == exact_by_hand(rows)


def test_exact_empty(spark):
    got = exact.exact_duplicates(spark.createDataFrame([], EXACT_SCHEMA))
    assert got.count() == 0 and got.columns[0] == "doc_id"


# --- periodic runs ---------------------------------------------------------------------------


def runs_by_hand(w, least):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i > start and i - start + q >= max(least, 2 * q):
                found.setdefault((start, i - start + q), q)
            i += 1
    return sorted((s, n, q) for (s, n), q in found.items())


def test_cover_is_a_difference_cover():
    m = runs.MODULUS
    assert {(b - a) % m for a in runs.COVER for b in runs.COVER} == set(range(m))


def test_extensions_against_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(60):
        parts, first = [], [0]
        for _ in range(rng.integers(1, 5)):
            n = int(rng.integers(1, 200))
            block = rng.integers(0, 3, int(rng.integers(1, 40)))
            parts.append(np.resize(block, n))
            parts[-1][rng.integers(0, n)] = 7
            first.append(first[-1] + n)
        x, borders, starts = runs._numbered(np.concatenate(parts).astype(np.uint64), np.array(first))
        tree = runs.CoverExtensions(x, np.searchsorted(borders, np.arange(len(x)), "left"))
        for d, part in enumerate(parts):
            if len(part) < 2:
                continue
            i = rng.integers(0, len(part) - 1, 50)
            j = np.array([rng.integers(a + 1, len(part)) for a in i])
            want = []
            for a, b in zip(i, j, strict=True):
                n = 0
                while b + n < len(part) and part[a + n] == part[b + n]:
                    n += 1
                want.append(n)
            assert tree(starts[d] + i, starts[d] + j).tolist() == want


def test_runs_against_brute_force():
    rng = random.Random(1)
    for _ in range(250):
        docs = []
        for _ in range(rng.randint(0, 6)):
            n, kind = rng.choice([0, 1, 2, 5, 20, 60, 150, 300]), rng.random()
            letters = rng.choice([1, 2, 3, 10, 1000])
            d = [rng.randrange(letters) for _ in range(n)]
            if kind < 0.5 and n:
                at = rng.randrange(n)
                p = 1 + rng.randrange(max(1, (n - at) // 3 + 1))
                d = [d[i] if i < at else d[at + (i - at) % p] for i in range(n)]
            if kind < 0.2 and n:
                d[rng.randrange(n)] = 10**6
            docs.append(d)
        least = rng.choice([3, 12])
        first = np.concatenate(([0], np.cumsum([len(d) for d in docs]))).astype(np.int64)
        got = runs.runs_of(np.array([x for d in docs for x in d], dtype=np.uint64), first, least, pairs=rng.choice([50, 1 << 18]))
        assert got.tolist() == [[k, *r] for k, d in enumerate(docs) for r in runs_by_hand(d, least)]


RUN_SCHEMA = "doc_id bigint, text string, runs string, n_words string, collapsed string, _id string"
PERIODIC = [
    (1, " ".join(["a", "b", "c"] * 5) + " tail"),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (5, "word"),
    (6, "\t".join(["été", "東京"] * 6)),
    (7, "x " * 11),  # too short
    (8, "x " * 12),
    (8, "x " * 12),
    (None, "y\n" * 40),
    (9, " ".join(["a", "b"] * 7 + ["c"] + ["a", "b"] * 7)),
    (10, " ".join(str(i % 2500) for i in range(10_000))),
    (11, "z" * 200_000),
    (12, " ".join("ab"[bin(i).count("1") % 2] for i in range(2000))),
]


def test_runs_cases(spark):
    docs = spark.createDataFrame([(*r, "r", "n", "c", "i") for r in PERIODIC], RUN_SCHEMA)
    got = runs.periodic_runs(docs)
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"]
    want = []
    for doc, text in PERIODIC:
        w = words_of(text)
        found = runs_by_hand(w, 12)
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        want.append((doc, len(w), found, " ".join(x for i, x in enumerate(w) if i not in gone)))
    rows = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got.collect()]
    assert sorted(rows, key=str) == sorted(want, key=str)


def test_runs_empty(spark):
    assert runs.periodic_runs(spark.createDataFrame([], RUN_SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        runs.periodic_runs(spark.createDataFrame([], RUN_SCHEMA), min_length=2)


def test_runs_query_plants_periods(spark):
    rows = [(i, " ".join(f"w{(i * 7 + j) % 40}" for j in range(i))) for i in range(120)] + [(None, "a b"), (500, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["text"] for r in queries.with_planted_periods(docs).collect()}
    planted = 0
    for doc, text in rows:
        if doc is None:
            continue
        w = words_of(text)
        h = zlib.crc32(str(doc).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            planted += 1
        assert words_of(got[doc]) == w
    assert planted > 3


# --- conversations ---------------------------------------------------------------------------


def test_radix_layouts():
    tree, kept = RadixTree(), {}
    rng = random.Random(2)
    for step in range(256):
        key = bytes([step * 7 % 256]) + rng.randbytes(rng.choice([0, 3, 31]))
        tree.insert(key, step)
        kept[key] = step
        kind = type(tree.root.children)
        assert kind is (Sorted if step < 16 else Indexed if step < 48 else Direct)
    assert tree.root.children.get(0) is not None
    for _ in range(500):  # keys that begin with, or are the beginning of, others
        base = rng.choice(list(kept))
        key = base[: rng.randint(0, len(base))] + rng.randbytes(rng.randint(0, 3))
        tree.insert(key, 1000 + len(kept))
        kept[key] = 1000 + len(kept)
    found, stack = set(), [(tree.root, b"")]
    while stack:
        node, before = stack.pop()
        if node.entry >= 0:
            found.add(before + node.edge)
        if node.children:
            assert node is tree.root or node.entry >= 0 or len(list(node.children.items())) > 1
            for byte, child in node.children.items():
                assert child.edge[0] == byte
                stack.append((child, before + node.edge))
    assert found == set(kept)


def trie_by_hand(rebuilt):
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved, rows = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in children[p]) or 1
        saved[p] = sum(saved[q] for q in children[p]) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
        ends = ",".join(map(str, sorted(c for c in members[p] if len(rebuilt[c]) == len(p))))
        parent = min(members[p[:-1]]) if p else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        rows.append((min(members[p]), len(p), parent, len(members[p]), len(children[p]), leaves[p], saved[p], digest))
    return sorted(map(str, rows))


def conversation_rows(seed, n, letters=3):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-50, 400), n):
        length = rng.choice([1, 1, 2, 3, 4, 6, 9])
        shared = rng.random() < 0.6
        for t in range(length):
            role = rng.choice(["user", None, ""]) if t > 3 else "user"
            text = "hello" if shared and t < 3 else rng.choice(["", None, "é🙂", "abc", "b"][:letters])
            rows.append((c, t, role, text))
    rng.shuffle(rows)
    return rows


CONV_SCHEMA = "conv_id bigint, turn bigint, role string, text string, id string, pos string, depth string, conv string, grp string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "i", "p", "d", "c", "g") for r in rows], CONV_SCHEMA)


def sequences(rows):
    out = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            out[c].append(((t is not None, t or 0), key, role, text))
    return {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in out.items()}


@pytest.mark.parametrize("seed, n, group_keys", [(1, 40, 20_000), (2, 120, 1), (3, 200, 3), (4, 200, 10)])
def test_trie_against_brute_force(spark, seed, n, group_keys):
    rows = conversation_rows(seed, n)
    rows += [(7, None, "user", "first"), (7, None, "user", "first"), (8, 1, "a", "tie"), (8, 1, "b", "tie"), (None, 0, "user", "nobody")]
    got = conversations.conversation_trie(table(spark, rows), group_keys=group_keys)
    assert sorted(str(tuple(r)) for r in got.collect()) == trie_by_hand(sequences(rows))


@pytest.mark.parametrize("group_keys", [20_000, 2])
def test_trie_of_rebuilt_conversations(spark, group_keys):
    rows = conversation_rows(9, 250, letters=5)
    whole = sequences(rows)
    rebuilt = {}
    for c, own in whole.items():
        h = zlib.crc32(str(c).encode()) % 6
        donor = c - int(np.fmod(c, 100))
        rebuilt[c] = whole.get(donor, [])[:h] + own[h:]
    assert any(not t for t in rebuilt.values())  # turnless ones are members of the root
    work = Workspace(spark, "test")
    turns = conversations.numbered_turns(work, table(spark, rows), rows_a_task=50)
    got = conversations.prefix_trie(work, *queries.rebuilt_turns(turns), group_keys=group_keys)
    assert sorted(str(tuple(r)) for r in got.collect()) == trie_by_hand(rebuilt)


def test_trie_of_a_long_conversation(spark):
    rows = [(1, t, "user", str(t % 7)) for t in range(3000)] + [(2, t, "user", str(t % 7)) for t in range(2000)] + [(3, 0, "user", "0")]
    work = Workspace(spark, "test")
    turns = conversations.numbered_turns(work, table(spark, rows), rows_a_task=100)
    assert turns.groupBy("conv").agg({"pos": "max"}).orderBy("conv").collect()[0][1] == 2999
    got = conversations.prefix_trie(work, turns, turns.select("conv").distinct(), group_keys=1)
    assert sorted(str(tuple(r)) for r in got.collect()) == trie_by_hand(sequences(rows))


def test_trie_empty(spark):
    got = conversations.conversation_trie(table(spark, []))
    assert got.count() == 0 and got.columns[0] == "conv_id"
    assert conversations.conversation_trie(table(spark, [(None, 1, "a", "b")])).count() == 0


# --- clashing names ---------------------------------------------------------------------------


def test_columns_named_like_internal_ones(spark):
    passage = " ".join(f"w{i}" for i in range(40))
    rows = [(i, f"{passage} {i}" if i % 2 else f"bad words {i} here", "en", "a", 9, 9, 9) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, label int, places int, extra int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, quality int")
    texts = fitting.sampled_texts(docs, labels, "doc_id", "text", "quality", F.lit(True), 100)
    assert texts.columns == ["text", "label"] and texts.count() == 40
    cut = substrings.remove_repeats(docs)
    assert {(r["label"], r["places"], r["extra"]) for r in cut.collect()} == {(9, 9, 9)}
    mixed = mixing.mix_sources(docs)
    assert {r["extra"] for r in mixed.collect()} == {9} and mixed.count() == 40
