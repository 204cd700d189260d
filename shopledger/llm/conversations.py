"""The prefix trie of conversations: which beginnings they share, and what sharing them saves.

A turn is known by a 128-bit id of its role and text. A conversation is the sequence of its ids,
and each distinct sequence with which one begins is a node.

1. Turns are numbered after one sort by range over all rows, so that a conversation of very many
   turns is numbered by many tasks; only (id, size) of a turn goes through that sort, no text.
2. Equal conversations become one key with a count. The ids of its members are joined to text in
   sorted chunks by many tasks; only SHA-256, which is sequential, reads the chunks of a key in order.
3. Keys are grouped by their first turn. A group of more than ``GROUP_KEYS`` keys is *heavy*: it goes
   on to the turn behind the longest beginning that all its keys share, again and again, so that no
   task gets a hot beginning whole. A group that is not heavy is one adaptive radix tree in a task.
4. Sums of the trees flow up through the heavy groups, deepest first, as small tables.

A conversation is one row, of 16 bytes and one number a turn, so memory grows with the longest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopledger.llm.radix import WIDTH, RadixTree, prefix_nodes
from shopledger.llm.workspace import Workspace

GROUP_KEYS = 20_000
GROUP_BYTES = 64 << 20
ROWS_A_TASK = 1_000_000
_EMPTY = hashlib.sha256(b"").hexdigest()
_NODE = (
    "grp string, up string, top boolean, conv_id bigint, depth bigint, parent_conv_id bigint, "
    "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
)
_NODE_NAMES = [c.split()[0] for c in _NODE.split(", ")]


def _turn_id(role: Column, text: Column) -> Column:
    """128 bits in hex of role and text; the length of the role keeps the two apart."""
    return F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))


def _numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``nth`` of each row within its conversation in this task; rows come sorted."""
    conv, n = None, 0
    for batch in batches:
        convs = batch.column(0).to_numpy()
        if not len(convs):
            continue
        at = np.arange(len(convs))
        new = np.concatenate(([True], convs[1:] != convs[:-1]))
        nth = at - np.maximum.accumulate(np.where(new, at, 0))
        if conv is not None and convs[0] == conv:
            ends = np.flatnonzero(new[1:])
            nth[: int(ends[0]) + 1 if len(ends) else len(nth)] += n
        conv, n = convs[-1], int(nth[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nth)], names=["conv", "id", "chars", "part", "nth"])


def numbered_turns(
    work: Workspace,
    conversations: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    rows_a_task: int = ROWS_A_TASK,
) -> DataFrame:
    """``conv, pos, id, chars``: the turns of each conversation from 0, by ``turn`` (null first, ties by id).

    Null roles and texts are empty. Rows without a conversation are left out; repeated rows are turns
    of their own.
    """
    own_role, own_text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    rows = conversations.select(
        F.col(f"`{conv}`").cast("long").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        _turn_id(own_role, own_text).alias("id"),
        F.length(own_text).alias("chars"),
    ).filter("conv is not null")
    tasks = max(int(work.spark.conf.get("spark.sql.shuffle.partitions")), conversations.count() // rows_a_task + 1)
    keys = [F.asc("conv"), F.asc_nulls_first("turn"), F.asc("id")]
    ordered = rows.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys).select("conv", "id", "chars", F.spark_partition_id().alias("part"))
    numbered = work.keep(ordered.mapInArrow(_numbers, "conv bigint, id string, chars int, part int, nth bigint"), "numbered")
    parts = numbered.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
    spread = parts.withColumn("parts", F.count(F.lit(1)).over(W.partitionBy("conv"))).filter("parts > 1")
    before = F.sum("n").over(W.partitionBy("conv").orderBy("part")) - F.col("n")
    # At most two rows for each task: a task has one conversation at most in common with the next.
    offsets = F.broadcast(spread.select("conv", "part", before.alias("before")))
    pos = F.col("nth") + F.coalesce("before", F.lit(0))
    return work.keep(numbered.join(offsets, ["conv", "part"], "left").select("conv", pos.alias("pos"), "id", "chars"), "turns")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one key in a batch: the ids joined by commas."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_pylist()
        convs = batch.column(1).to_pylist()
        starts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1])]
        spans = list(zip(starts, [*starts[1:], len(keys)], strict=True))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([keys[a] for a, _ in spans], pa.string()),
                pa.array([convs[a] for a, _ in spans], pa.int64()),
                pa.array([b - a for a, b in spans], pa.int64()),
                pa.array([",".join(map(str, convs[a:b])) for a, b in spans], pa.string()),
            ],
            names=["hash", "low", "n", "ids"],
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the chunks of each key, which come in order; holds one state."""
    key, low, n, state = None, 0, 0, None

    def done(rows: list) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["hash", "low", "n", "ends"])

    for batch in batches:
        rows = []
        for k, first, count, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if k == key:
                state.update(b"," + ids.encode())
                n += count
                continue
            if key is not None:
                rows.append((key, low, n, state.hexdigest()))
            key, low, n, state = k, first, count, hashlib.sha256(ids.encode())
        if rows:
            yield done(rows)
    if key is not None:
        yield done([(key, low, n, state.hexdigest())])


def distinct_keys(work: Workspace, turns: DataFrame, convs: DataFrame) -> DataFrame:
    """``key, chars, n, low, ends``: each distinct conversation, its members' number, least and digest."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "id", "chars")))
    sequences = turns.groupBy("conv").agg(ordered.alias("turns"))
    key = F.coalesce(F.unhex(F.array_join(F.col("turns")["id"], "")), F.lit(b""))
    members = convs.join(sequences, "conv", "left").select("conv", key.alias("key"), F.col("turns")["chars"].alias("chars"))
    members = work.keep(members.select("conv", F.md5("key").alias("hash"), "key", "chars"), "members")
    pairs = members.select("hash", "conv")
    tasks = int(work.spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = pairs.repartitionByRange(tasks, "hash", "conv").sortWithinPartitions("hash", "conv")
    chunks = pairs.mapInArrow(_chunks, "hash string, low bigint, n bigint, ids string")
    ordered = chunks.repartition("hash").sortWithinPartitions("hash", "low")
    ends = ordered.mapInArrow(_digests, "hash string, low bigint, n bigint, ends string")
    first = members.select(F.col("conv").alias("low"), "key", "chars").join(ends, "low")
    return work.keep(first.select("key", "chars", "n", "low", "ends"), "keys")


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of each group, from an adaptive radix tree; rows come sorted by group."""
    held: list[pa.RecordBatch] = []

    def built() -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        group, up, up_low = (table.column(c)[0].as_py() for c in ("grp", "up", "up_low"))
        base = table.column("base")[0].as_py()
        tree = RadixTree()
        for entry, key in enumerate(table.column("key").to_pylist()):
            tree.insert(key[base * WIDTH :], entry)
        sizes = [s[base:] for s in table.column("chars").to_pylist()]
        ends = table.column("ends").to_pylist()
        nodes = prefix_nodes(tree, table.column("n").to_pylist(), table.column("low").to_pylist(), sizes)
        size = len(nodes.low)
        top = np.array(nodes.depth) == 1
        parent = np.where(top, up_low, np.array(nodes.parent))
        columns = [
            pa.array([group] * size, pa.string()),
            pa.array([up] * size, pa.string()),
            pa.array(top),
            *(pa.array(c, pa.int64()) for c in (nodes.low, np.array(nodes.depth) + base, parent)),
            *(pa.array(c, pa.int64()) for c in (nodes.members, nodes.children, nodes.leaves, nodes.saved)),
            pa.array([ends[e] if e >= 0 else _EMPTY for e in nodes.entry], pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=_NODE_NAMES)

    for batch in batches:
        groups = batch.column(0).to_pylist()
        start = 0
        for i in range(len(groups)):
            if i and groups[i] != groups[i - 1] or not i and held and groups[0] != held[-1].column(0)[0].as_py():
                if i > start:
                    held.append(batch.slice(start, i - start))
                yield built()
                held, start = [], i
        if len(groups) > start:
            held.append(batch.slice(start))
    if held:
        yield built()


def _stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The longest beginning (in whole turns) that all keys of a heavy group share, from the least and greatest."""
    names = ["grp", "up", "up_low", "base", "n", "low", "depth", "sizes"]
    for batch in batches:
        least, greatest = batch.column(6).to_pylist(), batch.column(7).to_pylist()
        chars, base = batch.column(8).to_pylist(), batch.column(3).to_pylist()
        depth, sizes = [], []
        for a, b, c, d in zip(least, greatest, chars, base, strict=True):
            x, y = (np.frombuffer(k[: min(len(a), len(b))], np.uint8) for k in (a, b))
            differ = np.flatnonzero(x != y)
            depth.append((int(differ[0]) if len(differ) else len(x)) // WIDTH)
            sizes.append(c[d : depth[-1]])
        columns = [*batch.columns[:6], pa.array(depth, pa.int32()), pa.array(sizes, pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def _stem_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of the shared beginnings of heavy groups."""
    for batch in batches:
        for row in batch.to_pylist():
            sizes = np.array(row["sizes"], np.int64)
            depth = np.arange(row["base"] + 1, row["depth"] + 1)
            inner = depth < row["depth"]
            size = len(depth)
            saved = row["saved"] + (row["n"] - 1) * np.cumsum(sizes[::-1])[::-1]
            whole = [np.full(size, row[c]) for c in ("low", "n", "leaves")]
            columns = [
                pa.array([row["grp"]] * size, pa.string()),
                pa.array([row["up"]] * size, pa.string()),
                pa.array(depth == row["base"] + 1),
                pa.array(whole[0]),
                pa.array(depth),
                pa.array(np.where(depth == row["base"] + 1, row["up_low"], row["low"])),
                pa.array(whole[1]),
                pa.array(np.where(inner, 1, row["children"])),
                pa.array(whole[2]),
                pa.array(saved),
                pa.array([_EMPTY if i else row["ends"] for i in inner.tolist()], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=_NODE_NAMES)


def _sums(nodes: DataFrame) -> DataFrame:
    """``up, children, leaves, saved`` over the topmost nodes of groups."""
    return nodes.filter("top").groupBy("up").agg(
        F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
    )


def prefix_trie(work: Workspace, turns: DataFrame, convs: DataFrame, group_keys: int = GROUP_KEYS, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """The nodes of the trie of the conversations ``convs`` (``conv``) with the turns ``turns``.

    Columns ``conv_id`` (least member; with ``depth`` it names the node), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``. The root, of depth 0,
    holds all conversations, those without turns too; without conversations there is no node.
    ``turns`` are as from ``numbered_turns``; only the order of ``pos`` counts.
    """
    keys = distinct_keys(work, turns, convs)
    whole = keys.agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max(F.when(F.octet_length("key") == 0, F.col("ends"))).alias("ends")).first()
    if whole["n"] is None:
        return work.spark.createDataFrame([], _NODE).drop("grp", "up", "top")
    group = F.md5(F.expr(f"substring(key, 1, {WIDTH} * (base + 1))"))
    open_ = keys.withColumns({"base": F.lit(0), "up": F.lit(""), "up_low": F.lit(whole["low"]).cast("long")})
    rounds, light = [], []
    while True:
        open_ = work.keep(open_.filter(f"octet_length(key) > {WIDTH} * base").withColumn("grp", group), "open")
        sizes = open_.groupBy("grp").agg(F.count(F.lit(1)).alias("keys"), F.sum(F.octet_length("key")).alias("bytes"))
        heavy = work.keep(sizes.filter(f"keys > {group_keys} or (keys > 1 and bytes > {group_bytes})").select("grp"), "heavy")
        if heavy.isEmpty():
            light.append(open_)
            break
        light.append(open_.join(heavy, "grp", "left_anti"))
        own = open_.join(heavy, "grp", "left_semi")
        stems = own.groupBy("grp", "up", "up_low", "base").agg(
            F.sum("n").alias("n"), F.min("low").alias("low"), F.min("key").alias("a"), F.max("key").alias("b"), F.min_by("chars", "key").alias("chars")
        )
        kinds = "grp string, up string, up_low bigint, base int, n bigint, low bigint, depth int, sizes array<int>"
        stems = work.keep(stems.mapInArrow(_stems, kinds), "stems")
        next_ = stems.select("grp", F.col("depth").alias("next"), F.col("low").alias("next_low"))
        own = own.drop("up", "up_low", "base").join(next_, "grp")
        own = own.withColumnsRenamed({"grp": "up", "next": "base", "next_low": "up_low"})
        ended = own.filter(f"octet_length(key) = {WIDTH} * base").select(F.col("up").alias("grp"), "ends")
        rounds.append((stems, work.keep(ended, "ended")))
        open_ = own
    given = ["grp", "up", "up_low", "base", "key", "chars", "n", "low", "ends"]
    rows = light[0].select(*given)
    for more in light[1:]:
        rows = rows.unionByName(more.select(*given))
    nodes = work.keep(rows.repartition("grp").sortWithinPartitions("grp").mapInArrow(_trees, _NODE), "nodes")
    sums = _sums(nodes)
    for stems, ended in reversed(rounds):
        filled = stems.join(sums.withColumnRenamed("up", "grp"), "grp").join(ended, "grp", "left")
        filled = filled.withColumn("ends", F.coalesce("ends", F.lit(_EMPTY)))
        nodes = nodes.unionByName(work.keep(filled.mapInArrow(_stem_nodes, _NODE), "stem-nodes"))
        sums = work.keep(_sums(nodes), "sums")
    under = sums.filter("up = ''").agg(F.sum("children").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    root = under.select(
        F.lit(whole["low"]).cast("long").alias("conv_id"),
        F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(whole["n"]).cast("long").alias("n_convs"),
        F.coalesce("children", F.lit(0)).cast("long").alias("n_children"),
        F.coalesce("leaves", F.lit(1)).cast("long").alias("n_leaves"),
        F.coalesce("saved", F.lit(0)).cast("long").alias("saved_tokens"),
        F.lit(whole["ends"] or _EMPTY).alias("ends_sha256"),
    )
    return nodes.drop("grp", "up", "top").unionByName(root)


def conversation_trie(
    conversations: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    group_keys: int = GROUP_KEYS,
) -> DataFrame:
    """The trie (see ``prefix_trie``) of a table with one row for each turn.

    Turns are ordered by ``turn``, null first, ties by the turn's id; null roles and texts are empty.
    Rows without a conversation are left out; repeated rows are turns of their own; other columns are
    not looked at. An empty table has no nodes.
    """
    work = Workspace(conversations.sparkSession, "conversations")
    turns = numbered_turns(work, conversations, conv, turn, role, text)
    return prefix_trie(work, turns, turns.select("conv").distinct(), group_keys)
