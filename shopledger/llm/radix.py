"""An adaptive radix tree over byte strings, and the turns of conversations found in it.

Inner nodes hold their children in one of four layouts (4, 16, 48 or 256 places) and grow into the
next one when full; an edge holds all bytes up to the next branch (path compression). Keys are
sequences of ids of ``WIDTH`` bytes, big-endian, so that byte order is id order. Trees are built
inside Spark tasks, one for each group of conversations with a common beginning.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

WIDTH = 16


class Sorted:
    """Up to 4 or 16 children: sorted first bytes beside their nodes."""

    __slots__ = ("bytes", "nodes", "room")

    def __init__(self, room: int):
        self.room = room
        self.bytes = bytearray()
        self.nodes: list[Node] = []

    def get(self, byte: int) -> Node | None:
        at = bisect_left(self.bytes, byte)
        return self.nodes[at] if at < len(self.bytes) and self.bytes[at] == byte else None

    def put(self, byte: int, node: Node) -> Layout:
        at = bisect_left(self.bytes, byte)
        if at < len(self.bytes) and self.bytes[at] == byte:
            self.nodes[at] = node
            return self
        if len(self.bytes) == self.room:
            grown: Layout = Sorted(16) if self.room == 4 else Indexed()
            for b, child in self.items():
                grown = grown.put(b, child)
            return grown.put(byte, node)
        self.bytes.insert(at, byte)
        self.nodes.insert(at, node)
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return zip(self.bytes, self.nodes, strict=True)


class Indexed:
    """Up to 48 children: a place for each of the 256 bytes, which names one of the nodes."""

    __slots__ = ("nodes", "places")

    def __init__(self):
        self.places = bytearray(256)  # 0: none, else the place from 1
        self.nodes: list[Node] = []

    def get(self, byte: int) -> Node | None:
        at = self.places[byte]
        return self.nodes[at - 1] if at else None

    def put(self, byte: int, node: Node) -> Layout:
        at = self.places[byte]
        if at:
            self.nodes[at - 1] = node
            return self
        if len(self.nodes) == 48:
            grown = Direct()
            for b, child in self.items():
                grown.nodes[b] = child
            return grown.put(byte, node)
        self.nodes.append(node)
        self.places[byte] = len(self.nodes)
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((b, self.nodes[at - 1]) for b, at in enumerate(self.places) if at)


class Direct:
    """A node for each of the 256 bytes."""

    __slots__ = ("nodes",)

    def __init__(self):
        self.nodes: list[Node | None] = [None] * 256

    def get(self, byte: int) -> Node | None:
        return self.nodes[byte]

    def put(self, byte: int, node: Node) -> Layout:
        self.nodes[byte] = node
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((b, node) for b, node in enumerate(self.nodes) if node is not None)


Layout = Sorted | Indexed | Direct


class Node:
    """A branch or an end: the bytes that lead here from the node above, children, and the entry that ends here."""

    __slots__ = ("children", "edge", "entry")

    def __init__(self, edge: bytes, entry: int = -1):
        self.edge = edge
        self.entry = entry
        self.children: Layout | None = None

    def add(self, node: Node) -> None:
        self.children = (self.children or Sorted(4)).put(node.edge[0], node)


def _common(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class RadixTree:
    def __init__(self):
        self.root = Node(b"")

    def insert(self, key: bytes, entry: int) -> None:
        """``entry`` (0 or more) at ``key``; a key that is there already gets the new entry."""
        above, node, at = None, self.root, 0
        while True:
            if not key.startswith(node.edge, at):
                rest = key[at : at + len(node.edge)]
                fork = Node(node.edge[: _common(node.edge, rest)])
                node.edge = node.edge[len(fork.edge) :]
                fork.add(node)
                above.add(fork)  # in the place of ``node``: both begin with the same byte
                node = fork
            at += len(node.edge)
            if at == len(key):
                node.entry = entry
                return
            child = node.children.get(key[at]) if node.children else None
            if child is None:
                node.add(Node(key[at:], entry))
                return
            above, node = node, child


@dataclass
class Nodes:
    """Nodes of the prefix trie as columns; ``parent`` is -1 for nodes without one here."""

    low: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    members: list[int] = field(default_factory=list)
    children: list[int] = field(default_factory=list)
    leaves: list[int] = field(default_factory=list)
    saved: list[int] = field(default_factory=list)
    entry: list[int] = field(default_factory=list)


def prefix_nodes(tree: RadixTree, members: list[int], low: list[int], sizes: list[list[int]]) -> Nodes:
    """A node for each sequence of whole ids with which some key begins; branches inside an id give none.

    Entry ``e`` stands for ``members[e]`` conversations, the least of them ``low[e]``; ``sizes[e]`` are
    the code points of its turns. Depths count the ids of the keys. Sums are over subtrees, top included.
    """
    order: list[tuple[Node, int, int]] = []  # node, bytes before its edge, place of the node above
    stack = [(tree.root, 0, -1)]
    while stack:
        node, start, above = item = stack.pop()
        order.append(item)
        if node.children:
            stack.extend((child, start + len(node.edge), len(order) - 1) for _, child in node.children.items())
    out = Nodes()
    # Of what lies below each tree node: conversations, the least, leaves, saved, an entry, the shallowest trie nodes.
    below: list[list] = [[0, None, 0, 0, -1, []] for _ in order]
    for place in range(len(order) - 1, -1, -1):
        node, start, above = order[place]
        total, least, leaves, saved, some, heads = below[place]
        end = start + len(node.edge)
        if node.entry >= 0:
            total += members[node.entry]
            least = low[node.entry] if least is None else min(least, low[node.entry])
            some = node.entry
        for depth in range(end // WIDTH, start // WIDTH, -1):
            here = len(out.low)
            for head in heads:
                out.parent[head] = least
            leaves = leaves if heads else 1
            saved += (total - 1) * sizes[some][depth - 1]
            out.low.append(least)
            out.depth.append(depth)
            out.parent.append(-1)
            out.members.append(total)
            out.children.append(len(heads))
            out.leaves.append(leaves)
            out.saved.append(saved)
            out.entry.append(node.entry if depth * WIDTH == end else -1)
            heads = [here]
        if above >= 0:
            up = below[above]
            up[0] += total
            up[1] = least if up[1] is None else min(up[1], least)
            up[2] += leaves
            up[3] += saved
            up[4] = some
            up[5].extend(heads)
    return out
