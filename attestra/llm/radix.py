"""An adaptive radix tree over byte strings, and the nodes of it that end a whole turn.

Keys are fixed-width big-endian turn ids, one after the other.  A tree node holds the bytes that all keys below it
share (path compression) and its children in a layout that grows with their number: up to 4 and up to 16
sorted bytes with their nodes, up to 48 behind an index of 256 bytes, then one place for each byte.
Only byte depths that are a multiple of the width stand for a prefix of turns; those between, where two ids
have some bytes in common, give no nodes.

A tree holds a run of consecutive keys.  Prefixes of the run's first and last key may go on in the runs
before and after it: their nodes stay open, and ``stitch`` joins them.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace

WIDTH = 16
SIZE = 4  # leading bytes of an id: the UTF-8 length of the turn's text


class Layout4:
    """Sorted bytes beside their nodes."""

    room = 4
    __slots__ = ("bytes", "nodes")

    def __init__(self, children: Iterable[tuple[int, Node]] = ()):
        self.bytes, self.nodes = bytearray(), []
        for byte, node in children:
            self.bytes.append(byte)
            self.nodes.append(node)

    def get(self, byte: int) -> Node | None:
        at = self.bytes.find(byte)
        return None if at < 0 else self.nodes[at]

    def put(self, byte: int, node: Node) -> None:
        at = bisect_left(self.bytes, byte)
        if at < len(self.bytes) and self.bytes[at] == byte:
            self.nodes[at] = node
        else:
            self.bytes.insert(at, byte)
            self.nodes.insert(at, node)

    def full(self) -> bool:
        return len(self.nodes) >= self.room

    def __iter__(self) -> Iterator[tuple[int, Node]]:
        return iter(zip(self.bytes, self.nodes, strict=True))


class Layout16(Layout4):
    room = 16
    __slots__ = ()


class Layout48:
    """A place for each byte tells where its node is."""

    room = 48
    __slots__ = ("index", "nodes")

    def __init__(self, children: Iterable[tuple[int, Node]] = ()):
        self.index, self.nodes = bytearray(256), []
        for byte, node in children:
            self.put(byte, node)

    def get(self, byte: int) -> Node | None:
        at = self.index[byte]
        return self.nodes[at - 1] if at else None

    def put(self, byte: int, node: Node) -> None:
        if self.index[byte]:
            self.nodes[self.index[byte] - 1] = node
        else:
            self.nodes.append(node)
            self.index[byte] = len(self.nodes)

    def full(self) -> bool:
        return len(self.nodes) >= self.room

    def __iter__(self) -> Iterator[tuple[int, Node]]:
        return ((byte, self.nodes[at - 1]) for byte, at in enumerate(self.index) if at)


class Layout256:
    """One place for each byte."""

    room = 256
    __slots__ = ("nodes",)

    def __init__(self, children: Iterable[tuple[int, Node]] = ()):
        self.nodes: list[Node | None] = [None] * 256
        for byte, node in children:
            self.nodes[byte] = node

    def get(self, byte: int) -> Node | None:
        return self.nodes[byte]

    def put(self, byte: int, node: Node) -> None:
        self.nodes[byte] = node

    def full(self) -> bool:
        return False

    def __iter__(self) -> Iterator[tuple[int, Node]]:
        return ((byte, node) for byte, node in enumerate(self.nodes) if node is not None)


LARGER = {Layout4: Layout16, Layout16: Layout48, Layout48: Layout256}


class Node:
    """``prefix``: the bytes after the one that led here; ``ends``: members whose key ends behind them."""

    __slots__ = ("prefix", "children", "ends")

    def __init__(self, prefix: bytes):
        self.prefix, self.children, self.ends = prefix, Layout4(), []

    def put(self, byte: int, node: Node) -> None:
        if self.children.full() and self.children.get(byte) is None:
            self.children = LARGER[type(self.children)](self.children)
        self.children.put(byte, node)


def _common(a: bytes, b: bytes, at: int) -> int:
    """How many bytes of ``a`` stand in ``b`` from ``at`` on."""
    if b.startswith(a, at):
        return len(a)
    low, high = 0, min(len(a), len(b) - at)  # a[:low] is known to match
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Tree:
    def __init__(self):
        self.root = Node(b"")

    def add(self, key: bytes, member: int) -> None:
        node, above, led, at = self.root, None, 0, 0
        while True:
            same = _common(node.prefix, key, at)
            if same < len(node.prefix):  # the key leaves the compressed path: a node goes in between
                split = Node(node.prefix[:same])
                split.put(node.prefix[same], node)
                node.prefix = node.prefix[same + 1 :]
                if above is None:
                    self.root = split
                else:
                    above.put(led, split)
                node = split
            at += same
            if at == len(key):
                node.ends.append(member)
                return
            child = node.children.get(key[at])
            if child is None:
                leaf = Node(key[at + 1 :])
                leaf.ends.append(member)
                node.put(key[at], leaf)
                return
            above, led, node, at = node, key[at], child, at + 1


@dataclass
class Prefix:
    """A prefix of turns with sums over the members and the finished part of the subtree below it."""

    depth: int
    path: bytes  # digest of its turn ids
    parent: bytes | None
    size: int  # bytes of the last turn's text
    conv_id: int
    n_convs: int
    n_children: int = 0
    n_leaves: int = 0
    saved: int = 0
    ends: str | None = None  # members that end here, comma-joined
    parent_conv_id: int | None = None
    left: bool = False  # may go on in the run before
    right: bool = False  # may go on in the run after

    def take(self, child: Prefix) -> None:
        """A finished child."""
        self.n_children += 1
        self.n_leaves += child.n_leaves
        self.saved += child.saved

    def finish(self) -> Prefix:
        """Nothing more will come: the sums include the node itself."""
        self.n_leaves += not self.n_children
        self.saved += (self.n_convs - 1) * self.size
        return self


ROOT_PATH = bytes(WIDTH)


def step(path: bytes, turn: bytes) -> bytes:
    return hashlib.blake2b(path + turn, digest_size=WIDTH).digest()


def paths(key: bytes) -> list[bytes]:
    """The paths of all prefixes of a key, the root's first."""
    out = [ROOT_PATH]
    for at in range(0, len(key), WIDTH):
        out.append(step(out[-1], key[at : at + WIDTH]))
    return out


@dataclass
class _Visit:
    """A tree node on the way down; ``made``: its prefixes, the shallowest first."""

    children: Iterator[tuple[int, Node]]
    made: list[Prefix]
    path: bytes  # of the deepest prefix so far
    rest: bytes  # bytes behind it, less than a turn
    depth: int
    tops: list[Prefix] = field(default_factory=list)  # the next prefixes below


def _enter(node: Node, byte: bytes, path: bytes, rest: bytes, depth: int) -> _Visit:
    made, rest = [], rest + byte + node.prefix
    if depth < 0:  # the root
        made.append(Prefix(0, ROOT_PATH, None, 0, 0, 0))
        path, depth = ROOT_PATH, 0
    whole = len(rest) - len(rest) % WIDTH
    for at in range(0, whole, WIDTH):
        turn, above = rest[at : at + WIDTH], path
        path, depth = step(path, turn), depth + 1
        made.append(Prefix(depth, path, above, int.from_bytes(turn[:SIZE]), 0, 0))
    if node.ends and made:  # a key ends where a turn ends
        made[-1].ends = ",".join(map(str, node.ends))
        made[-1].conv_id, made[-1].n_convs = min(node.ends), len(node.ends)
    return _Visit(iter(node.children), made, path, rest[whole:], depth)


def prefixes(tree: Tree, first: bytes, last: bytes) -> tuple[list[Prefix], list[Prefix]]:
    """Finished prefixes and open ones (those of the first and last key, parents first) of a tree that is not empty."""
    left, right = set(paths(first)), set(paths(last))
    finished, still_open = [], []
    stack = [_enter(tree.root, b"", ROOT_PATH, b"", -1)]
    while stack:
        visit = stack[-1]
        child = next(visit.children, None)
        if child is not None:
            stack.append(_enter(child[1], bytes([child[0]]), visit.path, visit.rest, visit.depth))
            continue
        stack.pop()
        tops = visit.tops
        for prefix in reversed(visit.made):
            prefix.left, prefix.right = prefix.path in left, prefix.path in right
            for below in tops:
                prefix.conv_id = min(prefix.conv_id, below.conv_id) if prefix.n_convs else below.conv_id
                prefix.n_convs += below.n_convs
                if not (below.left or below.right):
                    prefix.take(below)
            if prefix.left or prefix.right:
                still_open.append(prefix)
            else:
                finished.append(prefix.finish())
                for below in tops:
                    below.parent_conv_id = prefix.conv_id
            tops = [prefix]
        if stack:
            stack[-1].tops += tops
    # In the order of the keys: the shared trunk, then what only the first key has, then what only the last has.
    return finished, sorted(still_open, key=lambda p: (not p.left, p.depth))


def stitch(runs: Iterable[list[Prefix]], whole: bool) -> tuple[list[Prefix], list[Prefix]]:
    """Join the open prefixes of consecutive runs: finished ones, and those open at both ends of all runs.

    ``whole``: the runs are all there are, and everything is finished.
    """
    finished, left_out, path = [], [], []

    def close() -> None:
        done = path.pop()
        if done.left:
            left_out.append(done)  # the run before may add to it
            return
        finished.append(done.finish())
        if path:
            path[-1].take(done)

    for number, run in enumerate(runs):
        for prefix in run:
            while len(path) > prefix.depth and path[prefix.depth].path != prefix.path:
                close()
            if len(path) > prefix.depth:
                known = path[prefix.depth]
                known.conv_id = min(known.conv_id, prefix.conv_id)
                known.n_convs += prefix.n_convs
                known.n_children += prefix.n_children
                known.n_leaves += prefix.n_leaves
                known.saved += prefix.saved
            else:
                path.append(replace(prefix, left=prefix.left and number == 0 and not whole, ends=None))
    if whole:
        while path:
            close()
        return finished, []
    trunk = sum(p.left for p in path)
    for k, prefix in enumerate(path):
        prefix.right = True
        prefix.left = k < trunk
    for prefix in left_out:
        prefix.right = False
    return finished, path[:trunk] + sorted(left_out, key=lambda p: p.depth) + path[trunk:]
