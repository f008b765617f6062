"""An adaptive radix tree over fixed-width keys, and the nodes of the turn trie that it stands for.

Nodes hold their children by the next byte in one of four layouts, which grow with them: up to 4 and up to 16 sorted bytes,
up to 48 slots behind an index of 256, or 256 slots. Bytes that all keys below a node share are kept in it as its prefix (path
compression). A key may end where others go on. Keys are whole numbers of turns, ``WIDTH`` bytes each; only byte depths that
are a multiple of it are nodes of the trie, so one tree edge stands for any number of trie nodes, or for none.

A task builds trees over slices of the sorted keys. Trie nodes on the paths of a slice's first and last key may go on in the
slices beside it: they stay *open*, as sums over what is below them and closed. All others are closed where they are.
:func:`settle` joins the open nodes of neighbours, and closes those that lie inside.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Sequence
from typing import Any, NamedTuple

# Bytes of a turn's id.
WIDTH = 16
FEW, SOME, MANY, ALL = 4, 16, 48, 256
NONE = hashlib.sha256(b"").hexdigest()


class Node:
    """A tree node. ``row`` is the key that ends in it, or -1; ``any_row`` is one that goes through it."""

    __slots__ = ("any_row", "below", "end", "index", "kids", "layout", "least", "n", "over", "path", "prefix", "row", "start", "top")

    def __init__(self, prefix: bytes, row: int, any_row: int):
        self.prefix, self.row, self.any_row = prefix, row, any_row
        self.layout, self.index, self.kids = FEW, bytearray(), []

    def child(self, byte: int) -> Node | None:
        if self.layout <= SOME:
            at = self.index.find(byte)
            return self.kids[at] if at >= 0 else None
        if self.layout == MANY:
            at = self.index[byte]
            return self.kids[at - 1] if at else None
        return self.kids[byte]

    def add(self, byte: int, kid: Node) -> None:
        if self.layout < ALL and len(self.kids) == self.layout:
            self._grow()
        if self.layout <= SOME:
            at = bisect_left(self.index, byte)
            self.index.insert(at, byte)
            self.kids.insert(at, kid)
        elif self.layout == MANY:
            self.kids.append(kid)
            self.index[byte] = len(self.kids)
        else:
            self.kids[byte] = kid

    def _grow(self) -> None:
        if self.layout == FEW:
            self.layout = SOME
        elif self.layout == SOME:
            slots = bytearray(256)
            for at, byte in enumerate(self.index, 1):
                slots[byte] = at
            self.layout, self.index = MANY, slots
        else:
            self.kids = [self.kids[at - 1] if at else None for at in self.index]
            self.layout, self.index = ALL, bytearray()

    def children(self) -> list[Node]:
        return self.kids if self.layout < ALL else [kid for kid in self.kids if kid is not None]

    def split(self, at: int) -> None:
        """Cut the prefix: what is behind ``at`` moves to a new only child."""
        low = Node(self.prefix[at + 1 :], self.row, self.any_row)
        low.layout, low.index, low.kids = self.layout, self.index, self.kids
        byte = self.prefix[at]
        self.prefix, self.row, self.layout, self.index, self.kids = self.prefix[:at], -1, FEW, bytearray(), []
        self.add(byte, low)


def _shared(a: bytes, b: bytes) -> int:
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def build(keys: Sequence[bytes]) -> Node:
    """The tree of different keys; its root has no prefix."""
    root = Node(b"", -1, 0)
    for row, key in enumerate(keys):
        node, at = root, 0
        while True:
            if not key.startswith(node.prefix, at):
                node.split(_shared(node.prefix, key[at : at + len(node.prefix)]))
            at += len(node.prefix)
            if at == len(key):
                node.row = row
                break
            kid = node.child(key[at])
            if kid is None:
                node.add(key[at], Node(key[at + 1 :], row, row))
                break
            node, at = kid, at + 1
    return root


class Open(NamedTuple):
    """A trie node that may go on beyond its slices: sums over what is closed below it, and over its own ends."""

    node: bytes
    parent: bytes | None
    depth: int
    least: int | None
    n: int
    children: int
    leaves: int
    saved: int
    words: int
    ends: str | None
    on_first: bool
    on_last: bool


class Closed(NamedTuple):
    """A whole trie node; ``above`` is its parent's least member, or None where the parent, named by ``parent``, is open."""

    node: bytes | None
    parent: bytes | None
    least: int
    depth: int
    above: int | None
    n: int
    children: int
    leaves: int
    saved: int
    ends: str


def path_ids(key: bytes) -> list[bytes]:
    """The name of each trie node on the way to a key."""
    out = [b""]
    for at in range(0, len(key), WIDTH):
        out.append(hashlib.blake2b(out[-1] + key[at : at + WIDTH], digest_size=WIDTH).digest())
    return out


def _least(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


class Sums(NamedTuple):
    """Of the trie nodes below a place: how many are topmost, childless ones, and saved tokens."""

    tops: int = 0
    leaves: int = 0
    saved: int = 0

    def over(self, n: int, words: int) -> Sums:
        """With the trie node of ``n`` members and a last turn of ``words`` above them."""
        return Sums(1, self.leaves or 1, self.saved + (n - 1) * words)


def slice_nodes(keys: list[bytes], least: list[int], n: list[int], ends: list[str], words: list[Any]) -> tuple[list[Closed], list[Open]]:
    """Closed and open trie nodes of keys in ascending order, each with its least member, members, hash of them, and words of its turns."""
    root = build(keys)
    bounds = keys[0], keys[-1]
    ids = [path_ids(key) for key in bounds]
    root.start, root.end, root.path, root.over = -1, 0, (True, True), (None, None)
    order = [root]
    for node in order:  # parents first; the list grows
        for kid in node.children():
            kid.start, kid.end = node.end, node.end + 1 + len(kid.prefix)
            kid.path = tuple(on and len(key) > node.end and node.child(key[node.end]) is kid for on, key in zip(node.path, bounds))
            order.append(kid)

    def depths(node: Node) -> range:
        """The aligned depths on the edge to a node, the deepest first."""
        return range(node.end // WIDTH, node.start // WIDTH, -1)

    opened: list[Open] = []
    for node in reversed(order):  # children first
        node.least, node.n, sums = (least[node.row], n[node.row], Sums()) if node.row >= 0 else (None, 0, Sums())
        for kid in node.children():
            node.least, node.n = _least(node.least, kid.least), node.n + kid.n
            sums = Sums(*(a + b for a, b in zip(sums, kid.top)))
        own = words[node.any_row]
        node.below = sums
        if any(node.path):
            of = ids[0] if node.path[0] else ids[1]
            for depth in depths(node):
                end = ends[node.row] if node.row >= 0 and depth * WIDTH == node.end else None
                above, word = (of[depth - 1], own[depth - 1]) if depth else (None, 0)
                opened.append(Open(of[depth], above, depth, node.least, node.n, *sums, word, end, *node.path))
                node.least, node.n, sums = None, 0, Sums()  # what is open counts once it closes
        else:
            for depth in depths(node):
                sums = sums.over(node.n, own[depth - 1])
        node.top = sums

    closed: list[Closed] = []
    for node in order:  # ``over`` is the least member of the trie node above, or its name if it is open
        if any(node.path):
            node.over = None, (ids[0] if node.path[0] else ids[1])[node.end // WIDTH]
        else:
            sums, own = node.below, words[node.any_row]
            for depth in depths(node):
                end = ends[node.row] if node.row >= 0 and depth * WIDTH == node.end else NONE
                tops = sums.tops
                sums = sums.over(node.n, own[depth - 1])
                above, parent = (node.least, None) if (depth - 1) * WIDTH > node.start else node.over
                closed.append(Closed(None, parent, node.least, depth, above, node.n, tops, sums.leaves, sums.saved, end))
            if len(depths(node)):
                node.over = node.least, None
        for kid in node.children():
            kid.over = node.over
    return closed, opened


def settle(parts: Sequence[Sequence[Open]], whole: bool = False) -> tuple[list[Closed], list[Open]]:
    """The open nodes of slices that lie side by side, in their order, joined: those inside close, all if they are the ``whole``."""
    joined: dict[bytes, Open] = {}
    for i, part in enumerate(parts):
        for new in part:
            path = new.on_first and i == 0, new.on_last and i == len(parts) - 1
            old = joined.get(new.node)
            if old is None:
                joined[new.node] = new._replace(on_first=path[0], on_last=path[1])
                continue
            joined[new.node] = old._replace(
                least=_least(old.least, new.least), n=old.n + new.n, children=old.children + new.children, leaves=old.leaves + new.leaves,
                saved=old.saved + new.saved, ends=old.ends or new.ends, on_first=old.on_first or path[0], on_last=old.on_last or path[1],
            )
    closed = []
    for name in sorted(joined, key=lambda name: -joined[name].depth):
        node = joined[name]
        if (node.on_first or node.on_last) and not whole:
            continue
        del joined[name]
        leaves, saved = node.leaves or 1, node.saved + (node.n - 1) * node.words
        closed.append(Closed(name, node.parent, node.least, node.depth, None, node.n, node.children, leaves, saved, node.ends or NONE))
        if node.parent is not None:
            up = joined[node.parent]
            joined[node.parent] = up._replace(
                least=_least(up.least, node.least), n=up.n + node.n, children=up.children + 1, leaves=up.leaves + leaves, saved=up.saved + saved
            )
    return closed, list(joined.values())
