"""An adaptive radix tree: inner nodes take one of four layouts by their number of children."""

from __future__ import annotations

from collections.abc import Iterator

#: Children that each layout can hold: two with a list of key bytes, one with an index of all bytes, one by byte.
LAYOUTS = (4, 16, 48, 256)
_NONE = 255


class Node:
    """A compressed path of bytes, the children after it, and what ends here: a row, its count and its least id."""

    __slots__ = ("path", "layout", "keys", "children", "row", "count", "least")

    def __init__(self, path: bytes, row: int, count: int, least: int | None):
        self.path, self.row, self.count, self.least = path, row, count, least
        self.layout, self.keys, self.children = 4, bytearray(), []

    def _place(self, byte: int) -> int:
        """The child's place, or -1."""
        if self.layout == 256:
            return byte if self.children[byte] is not None else -1
        if self.layout == 48:
            return -1 if self.keys[byte] == _NONE else self.keys[byte]
        return self.keys.find(byte)

    def child(self, byte: int) -> Node | None:
        place = self._place(byte)
        return None if place < 0 else self.children[place]

    def put(self, byte: int, child: Node) -> None:
        """Set the child for a byte; a full node takes the next layout."""
        place = self._place(byte)
        if place >= 0:
            self.children[place] = child
            return
        if self.layout < 256 and len(self.children) == self.layout:
            self._grow()
        if self.layout == 256:
            self.children[byte] = child
            return
        if self.layout == 48:
            self.keys[byte] = len(self.children)
        else:
            self.keys.append(byte)
        self.children.append(child)

    def _grow(self) -> None:
        if self.layout == 4:
            self.layout = 16
        elif self.layout == 16:
            index = bytearray([_NONE]) * 256
            for place, byte in enumerate(self.keys):
                index[byte] = place
            self.layout, self.keys = 48, index
        else:
            by_byte = [None] * 256
            for byte, place in enumerate(self.keys):
                if place != _NONE:
                    by_byte[byte] = self.children[place]
            self.layout, self.keys, self.children = 256, bytearray(), by_byte

    def offspring(self) -> Iterator[Node]:
        return (c for c in self.children if c is not None)


def _shared(a: bytes, b: bytes) -> int:
    """The length of the beginning that both have."""
    if a == b[: len(a)]:
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class RadixTree:
    """Keys with a count and a least id each; a key may be the beginning of another."""

    def __init__(self):
        self.root = Node(b"", -1, 0, None)

    def insert(self, key: bytes, row: int, count: int, least: int) -> None:
        """Add ``count`` members with the key, the least of them ``least``; ``row`` is any row with this key."""
        node, at = self.root, 0
        while at < len(key):
            child = node.child(key[at])
            if child is None:
                node.put(key[at], Node(key[at:], row, count, least))
                return
            rest = key[at:]
            same = _shared(child.path, rest)
            if same < len(child.path):
                upper = Node(child.path[:same], -1, 0, None)
                child.path = child.path[same:]
                upper.put(child.path[0], child)
                node.put(key[at], upper)
                child = upper
            node, at = child, at + same
        node.row = row
        node.count += count
        node.least = least if node.least is None else min(node.least, least)

    def aligned(self, width: int) -> Iterator[tuple[int, int, int, int]]:
        """(row, depth, members, least id) for every prefix that ends at a multiple of ``width`` bytes, but the empty one.

        ``row`` is one whose key has the prefix. A compressed path gives one entry for each
        multiple in it, all with the members below.
        """
        order, stack = [], [(self.root, 0)]
        while stack:
            node, start = stack.pop()
            order.append((node, start))
            stack.extend((c, start + len(node.path)) for c in node.offspring())
        for node, start in reversed(order):  # children before parents
            for c in node.offspring():
                node.count += c.count
                node.least = c.least if node.least is None else min(node.least, c.least)
                node.row = c.row if node.row < 0 else node.row
            for depth in range(start // width + 1, (start + len(node.path)) // width + 1):
                yield node.row, depth, node.count, node.least
