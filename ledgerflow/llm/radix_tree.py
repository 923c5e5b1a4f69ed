"""An adaptive radix tree over byte strings, and its nodes at multiples of a width.

Inner nodes hold their children in a layout that grows with their number: up to 4 or 16 sorted
labels, an index of 256 bytes into up to 48 places, or 256 places. A path without branches is one
string in the node below it. Strings may be starts of one another; a node where one ends holds its value.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator
from typing import Any

SORTED_SIZES, INDEXED_SIZE = (4, 16), 48


class Sorted:
    """Up to 4, then 16 children beside their sorted labels."""

    __slots__ = ("labels", "nodes", "size")

    def __init__(self) -> None:
        self.labels, self.nodes, self.size = bytearray(), [], SORTED_SIZES[0]

    def find(self, label: int) -> Node | None:
        at = self.labels.find(label)
        return self.nodes[at] if at >= 0 else None

    def put(self, label: int, node: Node) -> Sorted | Indexed:
        at = self.labels.find(label)
        if at >= 0:
            self.nodes[at] = node
            return self
        if len(self.labels) == SORTED_SIZES[-1]:
            grown = Indexed()
            for x, child in self.items():
                grown.put(x, child)
            return grown.put(label, node)
        if len(self.labels) == self.size:
            self.size = SORTED_SIZES[-1]
        at = bisect(self.labels, label)
        self.labels.insert(at, label)
        self.nodes.insert(at, node)
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return zip(self.labels, self.nodes, strict=True)


class Indexed:
    """Up to 48 children in the order of their coming; one byte for each label says where."""

    __slots__ = ("nodes", "place")

    def __init__(self) -> None:
        self.place, self.nodes = bytearray(256), []

    def find(self, label: int) -> Node | None:
        at = self.place[label]
        return self.nodes[at - 1] if at else None

    def put(self, label: int, node: Node) -> Indexed | Full:
        at = self.place[label]
        if at:
            self.nodes[at - 1] = node
        elif len(self.nodes) == INDEXED_SIZE:
            grown = Full()
            for x, child in self.items():
                grown.put(x, child)
            return grown.put(label, node)
        else:
            self.nodes.append(node)
            self.place[label] = len(self.nodes)
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((label, self.nodes[at - 1]) for label, at in enumerate(self.place) if at)


class Full:
    """A place for each of 256 labels."""

    __slots__ = ("nodes",)

    def __init__(self) -> None:
        self.nodes: list[Node | None] = [None] * 256

    def find(self, label: int) -> Node | None:
        return self.nodes[label]

    def put(self, label: int, node: Node) -> Full:
        self.nodes[label] = node
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((label, node) for label, node in enumerate(self.nodes) if node is not None)


class Node:
    """The bytes of a path without branches, what ends behind them, and what goes on from there."""

    __slots__ = ("children", "path", "value")

    def __init__(self, path: bytes, value: Any = None) -> None:
        self.path, self.value, self.children = path, value, None

    def put(self, label: int, node: Node) -> None:
        self.children = (self.children or Sorted()).put(label, node)


def common(a: bytes, b: bytes) -> int:
    """The number of bytes with which both begin."""
    n = min(len(a), len(b))
    return n - ((int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])).bit_length() + 7) // 8


class RadixTree:
    def __init__(self) -> None:
        self.root: Node | None = None

    def insert(self, key: bytes, value: Any) -> None:
        """Put value (not None) under key; a key that comes again gets the new value."""
        if self.root is None:
            self.root = Node(key, value)
            return
        above, label, node, at = None, 0, self.root, 0
        while True:
            path = node.path
            if key.startswith(path, at):
                at += len(path)
                if at == len(key):
                    node.value = value
                    return
                below = node.children.find(key[at]) if node.children else None
                if below is None:
                    node.put(key[at], Node(key[at + 1 :], value))
                    return
                above, label, node, at = node, key[at], below, at + 1
                continue
            same = common(path, key[at : at + len(path)])
            fork = Node(path[:same])
            node.path = path[same + 1 :]
            fork.put(path[same], node)
            if at + same == len(key):
                fork.value = value
            else:
                fork.put(key[at + same], Node(key[at + same + 1 :], value))
            if above is None:
                self.root = fork
            else:
                above.put(label, fork)
            return

    def aligned(self, width: int) -> Iterator[tuple[int, int, bytes, Any]]:
        """(depth, parent, last bytes, value) of the nodes at multiples of width, those inside of paths too.

        In order of the strings, depth counted in widths and parent by the order of coming out (-1: none).
        Keys must be of whole widths. Branches at other depths give no node of their own.
        """
        if self.root is None:
            return
        number = 0
        yield 0, -1, b"", self.root.value if not self.root.path else None
        # nodes to visit, the last first: bytes since the last aligned depth, that depth, its node's number
        todo = [(self.root, b"", 0, 0)]
        while todo:
            node, begun, depth, parent = todo.pop()
            begun += node.path
            whole = len(begun) // width * width
            for i in range(0, whole, width):
                depth += 1
                number += 1
                at_end = i + width == len(begun)
                yield depth, parent, begun[i : i + width], node.value if at_end else None
                parent = number
            begun = begun[whole:]
            if node.children:
                todo += [(child, begun + bytes((label,)), depth, parent) for label, child in reversed(list(node.children.items()))]
