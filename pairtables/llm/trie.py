"""Links between similar sets of one block, by a prefix tree of their ordered members."""

from __future__ import annotations

from bisect import bisect_right

import numpy as np


class _Node:
    __slots__ = ("label", "members", "children", "ends", "low", "high", "first", "mixed")

    def __init__(self, label: list[int], number: int, size: int):
        self.label, self.members = label, frozenset(label)
        self.children: dict[int, _Node] = {}
        self.ends: list[int] = []
        self.low = self.high = size
        self.first, self.mixed = number, False


class PrefixTree:
    """Sets are added by size; each is first searched for links with those that are in.

    ``part`` / ``whole`` is the least similarity: an overlap i of sets of x and y members
    links them if i * (whole + part) >= part * (x + y). Sets that a chain of links joins
    already are not compared again, so a group of copies costs one comparison each.
    """

    def __init__(self, part: int, whole: int):
        self.part, self.both = part, part + whole
        self.whole = whole
        self.root = _Node([], -1, 0)
        self.sizes: list[int] = []
        self.parent: list[int] = []

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def add(self, members: np.ndarray) -> list[int]:
        """Numbers of the sets that the new set, in ascending order, is joined with."""
        values = members.tolist()
        number, size = len(self.sizes), len(values)
        self.sizes.append(size)
        self.parent.append(number)
        found = self._search(values, number)
        self._insert(values, number, size)
        return found

    def _search(self, values: list[int], number: int) -> list[int]:
        size, own, found = len(values), set(values), []
        least = -(-self.part * size // self.whole)
        stack = [(child, 0, 0) for child in self.root.children.values()]
        while stack:
            node, matched, depth = stack.pop()
            if node.high < least or (not node.mixed and self.find(node.first) == self.find(number)):
                continue
            matched += len(own & node.members)
            depth += len(node.label)
            rest = size - bisect_right(values, node.label[-1])
            most = matched + min(rest, node.high - depth)
            if most * self.both < self.part * (size + max(node.low, least)):
                continue
            for other in node.ends:
                if matched * self.both >= self.part * (size + self.sizes[other]):
                    a, b = self.find(number), self.find(other)
                    if a != b:
                        self.parent[max(a, b)] = min(a, b)
                        found.append(other)
            stack += [(child, matched, depth) for child in node.children.values()]
        return found

    def _note(self, node: _Node, number: int, size: int) -> None:
        node.low, node.high = min(node.low, size), max(node.high, size)
        if not node.mixed and self.find(node.first) != self.find(number):
            node.mixed = True

    def _insert(self, values: list[int], number: int, size: int) -> None:
        node, at = self.root, 0
        while at < size:
            child = node.children.get(values[at])
            if child is None:
                node.children[values[at]] = leaf = _Node(values[at:], number, size)
                leaf.ends.append(number)
                return
            label, same = child.label, 0
            limit = min(len(label), size - at)
            while same < limit and label[same] == values[at + same]:
                same += 1
            if same < len(label):  # cut the edge
                upper = _Node(label[:same], child.first, child.low)
                upper.low, upper.high, upper.mixed = child.low, child.high, child.mixed
                child.label, child.members = label[same:], frozenset(label[same:])
                upper.children[child.label[0]] = child
                node.children[upper.label[0]] = upper
                child = upper
            self._note(child, number, size)
            node, at = child, at + same
        node.ends.append(number)


def links(sets: list[np.ndarray], part: int, whole: int) -> list[tuple[int, int]]:
    """Pairs (indices) that link the sets into the same groups as all links would."""
    tree, order, out = PrefixTree(part, whole), sorted(range(len(sets)), key=lambda i: len(sets[i])), []
    for number, i in enumerate(order):
        out += [(order[other], i) for other in tree.add(sets[i])]
    return out
