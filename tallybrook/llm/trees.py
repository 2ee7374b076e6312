"""A small decision tree for a small table of labelled rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass


@dataclass(frozen=True)
class Node:
    label: int
    feature: int = -1
    cut: float = 0.0
    below: Node | None = None
    above: Node | None = None

    def of(self, row: Sequence[float]) -> int:
        node = self
        while node.feature >= 0:
            node = node.below if row[node.feature] <= node.cut else node.above
        return node.label


def _impurity(ones: int, size: int) -> float:
    return 2.0 * ones * (size - ones) / size if size else 0.0


def grown(rows: Sequence[Sequence[float]], labels: Sequence[int], depth: int = 6) -> Node:
    """A tree by Gini splits; ties go to the first feature and the lowest cut."""
    ones, size = sum(labels), len(labels)
    leaf = Node(int(2 * ones >= size))
    if not depth or ones in (0, size):
        return leaf
    best = (_impurity(ones, size) - 1e-9, -1, 0.0)
    for feature in range(len(rows[0])):
        order = sorted(range(size), key=lambda i: rows[i][feature])
        seen = 0
        for place, (i, j) in enumerate(zip(order, order[1:], strict=False), 1):
            seen += labels[i]
            low, high = rows[i][feature], rows[j][feature]
            if low < high:
                left = _impurity(seen, place) + _impurity(ones - seen, size - place)
                best = min(best, (left, feature, (low + high) / 2))
    _, feature, cut = best
    if feature < 0:
        return leaf
    below = [i for i in range(size) if rows[i][feature] <= cut]
    above = [i for i in range(size) if rows[i][feature] > cut]
    parts = [grown([rows[i] for i in part], [labels[i] for i in part], depth - 1) for part in (below, above)]
    return Node(leaf.label, feature, cut, *parts)
