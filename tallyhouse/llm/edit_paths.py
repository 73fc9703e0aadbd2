"""Lists of edits as paths in a tree, so that lists with the same beginning share it.

A node is one edit; the path from the root to it is a list. Every node keeps its ancestors 1, 2,
4, ... steps up and a rolling hash of its path's letters. Two paths are compared by their longest
common prefix: both nodes are brought to one depth and lifted together past every stretch that
ends in different hashes. Equal hashes are not trusted: the letters found equal are compared
from there up to the node that both paths share, and nodes that were found equal once are joined
and not compared again.
"""

from __future__ import annotations

from collections.abc import Hashable, Iterable

# Parameters of the rolling hash; tests take small ones to see collisions.
BASE, MODULUS = 1_000_003, (1 << 61) - 1


class Path:
    __slots__ = ("up", "letter", "depth", "hash", "edit", "same")

    def __init__(self, parent: Path | None, letter: str = "", edit: Hashable = None):
        self.letter, self.edit, self.same = letter, edit, None
        self.up: list[Path] = []
        if parent is None:
            self.depth = self.hash = 0
            return
        self.depth = parent.depth + 1
        self.hash = (parent.hash * BASE + ord(letter)) % MODULUS
        up, k = parent, 0
        self.up.append(up)
        while k < len(up.up):
            up = up.up[k]
            k += 1
            self.up.append(up)

    def ancestor(self, depth: int) -> Path:
        node, steps = self, self.depth - depth
        while steps:
            k = steps.bit_length() - 1
            node, steps = node.up[k], steps - (1 << k)
        return node

    def edits(self, since: Path) -> list:
        """The edits after ``since``, an ancestor, in order."""
        found, node = [], self
        while node is not since:
            found.append(node.edit)
            node = node.up[0]
        return found[::-1]


def _joined(node: Path) -> Path:
    while node.same is not None:
        if node.same.same is not None:
            node.same = node.same.same
        node = node.same
    return node


def _verified(a: Path, b: Path) -> int:
    """Letters that two paths of one depth, equal by hash, really have in common from the root."""
    common, walked = a.depth, []
    x, y = a, b
    while x is not y and _joined(x) is not _joined(y):
        walked.append((x, y))
        if x.letter != y.letter:
            common, walked = x.depth - 1, []
        x, y = x.up[0], y.up[0]
    for x, y in walked:
        x, y = _joined(x), _joined(y)
        if x is not y:
            y.same = x
    return common


def common_prefix(a: Path, b: Path) -> int:
    """Letters in common from the root."""
    depth = min(a.depth, b.depth)
    a, b = a.ancestor(depth), b.ancestor(depth)
    if a.hash != b.hash:
        for k in reversed(range(len(a.up))):
            if k < len(a.up) and a.up[k].hash != b.up[k].hash:
                a, b = a.up[k], b.up[k]
        a, b = a.up[0], b.up[0]
    return _verified(a, b)


def precedes(a: Path, b: Path) -> bool:
    """Whether the letters of ``a`` sort before those of ``b``; a beginning sorts first."""
    common = common_prefix(a, b)
    if common == min(a.depth, b.depth):
        return a.depth < b.depth
    return a.ancestor(common + 1).letter < b.ancestor(common + 1).letter


def shared(paths: Iterable[Path]) -> Path:
    """The last node that all paths go through."""
    first, *others = paths
    for other in others:
        depth = min(first.depth, other.depth)
        first, other = first.ancestor(depth), other.ancestor(depth)
        if first is not other:
            for k in reversed(range(len(first.up))):
                if k < len(first.up) and first.up[k] is not other.up[k]:
                    first, other = first.up[k], other.up[k]
            first = first.up[0]
    return first


def cut(paths: Iterable[Path], root: Path) -> None:
    """Forget what lies above ``root``, which all paths go through: ancestors further up are
    never asked for again, and their memory is free."""
    done = {root}
    for node in paths:
        while node not in done:
            done.add(node)
            node.up = [up for k, up in enumerate(node.up) if node.depth - (1 << k) >= root.depth]
            node.same = None
            node = node.up[0]
    root.up, root.same = [], None
