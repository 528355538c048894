"""A prefix tree over globally ordered sets, and similarity search in it.

Sets are sorted lists of token ranks, rare tokens first. Sets that begin alike
share a path, and their overlap with a query is counted once for all of them.
A subtree is left as soon as the overlap so far plus what can still come, by
the remaining lengths of both sides, misses the least overlap that the sizes
below ask for, or when no size below fits, or when all its sets are known to be
connected with the query.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass, field

from cairn.llm.components import Sets


@dataclass
class Member:
    """A set: its name, full size, and the ordered ranks of its shared tokens."""

    name: str
    size: int
    tokens: list[int]


def linked(overlap: int, a: int, b: int) -> bool:
    """Jaccard similarity of at least 0.8, in whole numbers."""
    return 9 * overlap >= 4 * (a + b)


@dataclass
class Node:
    """A stretch of tokens that all sets below have in common."""

    tokens: list[int]
    members: list[Member] = field(default_factory=list)  # that end here
    children: list[Node] = field(default_factory=list)
    smallest: int = 0
    largest: int = 0
    longest: int = 0  # most tokens after this node's stretch
    one: str | None = None  # a member, once all below are connected

    def settle(self) -> None:
        """Bounds over all sets below; children come first."""
        sizes = [m.size for m in self.members]
        self.smallest = min([*sizes, *[c.smallest for c in self.children]])
        self.largest = max([*sizes, *[c.largest for c in self.children]])
        self.longest = max([len(c.tokens) + c.longest for c in self.children], default=0)


def build(members: list[Member]) -> Node:
    """The tree of all members, without recursion."""
    ordered = sorted(members, key=lambda m: m.tokens)
    root = Node([])
    made, todo = [root], [(root, 0, len(ordered), 0)]
    while todo:
        node, low, high, depth = todo.pop()
        while low < high and len(ordered[low].tokens) == depth:
            node.members.append(ordered[low])
            low += 1
        while low < high:
            first = ordered[low].tokens
            end = low + 1
            while end < high and ordered[end].tokens[depth] == first[depth]:
                end += 1
            last, shared = ordered[end - 1].tokens, depth + 1
            while shared < min(len(first), len(last)) and first[shared] == last[shared]:
                shared += 1
            child = Node(first[depth:shared])
            node.children.append(child)
            made.append(child)
            todo.append((child, low, end, shared))
            low = end
    for node in reversed(made):
        node.settle()
    return root


def connect(members: list[Member], known: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Links that connect members not yet connected; ``known`` pairs are."""
    sets = Sets()
    for a, b in known:
        sets.join(a, b)
    root, links = build(members), []

    def settled(node: Node) -> str | None:
        """A member of the subtree if all its members are connected."""
        if node.one is None:
            names = [m.name for m in node.members]
            below = [c.one for c in node.children]
            if None in below:
                return None
            if len({sets.find(x) for x in [*names, *below]}) == 1:
                node.one = (names or below)[0]
        return node.one

    for query in members:
        tokens, has = query.tokens, set(query.tokens)
        todo = [(root, 0, 0)]
        while todo:
            node, at, overlap = todo.pop()
            if 5 * node.largest < 4 * query.size or 4 * node.smallest > 5 * query.size:
                continue
            one = settled(node)
            if one is not None and sets.find(one) == sets.find(query.name):
                continue
            if node.tokens:
                overlap += sum(t in has for t in node.tokens)
                at = bisect_right(tokens, node.tokens[-1], at)
            still = min(len(tokens) - at, node.longest)
            if not linked(overlap + still, query.size, node.smallest):
                continue
            for other in node.members:
                if linked(overlap, query.size, other.size) and sets.join(query.name, other.name):
                    links.append((query.name, other.name))
            todo += [(child, at, overlap) for child in node.children]
    return links
