"""Deep-shallow ordering of suffixes inside a task.

Suffixes are sorted by multikey quicksort on words of eight bytes to a shallow depth. Those
still equal there go into a blind trie, which looks only at branching bytes on the way down and
compares one full string at its end. What is wanted of the order is, for every suffix, in
which of its windows it agrees with another one.
"""

from __future__ import annotations

import bisect

import numpy as np


def common(x: bytes, y: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return n
    low = 0
    while n - low > 1:  # x and y agree up to low and differ before n
        mid = (low + n) // 2
        if x[low:mid] == y[low:mid]:
            low = mid
        else:
            n = mid
    return low


def shallow_groups(suffixes: list[bytes], depth: int = 32) -> list[list[int]]:
    """Groups of suffixes with the same first ``depth`` bytes, in order, by multikey quicksort on eight-byte words."""
    words = np.frombuffer(b"".join(s[:depth].ljust(depth, b"\0") for s in suffixes), dtype=">u8").reshape(len(suffixes), depth // 8).astype(np.uint64)
    out: list[list[int]] = []
    todo = [(np.arange(len(suffixes)), 0)]
    while todo:
        rows, at = todo.pop()
        if len(rows) == 1 or at == words.shape[1]:
            out.append(rows.tolist())
            continue
        key = words[rows, at]
        pivot = key[len(key) // 2]
        less, more = key < pivot, key > pivot
        parts = [(rows[less], at), (rows[~(less | more)], at + 1), (rows[more], at)]
        todo += [p for p in reversed(parts) if len(p[0])]
    return out


class Node:
    """A branch at ``depth`` bytes, or a leaf with the suffixes that end there."""

    __slots__ = ("depth", "kids", "ids")

    def __init__(self, depth: int) -> None:
        self.depth = depth
        self.kids: dict[int, Node] = {}
        self.ids: list[int] = []


def blind_trie(suffixes: list[bytes], rows: list[int]) -> Node:
    """The trie of the given suffixes; the key of an ended suffix is -1."""
    root = Node(0)
    for i in rows:
        text = suffixes[i]
        at, path = root, []
        while at.kids:
            path.append(at)
            byte = text[at.depth] if at.depth < len(text) else -1
            at = at.kids.get(byte) or next(iter(at.kids.values()))
        if not at.ids:  # the empty trie
            leaf = Node(len(text))
            leaf.ids.append(i)
            root.kids[text[0] if text else -1] = leaf
            continue
        other = suffixes[at.ids[0]]
        n = common(text, other)
        if n == len(text) == len(other):
            at.ids.append(i)
            continue
        leaf = Node(len(text))
        leaf.ids.append(i)
        mine, theirs = (x[n] if n < len(x) else -1 for x in (text, other))
        deep = next((p for p in path if p.depth >= n), at)
        if deep is not at and deep.depth == n:
            deep.kids[mine] = leaf
            continue
        above = path[path.index(deep) - 1] if deep is not at else path[-1]
        key = next(k for k, v in above.kids.items() if v is deep)
        fork = Node(n)
        fork.kids = {theirs: deep, mine: leaf}
        above.kids[key] = fork
    return root


def agreements(lefts: list[bytes], rights: list[bytes], rows: list[int], window: int) -> dict[int, list[tuple[int, int]]]:
    """For each row the inclusive ranges of ``a`` such that its ``a`` bytes to the left and ``window - a`` to the right are also another row's.

    ``rights`` start at the same place as ``lefts`` (given reversed) end. Rows of the trie are
    merged from the deepest branch up, the smaller set into the larger, each set in the order
    of the left sides: the longest agreement to the left is that of a neighbour.
    """
    order = sorted(rows, key=lambda i: lefts[i])
    place = {i: k for k, i in enumerate(order)}
    shortest = window - max(len(lefts[i]) for i in rows)
    found: dict[int, list[tuple[int, int]]] = {}

    def meet(x: int, y: int, depth: int) -> None:
        low = max(0, window - depth)
        if low > min(len(lefts[order[x]]), len(lefts[order[y]])):
            return
        high = common(lefts[order[x]], lefts[order[y]])
        if high >= low:
            found.setdefault(order[x], []).append((low, high))
            found.setdefault(order[y], []).append((low, high))

    def insert(held: list[int], x: int, depth: int) -> None:
        at = bisect.bisect_left(held, x)
        if at:
            meet(held[at - 1], x, depth)
        if at < len(held):
            meet(x, held[at], depth)
        held.insert(at, x)

    # children before parents, without recursion
    stack, sequence = [blind_trie(rights, rows)], []
    while stack:
        node = stack.pop()
        sequence.append(node)
        stack += node.kids.values()
    sets: dict[int, list[int]] = {}
    for node in reversed(sequence):
        parts = [sets.pop(id(kid)) for kid in node.kids.values()]
        if node.depth < shortest:  # too short to the right for any window
            sets[id(node)] = []
            continue
        held = max(parts, key=len, default=[])
        for i in node.ids:
            insert(held, place[i], node.depth)
        for part in parts:
            if part is not held:
                for x in part:
                    insert(held, x, node.depth)
        sets[id(node)] = held
    return found


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Inclusive ranges, sorted, with touching ones joined."""
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]
