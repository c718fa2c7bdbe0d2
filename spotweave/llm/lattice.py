"""Cheapest repairs of a sequence of turns: shortest paths in a lattice, by the auction algorithm.

A node is a number of rows passed and what stands at the end of the repaired sequence: nothing, a system
turn, a user turn or an assistant turn. Arcs are edits with whole costs. The auction algorithm keeps a price
for each node, never above the cost of an arc plus the price of its head, and one path from the
origin: where the last node's price is below the least such sum it is raised and the path contracted, else
the path is extended along an arc that attains it, until it ends at the destination. Prices are
then those of an optimal dual: every cheapest path has only tight arcs (price = cost + price of
the head), and every path of tight arcs to the destination is cheapest. The tight arcs are
searched in the order of their letters, so the first path found is the least in ASCII.
"""

from __future__ import annotations

#: What stands at the end of the repaired sequence.
NONE, SYSTEM, USER, ASSISTANT = range(4)
#: Row codes: the role's initial, plus 4 if the text is truncated, plus 8 if the row must be deleted.
INITIALS = "sua"
OTHER, TRUNCATED, FORCED = 3, 4, 8
DELETE_COST, REROLE_COST, INSERT_COST = 3, 2, 2
_ENDS = (NONE, ASSISTANT)


def spread(codes: bytes, copies: tuple[int, ...]) -> list[tuple[int, int]]:
    """Rows (code, how many) of items: copies after an item's first must be deleted, all in one arc."""
    rows: list[tuple[int, int]] = []
    for code, n in zip(codes, copies, strict=True):
        if code & FORCED:
            rows.append((code, n))
        else:
            rows.append((code, 1))
            if n > 1:
                rows.append((code | FORCED, n - 1))
    return rows


def _steps(code: int, many: int, q: int) -> list[tuple[str, int, int]]:
    """Edits of a row (letter, state after it, cost), by letter."""
    out = [("D", q, DELETE_COST * many)]
    if code & FORCED:
        return out
    more, to = int(bool(code & TRUNCATED)), ASSISTANT if q == USER else USER
    role = code & 3
    if role == to - 1 or role == 0 and q == NONE:
        out.append(("K", SYSTEM if role == 0 else to, more))
    out.append(("R", to, REROLE_COST + more))
    return out


class Lattice:
    """The lattice of some rows, with the prices of its nodes.

    ``after``: the price of each state behind the rows, None where the path mustn't end; without
    it the rows are the last of their conversation, which ends complete and may have inserts at its end.
    """

    def __init__(self, rows: list[tuple[int, int]], after: tuple[int | None, ...] | None = None) -> None:
        self.end = 4 * (len(rows) + 1)
        self.arcs: list[list[tuple[str, int, int]]] = []
        insert = [(("I", ASSISTANT if q == USER else USER, INSERT_COST),) for q in range(4)]
        for i, (code, many) in enumerate(rows):
            for q in range(4):
                found = [(x, 4 * (i + 1) + to, c) for x, to, c in _steps(code, many, q)]
                x, to, c = insert[q][0]
                found.insert(1, (x, 4 * i + to, c))
                self.arcs.append(found)
        ends = tuple(0 if q in _ENDS else None for q in range(4)) if after is None else after
        for q in range(4):
            found = [("", self.end, ends[q])] if ends[q] is not None else []
            if after is None:
                x, to, c = insert[q][0]
                found.append((x, 4 * len(rows) + to, c))
            self.arcs.append(found)
        # a feasible start: what the rows from a node on cost at least, whatever is done
        least = [min(c for c in ends if c is not None)]
        for code, many in reversed(rows):
            least.append(least[-1] + (DELETE_COST * many if code & FORCED else int(bool(code & TRUNCATED))))
        self.price: list[float] = [x for x in reversed(least) for _ in range(4)] + [0]

    def cost(self, entry: int) -> int:
        """The least cost from a state before the rows; prices stay, so further entries start from better ones."""
        price, arcs, path = self.price, self.arcs, [entry]
        while path[-1] != self.end:
            at = path[-1]
            best, to = min(((c + price[j], j) for _, j, c in arcs[at]), default=(float("inf"), -1))
            if price[at] < best:
                price[at] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
        return int(price[entry])

    def trace(self, entry: int) -> tuple[list[str], int]:
        """The least of the cheapest edits from a state, and the state in which they end (after ``cost``).

        A text for each row: inserts before it and its own letter; at last the inserts behind all rows.
        """
        price, arcs = self.price, self.arcs
        tight = lambda at: iter([(x, j) for x, j, c in arcs[at] if price[at] == c + price[j]])
        path, dead = [(entry, "", tight(entry))], set()
        while path[-1][0] != self.end:
            for x, j in path[-1][2]:
                if j not in dead:
                    path.append((j, x, tight(j) if j != self.end else iter(())))
                    break
            else:
                dead.add(path.pop()[0])
        out = [""]
        for _, x, _ in path[1:-1]:
            out[-1] += x
            if x != "I":
                out.append("")
        return out, path[-2][0] % 4


def _by_item(codes: bytes, copies: tuple[int, ...], found: list[str]) -> tuple[str, ...]:
    """Letters of rows as letters of items, copies included; the last text is what follows the rows."""
    out, at = [], 0
    for code, n in zip(codes, copies, strict=True):
        if code & FORCED:
            out.append(found[at][:-1] + "D" * n)
            at += 1
        elif n > 1:
            out.append(found[at] + found[at + 1][:-1] + "D" * (n - 1))
            at += 2
        else:
            out.append(found[at])
            at += 1
    return (*out, found[at])


def solve(codes: bytes, copies: tuple[int, ...]) -> tuple[str, ...]:
    """Edits of a whole conversation: a text for each item, and the inserts at the end."""
    lattice = Lattice(spread(codes, copies))
    lattice.cost(NONE)
    return _by_item(codes, copies, lattice.trace(NONE)[0])


def crossing(codes: bytes, copies: tuple[int, ...], last: bool) -> list[int | None]:
    """Least costs from each state before some rows to each state behind them (16 numbers, None: no way).

    For the last rows of a conversation the end is in the place of the first state.
    """
    rows = spread(codes, copies)
    out: list[int | None] = [None] * 16
    if last:
        lattice = Lattice(rows)
        for e in range(4):
            out[4 * e] = lattice.cost(e)
        return out
    for to in (USER, ASSISTANT):
        lattice = Lattice(rows, tuple(0 if q == to else None for q in range(4)))
        for e in range(4):
            out[4 * e + to] = lattice.cost(e)
    # nothing or a system turn at the end: all is deleted, but for one system turn if nothing stood before
    gone = sum(DELETE_COST * n for _, n in rows)
    out[4 * NONE + NONE] = out[4 * SYSTEM + SYSTEM] = gone
    kept = [int(bool(c & TRUNCATED)) for c, _ in rows if not c & FORCED and c & 3 == 0]
    if kept:
        out[4 * NONE + SYSTEM] = gone - DELETE_COST + min(kept)
    return out


def traces(codes: bytes, copies: tuple[int, ...], after: tuple[int, ...] | None) -> tuple[list[tuple[str, ...]], list[int]]:
    """For each state before some rows their edits and the state behind them, given prices behind them."""
    lattice = Lattice(spread(codes, copies), after)
    letters, ends = [], []
    for e in range(4):
        lattice.cost(e)
        found, end = lattice.trace(e)
        letters.append(_by_item(codes, copies, found))
        ends.append(end)
    return letters, ends
