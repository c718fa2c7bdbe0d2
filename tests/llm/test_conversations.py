"""Repair of conversations against a shortest-path search over whole rows."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from spotweave.llm import conversations, lattice, queries

SCHEMA = "conv_id long, turn long, role string, text string, code int, kind int, edits string, digest string"
BLANKS = " \t\n\x0b\x0c\r"


def spaced(v):
    return " " if v is None else str(v)


def damaged(conv, turn, role, text):
    """Rows that a row becomes."""
    kind = zlib.crc32(f"{spaced(conv)}:{spaced(turn)}".encode()) % 20
    role, text = spaced(role), spaced(text)
    text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
    return [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)


def cheapest(items):
    """(cost, letters, messages) by trying whole sequences in the order of cost and letters; items: (role, text, must go, truncated)."""
    done, heap = set(), [(0, "", 0, 0, ())]
    while True:
        cost, letters, i, q, messages = heapq.heappop(heap)
        if i == len(items) and q in (0, 3):
            return cost, letters, messages
        if (i, q) in done:
            continue
        done.add((i, q))
        to, name = (3, "assistant") if q == 2 else (2, "user")
        if i < len(items):
            role, text, gone, cut = items[i]
            heapq.heappush(heap, (cost + 3, letters + "D", i + 1, q, messages))
            if not gone:
                if role[:1] == "s" and q == 0:
                    heapq.heappush(heap, (cost + cut, letters + "K", i + 1, 1, (*messages, (role, text))))
                if role[:1] == name[0]:
                    heapq.heappush(heap, (cost + cut, letters + "K", i + 1, to, (*messages, (role, text))))
                heapq.heappush(heap, (cost + 2 + cut, letters + "R", i + 1, to, (*messages, (name, text))))
        heapq.heappush(heap, (cost + 2, letters + "I", i, to, (*messages, (name, ""))))


def report(rows):
    """The report of one conversation's rows, and its repaired messages."""
    out = sorted((x for r in rows for x in damaged(*r)), key=lambda z: (z[0] is not None, z[0] or 0, hashlib.md5(f"{len(z[1])}:{z[1]}{z[2]}".encode()).hexdigest()))
    seen, items, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in out:
        y = text.strip(BLANKS)
        fault = "blank" if not y else "duplicate" if (role, text) in seen else None if y[-1] in ".!?" else "truncated"
        if fault:
            faults[fault] += 1
        seen.add((role, text))
        items.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
    turns = [t for t, *_ in out if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(out, out[1:]))
    cost, letters, messages = cheapest(items)
    digest = hashlib.sha256("\n".join(f"{a}:{b}" for a, b in messages).encode()).hexdigest()
    return (gaps, *faults.values(), illegal, cost, letters, digest), messages


def made():
    rng = random.Random(5)
    role = lambda: rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "usher"])
    text = lambda: rng.choice(["Yes.", "No!", "Why?", "a cut", "", None, " \n", "Yes.", "So it is. ", "été…", "x" * 40])
    rows = [(c, t, role(), text()) for c in range(60) for t in range(rng.randint(1, 9))]
    rows += [(100, rng.choice([None, 1, 2, 3, 7]), role(), text()) for _ in range(30)]
    rows += [(None, rng.choice([None, 1, 2]), role(), text()) for _ in range(12)]
    rows += [(101, 5, "user", "Same.")] * 9 + [(102, None, None, None)] * 3 + [(103, t, "user", f"Say {t}.") for t in range(5)]
    rows += [(104, 0, "user", "Long. " * 900_000), (104, 1, "assistant", "yes " * 1_300_000)]
    rows += [(105, t, "user" if t % 2 else rng.choice(["assistant", "assistant", "system"]), rng.choice([f"Turn {t}.", f"turn {t}", "Ok."])) for t in range(400)]
    gone = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return [*rows, (gone, 0, "user", "Hi.")], gone


@pytest.mark.parametrize("piece", [4, 128])
def test_repairs_against_search(spark, monkeypatch, piece):
    monkeypatch.setattr(conversations, "PIECE", piece)  # small pieces: most conversations are cut
    rows, gone = made()
    rng = random.Random(1)
    rng.shuffle(rows)
    table = spark.createDataFrame([(*r, 7, 8, "x", "y") for r in rows], SCHEMA).repartition(3)
    named = conversations.named(table)
    found = {r[0]: tuple(r[1:]) for r in conversations.repairs(spark, conversations.damaged(named), named).collect()}
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    want = {c: report(g) for c, g in groups.items()}
    assert {c: found[c] for c in found} == {c: w[0] for c, w in want.items()}
    assert found[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    messages = {}
    for c, at, role, text in conversations.repaired(spark, conversations.damaged(named)).collect():
        messages.setdefault(c, {})[at] = (role, text)
    assert {c: tuple(m[k] for k in range(len(m))) for c, m in messages.items()} == {c: w[1] for c, w in want.items() if w[1]}


def test_repairs_of_nothing(spark):
    named = conversations.named(spark.createDataFrame([], SCHEMA))
    assert conversations.repairs(spark, named).count() == 0 and conversations.repaired(spark, named).count() == 0


def test_lattice_against_search():
    rng = random.Random(2)
    for _ in range(500):
        codes = bytes(rng.choice([0, 1, 2, 1, 2, 3, 5, 6, 4, 9, 10]) for _ in range(rng.randint(0, 9)))
        copies = tuple(rng.choice([1, 1, 1, 2, 3]) for _ in codes)
        rows = [(x, k > 0 or bool(c & 8), bool(c & 4)) for c, n in zip(codes, copies) for k in range(n) for x in ["suax"[c & 3]]]
        cost, letters, _ = cheapest([(r, "", g, t) for r, g, t in rows])
        assert (lattice.Lattice(lattice.spread(codes, copies)).cost(0), "".join(lattice.solve(codes, copies))) == (cost, letters)


def test_prices_are_of_an_optimal_dual():
    rng = random.Random(3)
    for _ in range(100):
        codes = bytes(rng.choice([0, 1, 2, 3, 5, 6, 9]) for _ in range(12))
        one = lattice.Lattice(lattice.spread(codes, (1,) * 12))
        one.cost(0)
        assert all(one.price[i] <= c + one.price[j] for i, arcs in enumerate(one.arcs) for _, j, c in arcs)


def test_query_over_whole_table(spark):
    place = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{place}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(tuple(r))
    found = queries.op11_conversations(spark, place)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r[0]: tuple(r[1:]) for r in found.collect()} == {c: report(g)[0] for c, g in groups.items()}
