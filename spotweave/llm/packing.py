"""Best-fit packing of token sequences by patterns fitted to the length histogram.

Pieces of at most ``capacity`` tokens are counted by length. Patterns of a few documents that
fill a sequence are enumerated on a grid of lengths; non-negative least squares fit their
repeat counts to the histogram; the counts are rounded and laid out with exact lengths; and
what is left is packed by best fit into the room that remains, or new sequences. All of that
works on the histogram, which has ``capacity`` cells at most; pieces then find their place by
their rank among the pieces of equal length.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spotweave.llm.common import stored, text_or_empty
from spotweave.llm.tokenizing import encoder


#: Room that a sequence laid out by a pattern may leave.
WASTE = 16


@dataclass
class Run:
    """``times`` sequences with the same contents: (length, copies) one after another."""

    times: int
    room: int
    items: list[tuple[int, int]] = field(default_factory=list)


def best_pattern(value: np.ndarray, filled: np.ndarray, most: int) -> tuple[float, tuple[int, ...]]:
    """Of all patterns of up to ``most`` classes in ``filled`` that sum to the last class exactly, the one with the greatest sum of ``value``.

    All are enumerated by dynamic programming over the number of pieces and their sum.
    """
    classes = len(value) - 1
    worth = np.where(filled, value, -np.inf)
    worth[0] = -np.inf
    back = np.subtract.outer(np.arange(classes + 1), np.arange(classes + 1))  # the sum before a piece of that class
    best, picks = np.full(classes + 1, -np.inf), []
    best[0] = 0
    found, at = (-np.inf, ()), 0
    for m in range(1, most + 1):
        step = np.where(back >= 0, best[back], -np.inf) + worth
        pick = step.argmax(axis=1)
        best = step[np.arange(classes + 1), pick]
        picks.append(pick)
        if best[classes] > found[0]:
            found, at = (float(best[classes]), ()), m
    pattern, rest = [], classes
    for m in range(at - 1, -1, -1):
        pattern.append(int(picks[m][rest]))
        rest -= pattern[-1]
    return found[0], tuple(sorted(pattern, reverse=True))


def fitted(want: np.ndarray, most: int) -> list[tuple[tuple[int, ...], float]]:
    """Patterns and their repeat counts, not negative, whose classes are nearest to the histogram ``want`` by weighted least squares.

    An active set method (Lawson and Hanson): the pattern on which the misfit falls fastest joins,
    the active counts are solved for, and those that would be negative leave. It ends when no pattern
    lowers the misfit; each class has a weight of one over its count.
    """
    weight = 1 / np.sqrt(np.maximum(want, 1))
    target, filled = want * weight, want > 0
    found: list[tuple[int, ...]] = []
    a, x = np.zeros((len(want), 0)), np.zeros(0)
    while True:
        gain, pattern = best_pattern((target - a @ x) * weight, filled, most)
        if gain <= 1e-6 or pattern in found:
            break
        found.append(pattern)
        column = np.bincount(pattern, minlength=len(want)) * weight
        a, x = np.column_stack([a, column]), np.append(x, 0.0)
        while len(x):
            z = np.linalg.solve(a.T @ a + 1e-9 * np.eye(len(x)), a.T @ target)
            low = z <= 0
            if not low.any():
                x = z
                break
            step = float(np.min(x[low] / np.maximum(x[low] - z[low], 1e-300)))
            x = x + step * (z - x)
            stay = ~(low & (x <= 1e-9))
            if stay.all():
                stay[np.flatnonzero(low)[x[low].argmin()]] = False
            a, x, found = a[:, stay], x[stay], [p for p, s in zip(found, stay, strict=True) if s]
        if pattern not in found:  # within rounding the misfit is least
            break
    return list(zip(found, x.tolist(), strict=True))


def plan(counts: np.ndarray, capacity: int, classes: int = 128, most: int = 6) -> list[Run]:
    """Sequences for ``counts[length]`` pieces of each length up to ``capacity``.

    Counts of patterns are rounded down, and what that leaves is given once more to each, the
    largest remainders first, as far as there are pieces.
    """
    left = counts.astype(np.int64).copy()
    unit = -(-capacity // classes)
    classes = capacity // unit
    runs: list[Run] = []
    in_class = np.zeros(classes + 1, dtype=np.int64)
    np.add.at(in_class, np.minimum(-(-np.arange(capacity + 1) // unit), classes), left)
    in_class[0] = 0
    fit = fitted(in_class, most) if in_class.any() else []
    for pattern, times in sorted(fit, key=lambda f: -f[1]):
        if int(times):
            runs += _laid_out(pattern, int(times), left, unit, capacity)
    for pattern, _ in sorted(fit, key=lambda f: int(f[1]) - f[1]):
        runs += _laid_out(pattern, 1, left, unit, capacity)
    _best_fit(runs, left, capacity)
    return runs


def _laid_out(pattern: tuple[int, ...], times: int, left: np.ndarray, unit: int, capacity: int) -> list[Run]:
    """Runs of a pattern, largest class first, as far as there are pieces.

    Each piece is the longest of its class, the last one the longest that the room holds. It ends
    too where more than ``WASTE`` tokens of room would be left, for best fit does better then.
    """
    out = []
    while times > 0:
        want: dict[int, int] = {}
        room = capacity
        for k, c in enumerate(pattern):
            low, high = (c - 1) * unit + 1, room if k + 1 == len(pattern) else min(c * unit, capacity)
            of = next((x for x in range(high, low - 1, -1) if left[x] > want.get(x, 0)), 0)
            if not of:
                return out
            want[of] = want.get(of, 0) + 1
            room -= of
        if room > WASTE:
            return out
        n = min(times, *(int(left[x]) // k for x, k in want.items()))
        for x, k in want.items():
            left[x] -= n * k
        out.append(Run(n, room, sorted(want.items(), reverse=True)))
        times -= n
    return out


def _best_fit(runs: list[Run], left: np.ndarray, capacity: int) -> None:
    """Put what is left, longest first, where the least room holds it; else in new sequences."""
    by_room: dict[int, list[Run]] = {}
    rooms: list[int] = []

    def put(run: Run) -> None:
        if run.room not in by_room:
            by_room[run.room] = []
            bisect.insort(rooms, run.room)
        by_room[run.room].append(run)

    for run in runs:
        put(run)
    for length in np.flatnonzero(left)[::-1].tolist():
        n = int(left[length])
        while n:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                copies = min(n, capacity // length)
                run = Run(n // copies, capacity - copies * length, [(length, copies)])
                runs.append(run)
                n -= run.times * copies
                put(run)
                continue
            room = rooms[at]
            run = by_room[room].pop()
            if not by_room[room]:
                del by_room[room], rooms[at]
            if run.times > n:
                rest = Run(run.times - n, run.room, list(run.items))
                runs.append(rest)
                put(rest)
                run.times = n
            run.items.append((length, 1))
            run.room -= length
            n -= run.times
            put(run)
    left[:] = 0


@dataclass
class Places:
    """For each length, blocks of ranks and where they go, as arrays sorted by length and first rank."""

    length: np.ndarray
    rank: np.ndarray
    copies: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the piece of that rank among those of its length."""
        block = np.searchsorted(self.length << 40 | self.rank, length << 40 | rank, side="right") - 1
        within = rank - self.rank[block]
        return self.sequence[block] + within // self.copies[block], self.offset[block] + within % self.copies[block] * length


def places(runs: list[Run]) -> Places:
    """The plan as blocks of ranks."""
    used: dict[int, int] = {}
    rows, first = [], 0
    for run in runs:
        offset = 0
        for length, copies in run.items:
            rows.append((length, used.get(length, 0), copies, first, offset))
            used[length] = used.get(length, 0) + run.times * copies
            offset += length * copies
        first += run.times
    rows.sort()
    return Places(*(np.array([r[i] for r in rows], dtype=np.int64) for i in range(5)))


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int, spaces: bool = False, keep: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """The pieces of each document: ``keep``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids`` (binary, little-endian 32 bit)."""
    kind = dict(docs.dtypes)[keep]

    def cut(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa

        known, last = encoder(tokenizer_path, spaces), int(end_id).to_bytes(4, "little")
        for batch in batches:
            row, piece, start, length, crc, raw = [], [], [], [], [], []
            for i, ids in enumerate(known.batch(batch.column("text").to_pylist())):
                whole = b"".join([*ids, last])
                for k, at in enumerate(range(0, len(whole), 4 * capacity)):
                    part = whole[at : at + 4 * capacity]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    raw.append(part if with_ids else b"")
            cols = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            names = [keep, "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(raw, pa.binary())] if with_ids else cols, names=[*names, "ids"] if with_ids else names)
        known.rest()

    schema = f"`{keep}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col(keep), text_or_empty(text_col).alias("text")).mapInArrow(cut, schema)


def pack(spark: SparkSession, cut: DataFrame, capacity: int = 4096, rows_a_task: int = 200_000) -> DataFrame:
    """Pieces (with ``length`` from 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    A length that many pieces share is ranked in parts of about ``rows_a_task`` rows. Equal rows
    are interchangeable. No pieces give no rows.
    """
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect():  # capacity rows at most
        counts[r["length"]] = r["n"]
    where = places(plan(counts, capacity))
    parts = max(1, -(-int(counts.max()) // rows_a_task))
    names = [c for c in cut.columns if c not in ("ids",)]
    dealt = cut.withColumn("_part", F.pmod(F.xxhash64(*names), F.lit(parts)).cast("int"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("length", "_part").agg(F.count("*").alias("n"))
    starts = starts.select("length", "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    inner = Window.partitionBy("length", "_part").orderBy(*names)
    ranked = dealt.withColumn("_rank", F.row_number().over(inner) - 1).join(starts, ["length", "_part"])
    ranked = ranked.select(*cut.columns, (F.col("_start") + F.col("_rank")).alias("_rank"))

    def place(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            sequence, offset = where.find(batch.column("length").to_numpy(), batch.column("_rank").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=[*batch.schema.names[:-1], "sequence_id", "offset"],
            )

    kinds = ", ".join(f"`{c}` {t}" for c, t in cut.dtypes)
    return ranked.mapInArrow(place, kinds + ", sequence_id long, offset long")


def pack_documents(spark: SparkSession, docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, text_col: str = "text") -> DataFrame:
    """Documents cut into pieces and packed.

    A null text is empty: one piece of the end id. A null or repeated ``doc_id`` is packed like any
    other. Other columns of ``docs`` are left out. An empty table gives an empty table.
    """
    cut = stored(spark, pieces(docs, tokenizer_path, capacity, end_id, text_col=text_col), "pack-pieces")
    return pack(spark, cut, capacity)
