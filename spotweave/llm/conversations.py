"""Repair of the order and the faults of conversations at least cost, as shortest paths of a lattice.

Rows become facts (turn, digest, initial of the role, faults), equal rows one fact with a number. Facts are
sorted by ranges, so one long conversation is spread over tasks, and cut into pieces of at most PIECE
facts. A conversation of one piece is solved where it is. For longer ones each piece first yields its costs from
every state to every state; prices at the cuts follow from those (16 numbers for a piece), and each piece
is traced with the prices behind it, from each state that may stand before it. Texts move once,
to be put out with their edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spotweave.llm import lattice
from spotweave.llm.common import intermediates, stored

#: Facts of a piece.
PIECE = 128
_BLANKS = " \t\n\x0b\x0c\r"
_ORDER = ["conv", "turn", "digest"]  # ascending: nulls first


def named(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, ``turn``, ``role``, ``text``, ``copies``; a null role or text is one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), space(role).alias("role"), space(text).alias("text"), F.lit(1).cast("long").alias("copies"))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows as ``named`` makes them, damaged by the crc32 of ``conv:turn`` (nulls as a space) modulo 20.

    0 drops a row, 1 empties its text, 2 removes ``.``, ``!`` and ``?``, 3 doubles it, 4 makes it the user's.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv"), F.lit(":"), part("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.filter(kind != 0).select(
        "conv", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(kind == 3, F.col("copies") * 2).otherwise(F.col("copies")).alias("copies")
    )


def _digest() -> Column:
    return F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))


def facts(rows: DataFrame) -> DataFrame:
    """A row for each distinct (conversation, turn, role, text): ``conv``, ``turn``, ``digest``, ``n``, ``code`` (``lattice``).

    The first of a conversation's rows with a role and text, by turn (nulls first), is no duplicate.
    """
    last = F.right(F.rtrim("text", F.lit(_BLANKS)), F.lit(1))
    initial = F.coalesce(F.nullif(F.instr(F.lit(lattice.INITIALS), F.substring("role", 1, 1)), F.lit(0)) - 1, F.lit(lattice.OTHER))
    initial = F.when(F.length("role") == 0, lattice.OTHER).otherwise(initial)
    known = rows.select("conv", "turn", _digest().alias("digest"), "copies", initial.alias("initial"), (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"))
    found = known.groupBy("conv", "turn", "digest", "initial", "blank", "cut").agg(F.sum("copies").alias("n"))
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    again = found.filter(~F.col("blank")).groupBy("conv", "digest").agg(F.min(order).alias("first"), F.count("*").alias("k")).filter("k > 1")
    again = again.select(F.col("conv").alias("c"), F.col("digest").alias("d"), F.col("first.turn").alias("first"), F.lit(True).alias("more"))
    both = found.join(again, F.col("conv").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left")
    later = F.coalesce(F.col("more"), F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("first"))
    code = F.col("initial") + F.when(F.col("blank") | later, lattice.FORCED).when(F.col("cut"), lattice.TRUNCATED).otherwise(0)
    return both.select("conv", "turn", "digest", "n", code.cast("int").alias("code"))


def _pieces(schema):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def cut() -> Iterator[tuple]:
            held: list[tuple] = []
            for batch in batches:
                for row in zip(*(batch.column(c).to_pylist() for c in ("conv", "turn", "digest", "n", "code")), strict=True):
                    if held and (row[0] != held[0][0] or len(held) == PIECE):
                        yield (*held[0][:3], bytes(r[4] for r in held), [r[3] for r in held])
                        held = []
                    held.append(row)
            if held:
                yield (*held[0][:3], bytes(r[4] for r in held), [r[3] for r in held])

        out: list[tuple] = []
        for piece in cut():
            out.append(piece)
            if len(out) == 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types, strict=True)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types, strict=True)], schema=schema)

    return run


def _solve(batches: Iterator) -> Iterator:
    """Edits of conversations of one piece."""
    import pyarrow as pa

    known: dict[tuple, tuple[str, ...]] = {}
    for batch in batches:
        found = []
        for key in zip(batch.column("codes").to_pylist(), map(tuple, batch.column("copies").to_pylist()), strict=True):
            if key not in known:
                if len(known) > 100_000:
                    known.clear()
                known[key] = lattice.solve(*key)
            found.append(known[key])
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv", "turn", "digest", "codes")), pa.array(found, pa.list_(pa.string()))], names=["conv", "turn", "digest", "codes", "edits"])


def _costs(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in ("codes", "copies", "k", "many")), strict=True)
        found = [lattice.crossing(codes, tuple(copies), k == many) for codes, copies, k, many in keys]
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("k"), pa.array(found, pa.list_(pa.int64()))], names=["conv", "k", "costs"])


def _prices(group):
    """Prices behind each piece of a conversation but the last, from its end backwards."""
    group = group.sort_values("k", ascending=False)
    out, behind = [], None
    for costs in group["costs"]:
        out.append(behind)
        at = [None if c is None or c != c else int(c) for c in costs]
        behind = [at[4 * e] if behind is None else min(at[4 * e + x] + behind[x] for x in range(4) if at[4 * e + x] is not None) for e in range(4)]
    return group.assign(after=out)[["conv", "k", "after"]]


def _traces(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        letters, ends = [], []
        for codes, copies, after in zip(*(batch.column(c).to_pylist() for c in ("codes", "copies", "after")), strict=True):
            one, end = lattice.traces(codes, tuple(copies), None if after is None else tuple(after))
            letters.append(one)
            ends.append(end)
        kept = [batch.column(c) for c in ("conv", "k", "turn", "digest", "codes")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(letters, pa.list_(pa.list_(pa.string()))), pa.array(ends, pa.list_(pa.int32()))], names=["conv", "k", "turn", "digest", "codes", "letters", "ends"])


def _chain(group):
    """The state before each piece of a conversation, from its start on."""
    group = group.sort_values("k")
    out, state = [], lattice.NONE
    for ends in group["ends"]:
        out.append(state)
        state = int(ends[state])
    return group.assign(entry=out)[["conv", "k", "entry"]]


def edits(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Cheapest edits of rows as ``named`` makes them: for each piece ``conv``, its first fact's ``turn`` and ``digest``, ``codes``, ``edits``.

    A text for each fact in order (inserts before it, its own letter, and a D for each copy) and, at the end of a
    conversation, one of inserts. Prices at the cuts of one conversation meet in a task: 16 numbers for PIECE facts.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    known = facts(rows)
    key = known.schema["conv"].dataType
    schema = pa.schema([("conv", to_arrow_type(key)), ("turn", pa.int64()), ("digest", pa.string()), ("codes", pa.binary()), ("copies", pa.list_(pa.int64()))])
    name = key.simpleString()
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(spark, known, "repair-facts").repartitionByRange(n, *_ORDER).sortWithinPartitions(*_ORDER)
    pieces = dealt.mapInArrow(_pieces(schema), f"conv {name}, turn long, digest string, codes binary, copies array<long>")
    whole = Window.partitionBy("conv")
    pieces = pieces.withColumns({"k": F.row_number().over(whole.orderBy(*_ORDER[1:])), "many": F.count("*").over(whole)})
    pieces = stored(spark, pieces, "repair-pieces")
    single = pieces.filter("many = 1").mapInArrow(_solve, f"conv {name}, turn long, digest string, codes binary, edits array<string>")
    several = pieces.filter("many > 1")
    costs = several.mapInArrow(_costs, f"conv {name}, k int, costs array<long>")
    prices = costs.groupBy("conv").applyInPandas(_prices, f"conv {name}, k int, after array<long>").withColumnsRenamed({"conv": "c", "k": "j"})
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("k") == F.col("j"))
    traced = several.join(prices, same).drop("c", "j")
    traced = stored(spark, traced.mapInArrow(_traces, f"conv {name}, k int, turn long, digest string, codes binary, letters array<array<string>>, ends array<int>"), "repair-traces")
    entries = traced.select("conv", "k", "ends").groupBy("conv").applyInPandas(_chain, f"conv {name}, k int, entry int").withColumnsRenamed({"conv": "c", "k": "j"})
    chosen = traced.join(entries, same).select("conv", "turn", "digest", "codes", F.get("letters", F.col("entry")).alias("edits"))
    return single.unionByName(chosen)


class Replay:
    """One conversation's rows in order, with their edits: counts, and what is put out."""

    def __init__(self) -> None:
        self.first = self.last = self.before = self.key = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.state, self.audit, self.edits, self.codes, self.at = lattice.NONE, [], [], b"", 0
        self.digest, self.out, self.held = hashlib.sha256(), 0, []

    def put(self, role: str, text: str, initial: str, keep: bool) -> None:
        """A message of the repaired conversation."""
        message = f"{role}:{text}".encode("utf-8", "surrogatepass")
        self.digest.update(message if not self.out else b"\n" + message)
        if keep:
            self.held.append((self.out, role, text))
        self.out += 1
        self.state = {"s": lattice.SYSTEM, "u": lattice.USER}.get(initial, lattice.ASSISTANT)

    def next_role(self) -> str:
        return "assistant" if self.state == lattice.USER else "user"

    def apply(self, letters: str, role: str = "", text: str = "", cut: bool = False, keep: bool = False) -> None:
        """Inserts and the edit of a row, or the inserts at the end."""
        for x in letters:
            if x == "I":
                new = self.next_role()
                self.put(new, "", new[0], keep)
                self.cost += lattice.INSERT_COST
            elif x == "D":
                self.cost += lattice.DELETE_COST
            else:
                new = role if x == "K" else self.next_role()
                self.put(new, text, new[:1], keep)
                self.cost += (lattice.REROLE_COST if x == "R" else 0) + cut
        if letters:
            self.audit.append(letters)

    def row(self, turn: int | None, digest: str, role: str, text: str, copies: int, keep: bool) -> None:
        """A row and its copies, which follow rows before them by turn."""
        new = (turn, digest) != self.key
        if new:
            self.turns += turn is not None and (self.key is None or turn != self.key[0])
            self.key, self.code = (turn, digest), self.codes[self.at]
            self.apply(self.edits[self.at], role, text, bool(self.code & lattice.TRUNCATED), keep)
            self.at += 1
        if turn is not None:
            self.first = turn if self.first is None else self.first
            self.last = turn
        blank, forced = not text.strip(_BLANKS), bool(self.code & lattice.FORCED)
        faulty = copies if forced or not new else copies - 1
        self.blank += copies if blank else 0
        self.duplicate += 0 if blank else faulty
        self.truncated += int(new and not forced and bool(self.code & lattice.TRUNCATED))
        initial = role[:1]
        pairs = [(self.before, initial)] if self.before is not None else []
        self.illegal += sum(x + y not in ("su", "ua", "au") for x, y in pairs) + (copies - 1)
        self.before = initial

    def report(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.first is not None else 0
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest())


def _replay(schema, messages: bool):
    names = ("conv", "kind", "turn", "digest", "role", "text", "copies", "codes", "edits")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def made(rows: list[tuple]):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types, strict=True)], schema=schema)

        def ended(name, r: Replay) -> list[tuple]:
            if r.at < len(r.edits):
                r.apply(r.edits[r.at], keep=messages)
            if messages:
                return [(name, *x) for x in r.held]
            return [(name, *r.report())]

        one, name, out = None, None, []
        for batch in batches:
            for conv, kind, turn, digest, role, text, copies, codes, edits in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if one is None or conv != name:
                    if one is not None:
                        out += ended(name, one)
                    one, name = Replay(), conv
                if kind == 1:
                    if one.edits:  # the inserts of a piece's end, none but at the conversation's
                        one.apply(one.edits[one.at], keep=messages)
                    one.edits, one.codes, one.at = edits, codes, 0
                elif kind == 2:
                    one.row(turn, digest, role, text, copies, messages)
                if messages and len(one.held) > 1000:
                    out += [(name, *x) for x in one.held]
                    one.held = []
                if len(out) >= 5000:
                    yield made(out)
                    out = []
        if one is not None:
            out += ended(name, one)
        if out:
            yield made(out)

    return run


def _replayed(spark: SparkSession, convs: DataFrame, rows: DataFrame, messages: bool) -> DataFrame:
    """Rows and their edits, brought together by conversation and put out in order as a stream."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    planned = stored(spark, edits(spark, rows), "repair-edits").withColumn("kind", F.lit(1))
    shown = rows.withColumns({"digest": _digest(), "kind": F.lit(2)})
    marks = convs.select("conv").distinct().withColumn("kind", F.lit(0))
    together = marks.unionByName(planned, allowMissingColumns=True).unionByName(shown, allowMissingColumns=True)
    order = [*_ORDER, "kind"]
    dealt = together.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "conv").sortWithinPartitions(*order)
    name = rows.schema["conv"].dataType.simpleString()
    report = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    out = f"conv {name}, " + ("turn long, role string, text string" if messages else report)
    schema = to_arrow_schema(spark.createDataFrame([], out).schema)
    return dealt.mapInArrow(_replay(pa.schema(schema), messages), out)


def repairs(spark: SparkSession, rows: DataFrame, convs: DataFrame | None = None) -> DataFrame:
    """A row for each conversation of ``convs`` (column ``conv``; by default those of ``rows``).

    ``rows``: as ``named`` makes them, in any order. Rows follow each other by turn, nulls first, and where turns are equal by the md5 of
    role and text. ``gaps``: turns left out between the first and the last; ``blank``, ``duplicate``, ``truncated``: rows by their first
    fault; ``illegal``: neighbours whose roles don't follow each other; ``cost`` and ``audit`` of the cheapest edits (ties:
    least in ASCII); ``repaired_sha256`` of the repaired messages. A conversation without rows has zeros and empty texts, a
    null one is a conversation of its own. The audit and the digest of a conversation are one value each, so one task
    reads its rows, as a stream, and holds a few bytes for each.
    """
    with intermediates(spark, keep=1):
        return stored(spark, _replayed(spark, rows if convs is None else convs, rows, False), "repair-report")


def repaired(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """The repaired messages of all conversations: ``conv``, ``turn`` (from 0), ``role``, ``text``."""
    with intermediates(spark, keep=1):
        return stored(spark, _replayed(spark, rows, rows, True), "repair-messages")
