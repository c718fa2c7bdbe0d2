"""Suffix-array dedup: removal of every byte in a string of 400 bytes that also starts elsewhere.

A full suffix array would move each suffix's first 400 bytes. Here only suffixes at anchors are
sorted: a window of 400 bytes has as its anchor the leftmost place, among its first 200, whose
16 bytes have the least hash, so equal windows have their anchor at the same place, and the 200
bytes from the anchor on, all inside the window, are equal too. Anchors whose 200 bytes occur
once are dropped; the suffixes of the others are sorted group by group (``deepshallow``), which
gives every repeated window exactly.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.llm.common import intermediates, stored, text_or_empty
from spotweave.llm.deepshallow import agreements, merged, shallow_groups
from spotweave.llm.shingles import Prefixes, mix, word_hashes

WINDOW, REACH, GRAM = 400, 200, 16
#: Bytes of text handled at once.
CHUNK = 1_000_000
#: Different surroundings of an anchor (16 MB of text) beyond which they aren't sorted in one task: each of their windows is compared by a key of its own.
MOST = 20_000


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` entries that follow each other."""
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if have < width else x


def anchors(
    a: np.ndarray, b: np.ndarray, first: Prefixes, second: Prefixes, starts: np.ndarray, ends: np.ndarray, window: int, reach: int, gram: int
) -> tuple[np.ndarray, ...]:
    """Anchors of sequences that lie one after another, from prefix sums by two hashes.

    For each anchor: number of the sequence, anchor, first and last window (places in the sequence),
    digest of the symbols after the anchor and digest of the surroundings. Sequences of fewer
    than ``window`` symbols have none.
    """
    size = len(a) - 1
    n = size - gram + 1
    if size < window:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(6))
    key = mix((a[gram:] - a[:-gram]) * first.inverse[:n]) & np.uint64(0xFFFFFFFF00000000)
    key |= np.arange(n, dtype=np.uint64)
    best = (_sliding_min(key, reach) & np.uint64(0xFFFFFFFF)).astype(np.int64)[: size - window + 1]
    valid = np.zeros(len(best) + 1, dtype=np.int64)
    long = ends - starts >= window
    np.add.at(valid, starts[long], 1)
    np.add.at(valid, ends[long] - window + 1, -1)
    inside = np.cumsum(valid[:-1]) > 0
    change = np.flatnonzero(np.concatenate([[True], (best[1:] != best[:-1]) | (inside[1:] != inside[:-1])]))
    stop = np.concatenate([change[1:], [len(best)]]) - 1
    real = inside[change]
    low, high = change[real], stop[real]
    at = best[low]
    digest = mix((a[at + window - reach] - a[at]) * first.inverse[at])
    around = (b[high + window] - b[low]) * second.inverse[low]
    around = mix(around ^ mix(((at - low) << 20 | (high - low)).astype(np.uint64)))
    row = np.searchsorted(ends, at, side="right")
    base = starts[row]
    return row, at - base, low - base, high - base, digest.view(np.int64), around.view(np.int64)


ANCHORS = "k1 long, k2 long, at int, low int, high int, digest long, around long"


def _anchors(batches: Iterator) -> Iterator:
    import pyarrow as pa

    first, second = Prefixes(False, 1), Prefixes(False, 2)
    for batch in batches:
        raw = batch.column("raw").to_pylist()
        at = 0
        while at < len(raw):
            rows, size = [], 0
            while at < len(raw) and (not rows or size + len(raw[at]) <= CHUNK):
                if len(raw[at]) >= WINDOW:
                    rows.append(at)
                    size += len(raw[at])
                at += 1
            if rows:
                data = np.frombuffer(b"".join([raw[r] for r in rows]), dtype=np.uint8)
                ends = np.cumsum([len(raw[r]) for r in rows])
                starts = ends - [len(raw[r]) for r in rows]
                with np.errstate(over="ignore"):
                    row, *cols = anchors(first.sums(data), second.sums(data), first, second, starts, ends, WINDOW, REACH, GRAM)
                of = pa.array(np.array(rows)[row])
                kinds = [pa.int32()] * 3 + [pa.int64()] * 2
                yield pa.RecordBatch.from_arrays(
                    [batch.column("k1").take(of), batch.column("k2").take(of), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                    names=["k1", "k2", "at", "low", "high", "digest", "around"],
                )


RANGES = "digest long, around long, a int, b int"


def _sorted(batches: Iterator) -> Iterator:
    """Rows of whole digests, in their order, to ranges of repeated windows."""
    import pyarrow as pa

    def groups() -> Iterator[list[tuple]]:
        held: list[tuple] = []
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("digest", "around", "copies", "left", "right")), strict=True))
            if not rows:
                continue
            held += rows
            if held[0][0] == held[-1][0]:
                continue
            last = len(held)
            while held[last - 1][0] == held[-1][0]:
                last -= 1
            yield held[:last]
            held = held[last:]
        if held:
            yield held

    for rows in groups():
        lefts, rights = [r[3][::-1] for r in rows], [r[4] for r in rows]
        out: list[tuple[int, int, int, int]] = []
        found: dict[int, list[tuple[int, int]]] = {
            i: [(WINDOW - len(rights[i]), len(lefts[i]))] for i, r in enumerate(rows) if r[2] > 1
        }
        for group in shallow_groups(rights):
            if len(group) > 1:
                for i, ranges in agreements(lefts, rights, group, WINDOW).items():
                    found.setdefault(i, []).extend(ranges)
        for i, ranges in found.items():
            out += [(rows[i][0], rows[i][1], a, b) for a, b in merged(ranges)]
        cols = list(zip(*out, strict=True)) if out else [[]] * 4
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["digest", "around", "a", "b"])


def _windows(batches: Iterator) -> Iterator:
    """Each window of each surroundings, by two hashes."""
    import pyarrow as pa

    first, second = Prefixes(False, 3), Prefixes(False, 4)
    for batch in batches:
        for digest, around, copies, left, right in zip(*(batch.column(c).to_pylist() for c in ("digest", "around", "copies", "left", "right")), strict=True):
            data = np.frombuffer(left + right, dtype=np.uint8)
            n = len(data) - WINDOW + 1
            with np.errstate(over="ignore"):
                sums = [(p.sums(data), p) for p in (first, second)]
                hashes = [mix((s[WINDOW:] - s[:-WINDOW]) * p.inverse[:n]).view(np.int64) for s, p in sums]
            cols = [np.full(n, digest), np.full(n, around), np.full(n, copies), len(left) - np.arange(n)]
            kinds = [pa.int64()] * 3 + [pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(h) for h in hashes), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                names=["w1", "w2", "digest", "around", "copies", "a"],
            )


RESULT = "k1 long, k2 long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"


def _removed(batches: Iterator) -> Iterator:
    import pyarrow as pa

    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        out: list[list] = [[] for _ in range(5)]
        for raw, copies, found in zip(*(batch.column(c).to_pylist() for c in ("raw", "copies", "found")), strict=True):
            ranges = [(0, len(raw) - 1)] if copies > 1 and len(raw) >= WINDOW else [(x["s"], x["e"] - 1) for x in found or ()]
            spans = [(a, b + 1) for a, b in merged(ranges)]
            kept, at = hashlib.sha256(), 0
            for a, b in spans:
                kept.update(raw[at:a])
                at = b
            kept.update(raw[at:])
            row = (len(raw), sum(b - a for a, b in spans), len(spans), kept.hexdigest(), [{"start": a, "end": b} for a, b in spans])
            for col, v in zip(out, row, strict=True):
                col.append(v)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), kind]
        yield pa.RecordBatch.from_arrays(
            [batch.column("k1"), batch.column("k2"), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))],
            names=["k1", "k2", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
        )


#: Words of a passage, and how far into it its anchor may lie.
PASSAGE, PASSAGE_REACH = 50, 25


def _in_batches(raw: list[bytes]) -> Iterator[range]:
    """Stretches of texts of about a million bytes, so that a task's memory doesn't grow with its batch."""
    at = 0
    while at < len(raw):
        end, size = at, 0
        while end < len(raw) and (end == at or size + len(raw[end]) <= CHUNK):
            size += len(raw[end])
            end += 1
        yield range(at, end)
        at = end


def _passage_anchors(batches: Iterator) -> Iterator:
    """Anchors of passages, in words."""
    import pyarrow as pa

    spell, first, second = Prefixes(False), Prefixes(False, 1), Prefixes(False, 2)
    for batch in batches:
        raw = batch.column("raw").to_pylist()
        for rows in _in_batches(raw):
            with np.errstate(over="ignore"):
                words, bounds = word_hashes([raw[r] for r in rows], spell)
                row, _, low, high, digest, around = anchors(
                    first.sums_of(words), second.sums_of(words), first, second, bounds[:-1], bounds[1:], PASSAGE, PASSAGE_REACH, 3
                )
            of = pa.array(row + rows.start)
            cols = [pa.array(low, pa.int32()), pa.array(high, pa.int32()), pa.array(digest, pa.int64()), pa.array(around, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("k1").take(of), batch.column("k2").take(of), *cols], names=["k1", "k2", "low", "high", "digest", "around"])


def _passage_windows(batches: Iterator) -> Iterator:
    """Two hashes of each window of ``list``."""
    import pyarrow as pa

    spell, first, second = Prefixes(False), Prefixes(False, 3), Prefixes(False, 4)
    for batch in batches:
        for k1, k2, raw, found in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "raw", "list")), strict=True):
            with np.errstate(over="ignore"):
                words, _ = word_hashes([raw], spell)
                at = np.unique(np.concatenate([np.arange(x["low"], x["high"] + 1) for x in found]))
                cols = [mix((s[at + PASSAGE] - s[at]) * p.inverse[at]).view(np.int64) for s, p in ((first.sums_of(words), first), (second.sums_of(words), second))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*cols, np.full(len(at), k1), np.full(len(at), k2))], names=["w1", "w2", "k1", "k2"])


def _several(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur in several texts, with ``n`` rows."""
    text = F.struct("k1", "k2")
    found = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min(text).alias("x"), F.max(text).alias("y"))
    return found.filter("x <> y").select(*keys, "n")


def shared_passages(spark: SparkSession, texts: DataFrame) -> DataFrame:
    """``k1``, ``k2`` of the distinct texts that share PASSAGE words in a row with another document.

    Anchors as for bytes, in words. Texts that share an anchor with equal surroundings share a
    passage; for all others that meet at an anchor, windows are compared one by one.
    """
    copied = texts.filter("copies > 1").select("k1", "k2", F.regexp_count(F.col("raw").cast("string"), F.lit(r"[^\x20\x09-\x0D]+")).alias("n"))
    copied = copied.filter(F.col("n") >= PASSAGE).select("k1", "k2")
    marks = texts.select("k1", "k2", "raw").mapInArrow(_passage_anchors, "k1 long, k2 long, low int, high int, digest long, around long")
    marks = stored(spark, marks, "passage-anchors")
    total = marks.count()
    shared = stored(spark, _several(marks, ["digest"]), "passage-digests")
    heavy = shared.filter(F.col("n") * HEAVY > total)
    met = stored(spark, meet(marks, shared.drop("n"), ["digest"], heavy), "passage-met")
    alike = _several(met, ["digest", "around"])
    alike = stored(spark, alike, "passage-alike")
    sure = meet(met, alike.drop("n"), ["digest", "around"], alike.filter(F.col("n") * HEAVY > total)).select("k1", "k2").distinct()
    sure = stored(spark, sure, "passage-sure")
    unsure = met.join(sure, ["k1", "k2"], "left_anti").select("digest").distinct()
    lists = meet(met, unsure, ["digest"], heavy).groupBy("k1", "k2").agg(F.collect_list(F.struct("low", "high")).alias("list"))
    windows = texts.join(lists, ["k1", "k2"]).select("k1", "k2", "raw", "list").mapInArrow(_passage_windows, "w1 long, w2 long, k1 long, k2 long")
    windows = stored(spark, windows, "passage-windows")
    same = _several(windows, ["w1", "w2"])
    same = stored(spark, same, "passage-same")
    found = meet(windows, same.drop("n"), ["w1", "w2"], same.filter(F.col("n") * HEAVY > total)).select("k1", "k2")
    return copied.union(sure).union(found).distinct()


#: A digest, or one kind of surroundings, that has more than one in this many of all anchors is heavy: at most as many can be.
HEAVY = 1000


def meet(left: DataFrame, right: DataFrame, keys: list[str], heavy: DataFrame) -> DataFrame:
    """Inner join in which no task gets all rows of a frequent key.

    ``heavy``: the frequent keys, at most HEAVY rows; what ``right`` has for them (a bounded number of
    rows for each key) is broadcast, everything else is joined by key.
    """
    few = F.broadcast(heavy.select(*keys))
    hot = left.join(F.broadcast(right.join(few, keys, "left_semi")), keys)
    return hot.unionByName(left.join(few, keys, "left_anti").join(right.join(few, keys, "left_anti"), keys))


def repeated_spans(spark: SparkSession, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``spans``.

    ``spans``: the maximal removed runs of bytes, (start, end), end exclusive. All judged on
    the input; matches lie within documents. A null text is empty; texts below 400 bytes lose
    nothing; a text that occurs twice loses all of itself. Repeated rows give a row each; columns of
    these names are replaced; an empty table gives an empty table.

    ``has_repeats`` says whether a passage of PASSAGE words or more (or all of the text) is also in
    another document, however many bytes it has (``passages``).

    Equal texts are one row (and a count) from the start, in a table bucketed by the hash of the
    text, so texts are exchanged once. Joins meet them by that hash. The table is dropped in the end.
    """
    made = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "has_repeats"]
    text = text_or_empty(text_col)
    rest = F.struct(*[c for c in docs.columns if c not in (*made, text_col)]).alias("_row")  # whatever names it has
    hashes = [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("spotweave"), text).alias("k2")]
    raw = docs.select(*hashes, text.cast("binary").alias("raw"))
    single = raw.groupBy("k1", "k2").agg(F.first("raw").alias("raw"), F.count("*").alias("copies"))
    table = f"suffix_texts_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    single.write.bucketBy(buckets, "k1", "k2").option("compression", "zstd").format("parquet").saveAsTable(table)
    try:
        with intermediates(spark, keep=1):
            result = _removals(spark, spark.table(table), buckets)
    finally:
        spark.sql(f"DROP TABLE {table}")
    return docs.select(rest, *hashes).join(result, ["k1", "k2"]).select("_row.*", *made)


def _removals(spark: SparkSession, texts: DataFrame, buckets: int) -> DataFrame:
    """The result for each distinct text (``k1``, ``k2``, ``raw``, ``copies``), stored."""
    marks = stored(spark, texts.filter(F.octet_length("raw") >= WINDOW).select("k1", "k2", "raw").mapInArrow(_anchors, ANCHORS), "suffix-anchors")
    total = marks.count()
    shared = marks.groupBy("digest").agg(F.count("*").alias("n"), F.min("around").alias("x"), F.max("around").alias("y"))
    shared = stored(spark, shared.filter("n > 1").select("digest", "n", (F.col("x") != F.col("y")).alias("mixed")), "suffix-digests")
    twice = stored(spark, meet(marks, shared.drop("n"), ["digest"], shared.filter(F.col("n") * HEAVY > total)), "suffix-shared")
    mixed = twice.filter("mixed")

    # one of each kind of surroundings; equal ones are counted in each task before they meet
    kinds = mixed.groupBy("digest", "around").agg(F.count("*").alias("copies"), F.min(F.struct("k1", "k2", "at", "low", "high")).alias("one"))
    kinds = stored(spark, kinds.select("digest", "around", "copies", "one.*"), "suffix-kinds")
    lists = kinds.groupBy("k1", "k2").agg(F.collect_list(F.struct("digest", "around", "copies", "at", "low", "high")).alias("list"))
    cut = lambda x: F.struct(
        x["digest"].alias("digest"),
        x["around"].alias("around"),
        x["copies"].alias("copies"),
        F.substring(F.col("raw"), x["low"] + 1, x["at"] - x["low"]).alias("left"),
        F.substring(F.col("raw"), x["at"] + 1, x["high"] + WINDOW - x["at"]).alias("right"),
    )
    sides = texts.join(lists, ["k1", "k2"]).select(F.explode(F.transform("list", cut)).alias("z")).select("z.*")
    crowd = kinds.groupBy("digest").agg(F.count("*").alias("n")).filter(F.col("n") > MOST).select("digest")
    crowd = stored(spark, crowd, "suffix-crowds")
    crowded = crowd.limit(1).count() > 0
    sides = stored(spark, sides, "suffix-sides") if crowded else sides
    calm = sides.join(crowd, "digest", "left_anti") if crowded else sides
    ranges = calm.repartition(buckets, "digest").sortWithinPartitions("digest").mapInArrow(_sorted, RANGES)
    if crowded:
        each = sides.join(crowd, "digest", "left_semi").mapInArrow(_windows, "w1 long, w2 long, digest long, around long, copies long, a int")
        each = stored(spark, each, "suffix-windows")
        many = each.groupBy("w1", "w2").agg(F.sum("copies").alias("n")).filter("n > 1").select("w1", "w2")
        ranges = ranges.union(each.join(many, ["w1", "w2"]).select("digest", "around", "a", F.col("a").alias("b")))
    ranges = stored(spark, ranges, "suffix-ranges")

    whole = twice.filter("not mixed").select("k1", "k2", F.col("low").alias("s"), (F.col("high") + WINDOW).alias("e"))
    part = meet(mixed, ranges, ["digest", "around"], kinds.filter(F.col("copies") * HEAVY > total))
    part = part.select("k1", "k2", (F.col("at") - F.col("b")).alias("s"), (F.col("at") - F.col("a") + WINDOW).alias("e"))
    found = whole.union(part).groupBy("k1", "k2").agg(F.collect_list(F.struct("s", "e")).alias("found"))
    result = texts.join(found, ["k1", "k2"], "left").select("k1", "k2", "raw", "copies", "found").mapInArrow(_removed, RESULT)
    result = stored(spark, result, "suffix-result")
    passage = shared_passages(spark, texts).withColumn("has_repeats", F.lit(True))
    return stored(spark, result.join(passage, ["k1", "k2"], "left").fillna(False, ["has_repeats"]), "suffix-result")
