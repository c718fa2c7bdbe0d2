"""MinHash near-duplicates by a multi-index Hamming join.

A signature has 32 symbols, each 16 bits of a minimum hash of the document's shingles. It is
split into 8 chunks of 4 symbols. Two signatures that differ in at most 15 symbols have, by the
pigeonhole principle, a chunk with at most one difference; so each chunk is indexed four times,
each time without one of its symbols (the errors allowed in a chunk, enumerated), and every pair
within the distance shares a key. At the similarity 0.85 a pair differs in more than 15 of 32
symbols with probability 3e-6, less above it.

Equal shingle sets are one representative. In each key's group every member is first compared
with one leader, the member with most company over all its keys (near copies share more with
their original than with each other); full sets confirm the links. Then pairs in a group that
are still in different components are compared: those around the same leader in blocks, first
by signatures, then, for members that have a signature of another component within the distance in a
block, by full sets; only links that join components come out. The others meet pair by pair. So no link
between components is lost, and no group of copies is expanded into all its pairs. A set of a very
long text is held once by a task and compared as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.llm.common import intermediates, stored
from spotweave.llm.components import components
from spotweave.llm.shingles import mix, shingle_sets

SYMBOLS, CHUNKS, DISTANCE = 32, 8, 15
_SEEDS = mix(np.arange(1, 2 * SYMBOLS + 1, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))


def signature(hashes: np.ndarray) -> np.ndarray:
    """Symbols (16 bits) of a set that isn't empty."""
    low = np.full(SYMBOLS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 8192):
        part = hashes[at : at + 8192]
        spread = (part[None, :] ^ _SEEDS[:SYMBOLS, None]) * (_SEEDS[SYMBOLS:, None] | np.uint64(1))
        np.minimum(low, (spread ^ (spread >> np.uint64(29))).min(axis=1), out=low)
    return (mix(low) >> np.uint64(48)).astype("<u2")


def _sketch(width: int):
    def sketch(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            n, d1, d2, sig = [], [], [], []
            with np.errstate(over="ignore"):
                for s in shingle_sets(batch.column("text").to_pylist(), width):
                    n.append(len(s))
                    d1.append(int(mix(s ^ _SEEDS[0]).sum(dtype=np.uint64).view(np.int64)))
                    d2.append(int(mix(s ^ _SEEDS[1]).sum(dtype=np.uint64).view(np.int64)))
                    sig.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(sig, pa.binary())],
                names=["id", "n_shingles", "d1", "d2", "sig"],
            )

    return sketch


def chunk_keys(symbols: np.ndarray) -> np.ndarray:
    """Keys of signatures (rows of 32 symbols): for each symbol the others of its chunk, and its place."""
    width = SYMBOLS // CHUNKS
    parts = symbols.reshape(len(symbols), CHUNKS, width).astype(np.int64)
    out = np.zeros((len(symbols), CHUNKS, width), dtype=np.int64)
    for gone in range(width):
        for k in range(width):
            if k != gone:
                out[:, :, gone] = out[:, :, gone] << 16 | parts[:, :, k]
    return out.reshape(len(symbols), SYMBOLS) << 5 | np.arange(SYMBOLS)


def _index(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        for at in range(0, batch.num_rows, 20_000):
            part = batch.slice(at, 20_000)
            symbols = np.frombuffer(b"".join(part.column("sig").to_pylist()), dtype="<u2").reshape(-1, SYMBOLS)
            keys = chunk_keys(symbols)
            row = np.repeat(np.arange(part.num_rows), SYMBOLS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), *(part.column(c).take(pa.array(row)) for c in ("id", "n_shingles"))],
                names=["key", "id", "n"],
            )


def _near(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype="<u2").reshape(-1, SYMBOLS) for c in ("x", "y"))
        mask = pa.array((x != y).sum(axis=1) <= DISTANCE)
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"])


def within_distance(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs`` whose signatures differ in at most ``DISTANCE`` symbols."""
    signed = pairs.join(sets.select(F.col("set_id").alias("a"), F.col("sig").alias("x")), "a")
    signed = signed.join(sets.select(F.col("set_id").alias("b"), F.col("sig").alias("y")), "b")
    return signed.select("a", "b", "x", "y").mapInArrow(_near, "a long, b long").distinct()


def _sets(width: int):
    def sets(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = [s.tobytes() for s in shingle_sets(batch.column("text").to_pylist(), width)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.binary())], names=["id", "shingles"])

    return sets


def _alike(percent: int):
    def alike(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist(), strict=True):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if len(a) > len(b):
                    a, b = b, a
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                both = int((b[at] == a).sum())
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"])

    return alike


def confirm(spark: SparkSession, pairs: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """Those of ``pairs`` (``a``, ``b``) whose full shingle sets are similar enough."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    full = texts.join(ids, "id").mapInArrow(_sets(width), "id long, shingles binary")
    full = stored(spark, full, "neardup-sets")
    left = pairs.join(full.withColumnsRenamed({"id": "a", "shingles": "left"}), "a")
    both = left.join(full.withColumnsRenamed({"id": "b", "shingles": "right"}), "b")
    return stored(spark, both.select("a", "b", "left", "right").mapInArrow(_alike(percent), "a long, b long"), "neardup-links")


#: Sets compared with each other at once.
BLOCK = 400
#: Blocks whose signatures are compared at once with those of as many others.
SIDE = 10
#: Members of a key that are met in one task.
CROWD = 1000


def block_similar(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Matrix of whether sets are similar enough, by products of their incidence on shared hashes."""
    sizes = [np.array([len(s) for s in part], dtype=np.int64) for part in (left, right)]
    flat = np.concatenate([*left, *right])
    kinds, back, counts = np.unique(flat, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(left) + len(right)), np.concatenate(sizes))
    often = counts > 1
    column = (np.cumsum(often) - 1)[back]
    use = often[back]
    row, column, width = row[use], column[use], int(often.sum())
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(left), len(right)))
    for at in range(0, width, 8192):
        a, b = np.searchsorted(column, [at, at + 8192])
        part = np.zeros((len(left) + len(right), min(8192, width - at)), dtype=np.float32)
        part[row[a:b], column[a:b] - at] = 1
        both += part[: len(left)] @ part[len(left) :].T
    return 100 * both >= percent * (sizes[0][:, None] + sizes[1][None, :] - both)


def _spanning(rows: list[tuple], percent: int) -> Iterator[tuple[int, int]]:
    """Links of a pair of blocks that join components; rows of (id, component, in the first block, in the second, set)."""
    left, right = [r for r in rows if r[2]], [r for r in rows if r[3]]
    if not left or not right or len({r[1] for r in rows}) < 2:
        return
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    like = block_similar(*([np.frombuffer(r[4], np.uint64) for r in part] for part in (left, right)), percent)
    for i, j in zip(*np.nonzero(like), strict=True):
        x, y = find(left[i][1]), find(right[j][1])
        if x != y:
            root[x] = y
            yield left[i][0], right[j][0]


def _grouped(batches: Iterator, names: list[str], columns: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of ``columns`` of each group of ``names``, whose rows follow each other."""
    held, name = [], None
    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in (*names, *columns)]
        for row in zip(*cols, strict=True):
            if row[: len(names)] != name:
                if held:
                    yield name, held
                held, name = [], row[: len(names)]
            held.append(row[len(names) :])
    if held:
        yield name, held


def _blocks(percent: int):
    def blocks(batches: Iterator) -> Iterator:
        import pyarrow as pa

        found: list[tuple[int, int]] = []
        for (_, low, high), rows in _grouped(batches, ["ref", "low", "high"], ["id", "component", "block", "shingles"]):
            found += _spanning([(i, c, b == low, b == high, s) for i, c, b, s in rows], percent)
            if len(found) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b"])
                found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b"])

    return blocks


def _candidates(percent: int):
    """From signatures of a pair of coarse blocks: members with a partner of another component in a pair of blocks of sets."""

    def hits(rows: list[tuple], low: int, high: int) -> Iterator[tuple[int, int, int]]:
        sides = []
        for name in (low, high):
            part = sorted((r for r in rows if r[2] == name), key=lambda r: r[3])
            sides.append([np.array([r[k] for r in part], np.int64) for k in (0, 1, 3, 4)] + [np.frombuffer(b"".join(r[5] for r in part), "<u2").reshape(-1, SYMBOLS)])
        (ids, parts, blocks, sizes, signs), (ids2, parts2, blocks2, sizes2, signs2) = sides
        if not len(ids) or not len(ids2):
            return
        names2, starts2 = np.unique(blocks2, return_index=True)
        for block in np.unique(blocks):
            use = np.flatnonzero(blocks == block)
            near = np.zeros((len(use), len(ids2)), np.uint8)
            for k in range(SYMBOLS):
                near += signs[use, k][:, None] != signs2[None, :, k]
            n, m = sizes[use][:, None], sizes2[None, :]
            met = (near <= DISTANCE) & (parts[use][:, None] != parts2[None, :]) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))
            mine, theirs = np.logical_or.reduceat(met, starts2, axis=1), met.any(axis=0)
            for k, other in enumerate(names2):
                if mine[:, k].any() and (low != high or block <= other):
                    found = np.union1d(ids[use[mine[:, k]]], ids2[(blocks2 == other) & theirs])
                    yield from ((int(min(block, other)), int(max(block, other)), int(i)) for i in found)

    def candidates(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for (ref, low, high), rows in _grouped(batches, ["ref", "low", "high"], ["id", "component", "coarse", "block", "n", "sig"]):
            out = list(hits(rows, low, high))
            if out:
                arrays = [pa.array([ref] * len(out), pa.int64()), *(pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.int64()), strict=True))]
                yield pa.RecordBatch.from_arrays(arrays, names=["ref", "low", "high", "id"])

    return candidates


def _block_links(spark: SparkSession, members: DataFrame, sets: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """Links between components among the members (``id``, ``ref``, ``component``) of one ``ref``.

    The members of a ref are cut into coarse blocks of about SIDE blocks of BLOCK, those of the ref's
    largest component (which are linked already) apart from the others; every pair of coarse blocks with
    others in it is a group of its own, so no task gets a whole ref, and the members of the largest
    component are never compared with each other. There signatures (64 bytes each) are compared; a
    full set is made and moved only for members that have a partner within the distance, in
    another component and of a fitting size, and only to the pairs of blocks where it is. Only links that
    join components leave a task.
    """
    sizes = members.groupBy("ref", "component").agg(F.count("*").alias("n"))
    refs = sizes.groupBy("ref").agg(F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("top")).filter("top.n < n")
    parts = lambda n: F.ceil(n / F.lit(BLOCK * SIDE)).cast("int")
    refs = refs.select("ref", F.col("top.component").alias("main"), parts(F.col("n") - F.col("top.n")).alias("few"), parts(F.col("top.n")).alias("many"))
    main = F.col("component") == F.col("main")
    hashed = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    cut = members.join(refs, "ref").join(sets.select(F.col("set_id").alias("id"), F.col("n_shingles").alias("n"), "sig"), "id")
    cut = cut.withColumn("coarse", F.when(main, F.col("few") + hashed(F.col("many"))).otherwise(hashed(F.col("few"))))
    cut = cut.withColumn("block", F.col("coarse") * SIDE + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(SIDE)).cast("int"))
    last = F.when(main, F.col("few")).otherwise(F.col("few") + F.col("many")) - 1
    cut = stored(spark, cut.withColumn("last", last).drop("main", "few", "many"), "neardup-blocks")
    spread = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
    spread = spread.withColumns({"low": F.least("coarse", "other"), "high": F.greatest("coarse", "other")})
    spread = spread.select("ref", "low", "high", "id", "component", "coarse", "block", "n", "sig")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    group = ["ref", "low", "high"]
    near = spread.repartition(n, *group).sortWithinPartitions(*group).mapInArrow(_candidates(percent), "ref long, low int, high int, id long")
    near = stored(spark, near, "neardup-candidates")
    full = texts.join(near.select("id").distinct(), "id").mapInArrow(_sets(width), "id long, shingles binary")
    met = near.join(cut.select("id", "component", "block"), "id").join(full, "id")
    met = met.select(*group, "id", "component", "block", "shingles")
    return stored(spark, met.repartition(n, *group).sortWithinPartitions(*group).mapInArrow(_blocks(percent), "a long, b long"), "neardup-links")


def near_duplicates(
    spark: SparkSession,
    docs: DataFrame,
    percent: int = 85,
    width: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    Documents are linked if 100 * intersection >= ``percent`` * union of their sets of
    ``width``-word shingles; a component's id is its smallest ``doc_id``. A null or
    wordless text has no shingles, links to nothing and is its own component. Rows with equal
    ids and texts are equal rows of the result; an id with several texts joins their components.
    A null id keeps its row, links nothing and has a null component. ``kept`` says whether the
    component's id is the row's own (true for a null id).
    """
    with intermediates(spark, keep=1):
        return stored(spark, _near_duplicates(spark, docs, percent, width, id_col, text_col), "neardup-result")


def _near_duplicates(spark: SparkSession, docs: DataFrame, percent: int, width: int, id_col: str, text_col: str) -> DataFrame:
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = stored(spark, texts.mapInArrow(_sketch(width), "id long, n_shingles long, d1 long, d2 long, sig binary"), "neardup-rows")
    real = rows.filter("n_shingles > 0 and id is not null")  # empty sets never reach a comparison
    sets = real.groupBy("d1", "d2", "n_shingles").agg(F.min("id").alias("set_id"), F.first("sig").alias("sig"))
    sets = stored(spark, sets, "neardup-sets-distinct")

    known_texts = texts.filter(F.col("id").isNotNull() & F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    index = sets.select(F.col("set_id").alias("id"), "n_shingles", "sig").mapInArrow(_index, "key long, id long, n long")
    index = stored(spark, index, "neardup-index")
    shared = index.groupBy("key").agg(F.count("*").alias("company")).filter("company > 1")
    grouped = stored(spark, index.join(shared, "key"), "neardup-grouped")
    company = grouped.groupBy("id").agg(F.sum("company").alias("score"))
    leaders = grouped.join(company, "id").groupBy("key").agg(F.max(F.struct("score", "id", "n")).alias("lead"))
    close = lambda x, y: 100 * F.least(x, y) >= percent * F.greatest(x, y)
    first = grouped.join(leaders, "key").filter((F.col("id") != F.col("lead.id")) & close(F.col("n"), F.col("lead.n")))
    first = first.select(F.greatest("id", "lead.id").alias("a"), F.least("id", "lead.id").alias("b")).distinct()
    first = stored(spark, within_distance(first, sets), "neardup-pairs")

    links = confirm(spark, first, known_texts, percent, width)
    label = components(spark, links)
    known = grouped.join(label, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = known.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("key")
    open_ = known.join(mixed, "key", "left_semi").join(leaders.withColumn("lead", F.col("lead").dropFields("n")), "key")
    open_ = stored(spark, open_.select("key", "id", "n", "component", "lead"), "neardup-open")
    # around one leader, in blocks; what meets in a key but has different leaders, pair by pair
    members = open_.groupBy("id").agg(F.max("lead")["id"].alias("ref"), F.first("component").alias("component"))
    members = stored(spark, members, "neardup-members")
    blocks = _block_links(spark, members, sets, known_texts, percent, width)
    placed = open_.join(members.select("id", "ref"), "id")
    # a key of many members is dealt to several tasks: one side in parts, the other once for each part
    crowds = placed.groupBy("key").agg(F.count("*").alias("k"), F.min("ref").alias("x"), F.max("ref").alias("y")).filter("x <> y")
    crowds = crowds.select("key", F.ceil(F.col("k") / F.lit(CROWD)).cast("int").alias("parts"))
    placed = stored(spark, placed.join(crowds, "key"), "neardup-placed")
    p = placed.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).alias("p")
    q = placed.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).alias("q")
    meet = (F.col("p.key") == F.col("q.key")) & (F.col("p.part") == F.col("q.part"))
    cross = meet & (F.col("p.component") < F.col("q.component")) & close(F.col("p.n"), F.col("q.n"))
    second = p.join(q, cross & (F.col("p.ref") != F.col("q.ref"))).select(F.greatest("p.id", "q.id").alias("a"), F.least("p.id", "q.id").alias("b")).distinct()
    second = stored(spark, within_distance(second.join(first, ["a", "b"], "left_anti"), sets), "neardup-pairs")
    more = confirm(spark, second, known_texts, percent, width)
    links = links.union(blocks).union(more)
    label = components(spark, links)
    # ids with several texts join their sets
    own = real.select("id", "d1", "d2", "n_shingles").distinct()
    twins = own.groupBy("id").agg(F.count("*").alias("k")).filter("k > 1")
    if twins.limit(1).count():
        tied = own.join(twins, "id").join(sets, ["d1", "d2", "n_shingles"]).select(F.col("id").alias("a"), F.col("set_id").alias("b"))
        label = components(spark, links.union(tied))
    classes = sets.join(label, sets.set_id == label.id, "left").select("d1", "d2", "n_shingles", F.coalesce("component", "set_id").alias("component_id"))
    out = rows.drop("sig").join(classes, ["d1", "d2", "n_shingles"], "left")
    out = out.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        F.when(F.col("id").isNull(), None).otherwise(F.coalesce("component_id", "id")).alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
