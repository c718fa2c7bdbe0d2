"""Near-duplicate vectors: tiles compared along principal axes, leading axes first.

Vectors are scaled to length one and turned to the axes of their second moments, most weight first. The
product of two of them over the leading axes differs from their cosine by at most the product of the
lengths of what is left (Cauchy and Schwarz). So a tile of pairs is multiplied over some leading
axes, pairs that cannot reach the threshold any more are dropped, and only the others go on. What
is left at the end is verified in double precision on the vectors as they came.

Equal vectors are one row here, with a count. Rows are dealt into groups; each pair of groups is a
task of its own, and a task returns numbers of links and a spanning forest, not pairs, so that a large group of
near copies makes no more rows than it has members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.llm.common import intermediates, stored
from spotweave.llm.components import components

#: Most vectors of a group, and vectors of each side of a tile.
GROUP, TILE = 32_768, 1024
#: Least number of groups, so that small tables have tasks for several executors too.
LEAST_GROUPS = 12
#: Axes multiplied at once.
STEP = 16
#: Share of a tile's pairs under which the pairs left are followed one by one.
FEW = 0.02
#: What single precision may be off by, generously, in a product of vectors of length one.
SLACK = 1e-4


def usable(vector: str | Column) -> Column:
    """Whether a vector is there, not empty, and has only finite components, one of them other than zero."""
    v = F.col(vector) if isinstance(vector, str) else vector
    x = lambda e: e.cast("double")
    good = ~F.exists(v, lambda e: e.isNull() | F.isnan(x(e)) | (F.abs(x(e)) == float("inf")))
    return F.coalesce(v.isNotNull() & good & F.exists(v, lambda e: x(e) != 0), F.lit(False))


def matrix(column) -> np.ndarray:
    """Rows of an Arrow column of vectors (binary, doubles), all of one length."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, also where squares would overflow or vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _pack(batches: Iterator) -> Iterator:
    """Vectors as bytes (little-endian doubles, zeros without a sign)."""
    import pyarrow as pa

    for batch in batches:
        found = [(np.asarray(v, dtype="<f8") + 0.0).tobytes() for v in batch.column("v").to_pylist()]
        size = [len(v) // 8 for v in found]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(size, pa.int32()), pa.array(found, pa.binary())], names=["id", "size", "vec"])


def _moments(batches: Iterator) -> Iterator:
    """Sums of products of components, for each length of vectors: ``size``, ``at``, ``s``."""
    import pyarrow as pa
    import pyarrow.compute as pc

    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for size in pc.unique(batch.column("size")).to_pylist():
            x = unit(matrix(batch.filter(pc.equal(batch.column("size"), size)).column("vec")))
            sums[size] = sums.get(size, 0) + x.T @ x
    for size, s in sums.items():
        flat = s.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(flat), size, np.int32)), pa.array(np.arange(len(flat))), pa.array(flat)], names=["size", "at", "s"])


def axes(reps: DataFrame) -> dict[int, np.ndarray]:
    """For each length d of vectors a d x d matrix whose columns are the principal axes, most weight first.

    Moments cover all vectors and are added up by Spark; the driver gets d * d numbers.
    """
    found: dict[int, np.ndarray] = {}
    sums = reps.select("size", "vec").mapInArrow(_moments, "size int, at long, s double").groupBy("size", "at").agg(F.sum("s").alias("s"))
    got = sums.toPandas()
    for size, part in got.groupby("size"):
        m = np.zeros(size * size)
        m[part["at"]] = part["s"]
        found[int(size)] = np.ascontiguousarray(np.linalg.eigh(m.reshape(size, size))[1][:, ::-1])
    return found


class Side:
    """Vectors of one group, turned to the axes."""

    def __init__(self, vec: np.ndarray, turn: np.ndarray) -> None:
        self.exact = unit(vec)
        turned = self.exact @ turn
        left = np.cumsum((turned * turned)[:, ::-1], axis=1)[:, ::-1]
        self.rest = np.sqrt(np.concatenate([left, np.zeros((len(vec), 1))], axis=1)).astype(np.float32)
        self.turned = turned.astype(np.float32)


def tile_links(a: Side, b: Side, i: slice, j: slice, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a tile (rows ``i`` of one side, ``j`` of the other) whose cosine is at least ``least``."""
    x, y, xr, yr = a.turned[i], b.turned[j], a.rest[i], b.rest[j]
    size, k = x.shape[1], 0
    part = np.zeros((len(x), len(y)), np.float32)
    while k < size:
        part += x[:, k : k + STEP] @ y[:, k : k + STEP].T
        k = min(k + STEP, size)
        open_ = part + np.multiply.outer(xr[:, k], yr[:, k]) >= least - SLACK
        if np.count_nonzero(open_) <= FEW * part.size:
            break
    row, col = np.nonzero(open_)
    value = part[row, col]
    while k < size and len(row):
        value = value + np.einsum("ij,ij->i", x[row, k : k + STEP], y[col, k : k + STEP])
        k = min(k + STEP, size)
        keep = value + xr[row, k] * yr[col, k] >= least - SLACK
        row, col, value = row[keep], col[keep], value[keep]
    row, col = row + i.start, col + j.start
    sure = [np.einsum("ij,ij->i", a.exact[row[k : k + 65_536]], b.exact[col[k : k + 65_536]]) >= least for k in range(0, len(row), 65_536)]
    sure = np.concatenate(sure) if sure else np.zeros(0, bool)
    return row[sure], col[sure]


def joined(label: np.ndarray, row: np.ndarray, col: np.ndarray) -> None:
    """Give linked places a common smallest label, in place."""
    while True:
        low = np.minimum(label[row], label[col])
        if (label[row] == low).all() and (label[col] == low).all():
            return
        for at in (label[row], label[col], row, col):
            np.minimum.at(label, at, low)
        label[:] = label[label]


def compare(ids: np.ndarray, copies: np.ndarray, first: np.ndarray, vec: np.ndarray, turn: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of a pair of groups (``first`` marks the rows of the first; all of them: one group with itself).

    For each row how many vectors of the other group it is linked with, and its label: the place of a row it
    is joined with.
    """
    order = np.argsort(~first, kind="stable")
    cut = int(first.sum())
    alone = cut == len(ids)
    a = Side(vec[order[:cut]], turn)
    b = a if alone else Side(vec[order[cut:]], turn)
    base = 0 if alone else cut
    many, label, weight = np.zeros(len(ids), np.int64), np.arange(len(ids)), copies[order]
    for at in range(0, len(a.turned), TILE):
        for to in range(at if alone else 0, len(b.turned), TILE):
            row, col = tile_links(a, b, slice(at, min(at + TILE, len(a.turned))), slice(to, min(to + TILE, len(b.turned))), least)
            if alone:
                row, col = row[row < col], col[row < col]
            col = col + base
            np.add.at(many, row, weight[col])
            np.add.at(many, col, weight[row])
            if len(row):
                joined(label, row, col)
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return many[back], order[label][back]


def _compare(turns: dict[int, np.ndarray], least: float):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def tasks() -> Iterator[tuple[int, list]]:
            name, held = None, []
            for batch in batches:
                keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("size", "low", "high")], axis=1)
                ends = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
                for s, e in zip(ends[:-1], ends[1:], strict=True):
                    if e > s:
                        key = tuple(keys[s].tolist())
                        if key != name and held:
                            yield name[0], held
                            held = []
                        name = key
                        held.append(batch.slice(s, e - s))
            if held:
                yield name[0], held

        for size, held in tasks():
            part = pa.Table.from_batches(held)
            ids, copies, first = (part.column(c).to_numpy() for c in ("id", "copies", "first"))
            if not first.any() or len(ids) < 2:
                continue
            many, label = compare(ids, copies, first.astype(bool), matrix(part.column("vec").combine_chunks()), turns[size], least)
            use = many > 0
            yield pa.RecordBatch.from_arrays([pa.array(ids[use]), pa.array(many[use]), pa.array(ids[label][use])], names=["id", "n", "other"])

    return run


def near_vectors(spark: SparkSession, vectors: DataFrame, least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row for each row of ``vectors``: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Two vectors are linked if their cosine, in double precision, is ``least`` (above zero) or more. ``n_links`` counts the other
    rows linked directly, copies included; ``component_id`` is the smallest id reachable. A vector that is null, empty,
    all zeros, or has a null or non-finite component links with nothing. Vectors of different lengths
    have no cosine and aren't linked. Rows with equal ids are rows of their own and count each other only if their
    vectors are near; they are one node of the links. A null id keeps its row, links with nothing and has a null
    component; ``kept`` is then true. No rows give no rows.
    """
    if not least > 0:
        raise ValueError("the least cosine must be above zero")
    with intermediates(spark, keep=1):
        return stored(spark, _near_vectors(spark, vectors, least, id_col, vector_col), "vectors-result")


def _near_vectors(spark: SparkSession, vectors: DataFrame, least: float, id_col: str, vector_col: str) -> DataFrame:
    every = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    real = every.filter(F.col("id").isNotNull() & usable("v")).mapInArrow(_pack, "id long, size int, vec binary")
    real = stored(spark, real, "vectors-rows")
    # equal vectors as one, found by hash and told apart by their bytes
    reps = real.groupBy("size", "vec").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    reps = stored(spark, reps.withColumn("id", F.monotonically_increasing_id()), "vectors-distinct")
    groups = max(LEAST_GROUPS, -(-reps.count() // GROUP))
    dealt = reps.select("id", "copies", "size", "vec", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("g"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    dealt = dealt.select("size", F.least("g", "other").alias("low"), F.greatest("g", "other").alias("high"), "id", "copies", (F.col("g") <= F.col("other")).alias("first"), "vec")
    key = ["size", "low", "high"]
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), groups * (groups + 1) // 2)
    met = dealt.repartition(n, *key).sortWithinPartitions(*key).mapInArrow(_compare(axes(reps), least), "id long, n long, other long")
    met = stored(spark, met, "vectors-links")

    counts = met.groupBy("id").agg(F.sum("n").alias("n"))
    # classes of distinct vectors; an id that has several vectors joins them
    links = met.filter("id <> other").select(F.col("id").alias("a"), F.col("other").alias("b"))
    own = real.join(reps.select("size", "vec", F.col("id").alias("node")), ["size", "vec"]).select("id", "node")
    own = stored(spark, own, "vectors-nodes")
    twins = own.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a <> z").select("id", "a")
    tied = own.join(twins, "id").select("a", F.col("node").alias("b")).filter("a <> b")
    label = components(spark, links.union(tied))
    placed = reps.join(label, "id", "left").withColumn("component", F.coalesce("component", "id"))
    least_id = placed.groupBy("component").agg(F.min("rep").alias("component_id"))
    nodes = placed.join(least_id, "component").join(counts, "id", "left")
    nodes = nodes.select(F.col("id").alias("node"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    found = own.join(nodes, "node").select(F.col("id").alias("vec_id"), "n_links", "component_id")
    none = every.filter(~(F.col("id").isNotNull() & usable("v"))).select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"))
    # an unusable vector whose id also has a usable one belongs to that id's component
    ids = found.groupBy("vec_id").agg(F.min("component_id").alias("component_id"))
    none = none.join(ids, "vec_id", "left").select("vec_id", "n_links", F.coalesce("component_id", "vec_id").alias("component_id"))
    out = found.unionByName(none)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
