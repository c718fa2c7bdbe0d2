"""Sharding by a hypergeometric communication matrix.

A uniform shuffle into shards of exact sizes: every source partition is told how many of its
rows go to each shard. The counts are one draw of the multivariate hypergeometric law, so the
outcome is distributed as that of a global permutation cut into shards; then rows are permuted
within their partition (who goes where), exchanged, and permuted again within the shard.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spotweave.llm.common import free_prefix, intermediates, stored


def even_sizes(total: int, shards: int) -> list[int]:
    """Shard sizes that sum to ``total`` and differ by one at most; the larger come first."""
    base, more = divmod(total, shards)
    return [base + (i < more) for i in range(shards)]


def communication_matrix(counts: list[int], sizes: list[int], seed: int) -> np.ndarray:
    """Rows from partition i to shard j: row sums ``counts``, column sums ``sizes``.

    Each row is a multivariate hypergeometric draw from what the shards still have room for.
    """
    if sum(counts) != sum(sizes):
        raise ValueError("shard sizes must sum to the number of rows")
    rng = np.random.Generator(np.random.PCG64(seed))
    left = np.array(sizes, dtype=np.int64)
    out = np.zeros((len(counts), len(sizes)), dtype=np.int64)
    for i, n in enumerate(counts):
        pool, want = int(left.sum()), int(n)
        for j, room in enumerate(left.tolist()):
            rest = pool - room
            take = _hypergeometric(rng, room, rest, want)
            out[i, j] = take
            want -= take
            pool = rest
        left -= out[i]
    return out


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` from ``good`` and ``bad`` are good."""
    if draws == 0 or good == 0:
        return 0
    if bad == 0:
        return draws
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, draws))
    return _wide_hypergeometric(rng, good, bad, draws)


def _wide_hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """The same beyond the generator's range, by inverting the distribution around its mode.

    Chances follow from the mode's by ratios of neighbours, in both directions as far as 8.5
    standard deviations, beyond which less than one draw in 2**53 lies; the work grows with the
    standard deviation, not with the number of rows.
    """
    every = good + bad
    mode = (draws + 1) * (good + 1) // (every + 2)
    spread = (draws * (good / every) * (bad / every) * ((every - draws) / max(every - 1, 1))) ** 0.5
    reach = int(8.5 * spread) + 30
    low, high = max(0, draws - bad, mode - reach), min(draws, good, mode + reach)
    k = np.arange(low, high, dtype=np.float64)
    # log of p(k + 1) / p(k); the factors are whole numbers, exact in a double below 2**53
    steps = np.log((good - k) / (k + 1)) + np.log((draws - k) / (bad - draws + k + 1))
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    total = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(total, rng.random() * total[-1], side="right"))


def shard_rows(
    spark: SparkSession,
    df: DataFrame,
    key: list[Column],
    shards: int,
    seed: int = 17,
    rows_a_task: int = 500_000,
) -> DataFrame:
    """Add ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard) to ``df``.

    ``key`` are columns that tell rows apart; equal rows are interchangeable. The number of
    source partitions of the matrix (64 to 8192) and of the pieces in which a shard is permuted
    (16 to 4096, so that no task holds a whole shard) follow from ``rows_a_task``; the matrix
    has at most ``8192 * shards`` cells, whatever the number of rows (at 5e10 rows a task then
    permutes 6 million, some 300 MB, which sorting spills). Deterministic in ``seed``.

    An empty table gives an empty table. Nulls in ``key`` are a value like others. Columns
    named ``shard`` or ``slot`` are replaced; other columns pass through.
    """
    df = df.drop("shard", "slot")
    at = free_prefix(df, "_shard")
    total = df.count()
    partitions = min(8192, max(64, -(-total // rows_a_task)))
    chunks = min(4096, max(16, -(-total // (shards * rows_a_task))))
    marked = df.withColumns(
        {
            f"{at}_mix1": F.xxhash64(F.lit(seed), *key),
            f"{at}_mix2": F.xxhash64(F.lit(seed + 1), *key),
        }
    ).withColumn(f"{at}_part", F.pmod(F.xxhash64(F.lit(seed + 2), *key), F.lit(partitions)).cast("int"))
    with intermediates(spark, keep=1):
        marked = stored(spark, marked, "shard-rows")
        counted = {r[f"{at}_part"]: r["n"] for r in marked.groupBy(f"{at}_part").agg(F.count("*").alias("n")).collect()}
        counts = [counted.get(i, 0) for i in range(partitions)]
        matrix = communication_matrix(counts, even_sizes(sum(counts), shards), seed)
        ends = [(i, [int(x) for x in row]) for i, row in enumerate(matrix.cumsum(axis=1))]
        plan = spark.createDataFrame(ends, f"{at}_part int, {at}_ends array<bigint>")  # partitions x shards cells

        local = Window.partitionBy(f"{at}_part").orderBy(f"{at}_mix1", *key)
        placed = (
            marked.withColumn(f"{at}_rank", F.row_number().over(local) - 1)
            .join(F.broadcast(plan), f"{at}_part")
            .withColumn("shard", F.size(F.filter(f"{at}_ends", lambda e: e <= F.col(f"{at}_rank"))).cast("int"))
            .withColumn(f"{at}_chunk", F.pmod(F.col(f"{at}_mix2"), F.lit(chunks)).cast("int"))
            .drop(f"{at}_ends", f"{at}_rank", f"{at}_part")
        )
        placed = stored(spark, placed, "shard-placed")
    before = Window.partitionBy("shard").orderBy(f"{at}_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("shard", f"{at}_chunk")
        .agg(F.count("*").alias(f"{at}_n"))
        .select("shard", f"{at}_chunk", F.coalesce(F.sum(f"{at}_n").over(before), F.lit(0)).alias(f"{at}_start"))
    )  # shards x chunks rows
    inner = Window.partitionBy("shard", f"{at}_chunk").orderBy(f"{at}_mix2", *key)
    return (
        placed.withColumn(f"{at}_rank", F.row_number().over(inner) - 1)
        .join(F.broadcast(starts), ["shard", f"{at}_chunk"])
        .withColumn("slot", (F.col(f"{at}_start") + F.col(f"{at}_rank")).cast("long"))
        .drop(f"{at}_start", f"{at}_rank", f"{at}_chunk", f"{at}_mix1", f"{at}_mix2")
    )
