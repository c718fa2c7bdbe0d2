"""Mixing sources to target weights by Poisson replication.

Each group (a source) has a mean repetition rate: its target share of the output over its share
of the input. Every document draws its number of copies from the Poisson law with that mean by
inverting the distribution at a uniform number hashed from the seed and its key, so the draw is
independent of partitioning and of all other documents. A mean above ``LARGE`` is split into equal
parts, each with a draw of its own: a sum of Poisson draws is a Poisson draw. Copies are exploded and shuffled
globally by a hashed key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.llm.common import free_prefix, unit_hash

#: Where the null group stands in weights and rates.
NULL_GROUP = "\x00null"
#: Largest mean of a single draw (exp(-mean) is 0 beyond 745), and of the parts of a larger one.
LARGE, PART = 500, 256


def rates(
    docs: DataFrame,
    by: str = "source",
    weights: dict[str, float] | None = None,
    temperature: float = 0.5,
    size: float = 1.0,
) -> DataFrame:
    """One row per group: ``group``, ``n`` documents, ``rate``: mean copies of a document.

    ``weights`` are target shares of the output (groups not named get none); without them the
    target share is proportional to ``n ** temperature``. ``size`` is the wanted number of
    output documents over that of input documents.
    """
    counts = docs.groupBy(F.coalesce(F.col(by).cast("string"), F.lit(NULL_GROUP)).alias("group")).agg(F.count("*").alias("n"))
    if weights is None:
        want = F.pow(F.col("n").cast("double"), F.lit(float(temperature)))
    else:
        pairs = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))]) if weights else None
        want = F.coalesce(F.try_element_at(pairs, F.col("group")), F.lit(0.0)) if weights else F.lit(0.0)
    wanted = counts.withColumn("want", want)
    total = wanted.agg(F.sum("n").alias("all_n"), F.sum("want").alias("all_want"))
    return wanted.join(F.broadcast(total)).select(
        "group",
        "n",
        F.when(F.col("all_want") > 0, F.lit(float(size)) * F.col("all_n") * F.col("want") / F.col("all_want") / F.col("n"))
        .otherwise(0.0)
        .alias("rate"),
    )


def poisson_cdf(rate: Column) -> Column:
    """Array of P(X <= k), k = 0, 1, ..., for a Poisson law with mean ``rate`` of at most ``LARGE``.

    It ends where the tail is below the 52 bits of a draw.
    """
    steps = (rate + F.lit(9.0) * F.sqrt(rate + 1.0) + 24).cast("int")
    zero = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("c"))
    return F.aggregate(
        F.sequence(F.lit(1), steps),
        F.array(zero),
        lambda acc, k: F.concat(
            acc,
            F.array(
                F.struct(
                    (F.element_at(acc, -1)["p"] * rate / k).alias("p"),
                    (F.element_at(acc, -1)["c"] + F.element_at(acc, -1)["p"] * rate / k).alias("c"),
                )
            ),
        ),
        lambda acc: F.transform(acc, lambda x: x["c"]),
    )


def mix(
    spark: SparkSession,
    docs: DataFrame,
    by: str = "source",
    key: list[str] = ("doc_id",),
    weights: dict[str, float] | None = None,
    temperature: float = 0.5,
    size: float = 1.0,
    seed: str = "mix-1",
    max_groups: int = 100_000,
) -> DataFrame:
    """Documents repeated to target weights: the columns of ``docs`` and ``mix_copy`` (from 0), ``mix_copies``, ``mix_key``.

    Rows with equal ``key`` draw the same number. A null group is a group of its own and a null
    key a key of its own. ``mix_key`` (md5 of seed, key and copy) is a uniform random order:
    rows are dealt to partitions by it and sorted by it within. An empty table stays empty.
    The table of rates is broadcast only if it has at most ``max_groups`` rows.
    """
    at = free_prefix(docs, "_mix")
    table = rates(docs, by, weights, temperature, size)
    parts = F.when(F.col("rate") <= LARGE, 1).otherwise(F.ceil(F.col("rate") / PART)).cast("int")
    table = table.withColumns({f"{at}_group": F.col("group"), f"{at}_parts": parts})
    table = table.withColumn(f"{at}_cdf", poisson_cdf(F.col("rate") / F.col(f"{at}_parts"))).select(f"{at}_group", f"{at}_parts", f"{at}_cdf")
    few = docs.agg(F.approx_count_distinct(by)).first()[0] <= max_groups
    named = docs.withColumn(f"{at}_group", F.coalesce(F.col(by).cast("string"), F.lit(NULL_GROUP)))
    keys = [F.coalesce(F.col(k).cast("string"), F.lit(NULL_GROUP)) for k in key]
    drawn = named.join(F.broadcast(table) if few else table, f"{at}_group").withColumn(f"{at}_u", unit_hash(seed, *keys))
    further = F.transform(F.sequence(F.lit(2), F.col(f"{at}_parts")), lambda j: unit_hash(f"{seed}/part", *keys, j.cast("string")))
    drawn = drawn.withColumn(f"{at}_more", F.when(F.col(f"{at}_parts") > 1, further))
    more = F.aggregate(F.col(f"{at}_more"), F.lit(0).cast("long"), lambda n, u: n + F.size(F.filter(f"{at}_cdf", lambda c: c <= u)))
    copied = (
        drawn.withColumn("mix_copies", F.size(F.filter(f"{at}_cdf", lambda c: c <= F.col(f"{at}_u"))).cast("long") + F.coalesce(more, F.lit(0).cast("long")))
        .drop(f"{at}_cdf", f"{at}_group", f"{at}_u", f"{at}_parts", f"{at}_more")
        .filter(F.col("mix_copies") > 0)
        .withColumn("mix_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("mix_copies") - 1)))
        .withColumn("mix_key", F.md5(F.concat_ws("\x1f", F.lit(seed), *keys, F.col("mix_copy").cast("string"))))
    )
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return copied.repartition(n, "mix_key").sortWithinPartitions("mix_key")
