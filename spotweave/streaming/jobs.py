"""Mapping and counting as files of read pairs arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spotweave.config import RunSpec
from spotweave.operators import mapping
from spotweave.operators.mask_index import MaskIndex


def map_stream(pairs: DataFrame, mask: DataFrame | MaskIndex, spec: RunSpec, path: str, checkpoint: str, once: bool = True, keep: list[str] | None = None) -> StreamingQuery:
    """Map each micro-batch of ``pairs`` by the batch cascade and append to the table at ``path``, all columns or those to ``keep``.

    A batch is written under its number, so a batch that is run again replaces itself.
    """

    def write(batch: DataFrame, number: int) -> None:
        mapping.map_pairs(batch, mask, spec).select(*(keep or ["*"])).write.mode("overwrite").parquet(f"{path}/batch={number}")

    out = pairs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if once else out).start()


def _batches(stream: DataFrame, write, checkpoint: str, once: bool, mode: str = "append") -> StreamingQuery:
    out = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if once else out).start()


def metric_stream(pairs: DataFrame, mask: DataFrame | MaskIndex, spec: RunSpec, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Counters of each micro-batch as a row of the table at ``path``; ``metric_totals`` adds them up."""

    def write(batch: DataFrame, number: int) -> None:
        mapping.run_counters(batch, mapping.map_pairs(batch, mask, spec)).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return _batches(pairs, write, checkpoint, once)


def metric_totals(spark: SparkSession, path: str) -> DataFrame:
    """Counters and percentages of all batches so far, as of one run."""
    rows = spark.read.parquet(path).drop("batch")
    return mapping.with_percentages(rows.agg(*[F.sum(c).alias(c) for c in rows.columns]))


def count_table_stream(mapped: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Running reads of each position of a stream of mapped pairs: each batch writes the positions that changed to ``path``."""
    counts = mapped.filter(F.col("x").isNotNull()).groupBy("x", "y").agg(F.count("*").alias("n"))

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return _batches(counts, write, checkpoint, once, "update")


def latest_counts(spark: SparkSession, path: str) -> DataFrame:
    """Of each position the last count in the table of ``count_table_stream``."""
    return spark.read.parquet(path).groupBy("x", "y").agg(F.max_by("n", "batch").alias("n"))


def count_stream(mapped: DataFrame, name: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Running reads of each position as the memory table ``name``, whole on the driver: for looking at small streams (else ``count_table_stream``)."""
    counts = mapped.filter(F.col("x").isNotNull()).groupBy("x", "y").agg(F.count("*").alias("n"))
    out = counts.writeStream.format("memory").queryName(name).outputMode("complete").option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if once else out).start()
