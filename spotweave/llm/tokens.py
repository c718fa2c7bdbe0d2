"""Token counts through a digest cache.

The cache is a table of (content digest, tokenizer digest, tokens). Documents are joined to it by
the digest of their content; only distinct contents that it lacks are encoded and appended.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.llm.common import free_prefix, text_or_empty
from spotweave.llm.tokenizing import encoder

SCHEMA = "digest binary, tokenizer string, n_tokens long"


def tokenizer_digest(path: str) -> str:
    """SHA-256 of a tokenizer's file: its version."""
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def cached(spark: SparkSession, cache_path: str, version: str) -> DataFrame:
    """Counts of one tokenizer version in the cache; one row per digest, none if there is no cache yet."""
    try:
        found = spark.read.schema(SCHEMA).parquet(cache_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], SCHEMA)
    return found.filter(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def _counter(path: str, version: str, spaces: bool):
    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        known = encoder(path, spaces)
        for batch in batches:
            sizes = [sum(map(len, ids)) // 4 for ids in known.batch(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_pydict(
                {"digest": batch.column("digest"), "tokenizer": [version] * len(sizes), "n_tokens": pa.array(sizes, pa.int64())}
            )
        known.rest()

    return count


def count_tokens(
    spark: SparkSession,
    docs: DataFrame,
    tokenizer_path: str,
    cache_path: str,
    spaces: bool = True,
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8) and ``n_tokens``, through the cache at ``cache_path``.

    ``spaces`` is false for a tokenizer that drops whitespace. Normalised content is the text
    with null as the empty string, as nothing more keeps the counts of a byte-level tokenizer.
    Two writers that append the same content do no harm: the cache is read by distinct digest.
    Repeated rows are each counted; columns of these names are replaced; an empty table stays empty.
    """
    version = tokenizer_digest(tokenizer_path)
    text = text_or_empty(text_col)
    docs = docs.drop("n_bytes", "n_tokens")
    name = f"{free_prefix(docs, '_tokens')}digest"
    keyed = docs.withColumn(name, F.unhex(F.sha2(text, 256)))
    known = cached(spark, cache_path, version)
    content = keyed.select(F.col(name).alias("digest"), text.alias("text")).join(known, "digest", "left_anti")
    # a content is one row for each task before it is shuffled
    misses = content.groupBy("digest").agg(F.first("text").alias("text"))
    encoded = misses.mapInArrow(_counter(tokenizer_path, version, spaces), SCHEMA)
    encoded.write.mode("append").parquet(cache_path)
    counts = cached(spark, cache_path, version).withColumnRenamed("digest", name)
    return (
        keyed.withColumn("n_bytes", F.octet_length(text).cast("long"))
        .join(counts, name, "left")
        .drop(name)
    )
