"""A training-data pipeline over ``documents``: each stage calls one operator of ``spotweave.llm``.

Quality rules drop documents; near-duplicates leave one document of a group; secrets are replaced
by a mark in the text; sources are mixed to target weights, which repeats or leaves out
documents; what remains is packed into token sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.llm import mixing, neardup, packing, quality, secrets
from spotweave.llm.common import documents, free_prefix, intermediates, stored, text_or_empty
from spotweave.llm.queries import tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; the target is the documents labelled good and not toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    trusted = labels.filter("quality = 1 and toxic = 0").select("doc_id")
    return quality.quality(spark, docs, trusted).filter("kept").select(docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five words, similarity 0.8 or more): the one with the smallest id.

    A row whose id is null stays. If an id is repeated, texts are grouped and not ids: different texts
    of one id stay, and of rows with the same id and text one does.
    """
    if docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 and doc_id is not null").limit(1).count():
        return _near_duplicate_texts(spark, docs)
    found = neardup.near_duplicates(spark, docs.select("doc_id", "text"), percent=80)
    gone = found.filter("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def _near_duplicate_texts(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``near_duplicate_stage`` where ids are repeated: each id and text is a document of its own.

    A group keeps the smallest id and, of its texts, the one with the smallest digest. A null text is an empty one.
    """
    digest = f"{free_prefix(docs, '_near')}digest"
    named = docs.withColumn(digest, F.sha2(text_or_empty(), 256))
    rows = named.filter("doc_id is not null").select("doc_id", F.col(digest).alias("_digest"), text_or_empty().alias("text"))
    rows = rows.groupBy("doc_id", "_digest").agg(F.first("text").alias("text"))
    rows = stored(spark, rows.withColumn("_row", F.monotonically_increasing_id()), "pipeline-rows")
    found = neardup.near_duplicates(spark, rows.select("_row", "text"), percent=80, id_col="_row")
    placed = rows.drop("text").join(found.select(F.col("doc_id").alias("_row"), "component_id"), "_row")
    first = placed.groupBy("component_id").agg(F.min(F.struct("doc_id", "_digest")).alias("k")).select("k.doc_id", F.col("k._digest").alias(digest))
    kept = named.filter("doc_id is not null").join(first, ["doc_id", digest], "left_semi").dropDuplicates(["doc_id", digest])
    return kept.select(docs.columns).union(docs.filter("doc_id is null"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by marks, ``n_chars`` of the new text."""
    found = secrets.scan(spark, docs).withColumn("text", secrets.redact(F.col("text"), F.col("secret_spans")))
    found = found.withColumn("n_chars", F.when(F.size("secret_spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return found.select(docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that a source's share follows the square root of its size."""
    return mixing.mix(spark, docs).select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 4096."""
    return packing.pack_documents(spark, docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_stage),
    ("near-dedup", near_duplicate_stage),
    ("secret scans", secrets_stage),
    ("source mixing", mixing_stage),
    ("best-fit packing", packing_stage),
]

#: SQL has no tokenizer and no xxhash; the whole pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, each stored as Parquet and read again."""
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES[:-1]):
        with intermediates(spark, keep=1):
            docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
