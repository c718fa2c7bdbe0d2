"""No operator loses a column, whatever its name; very long texts; executors without the package."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from spotweave.llm import language, mixing, neardup, packing, quality, queries, secrets, sharding, tokens
from spotweave.llm.common import free_prefix, scratch_path

INTERNAL = (
    "_owner _repo _k1 _k2 _base _wide _v _digest digest _tokensdigest _mix1 _mix2 _part _ends _rank _chunk _start _n _mix_group _mix_parts _mix_cdf _mix_u _mix_more "
    "_id _trusted _text _raw _gone _row _secretk1 _qualityk1 _shard_part _neardigest bucket points group rate words llr lang_h h t"
).split()


@pytest.fixture(scope="module")
def wide(spark):
    """Documents with a column of each name that an operator uses for itself."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    return docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in INTERNAL}).cache()


def operators(spark):
    trusted = spark.range(0, 60, 2).select(F.col("id").alias("doc_id"))
    tokenizer = queries.tokenizer_path("byte_bpe_50k.json")
    stage = lambda f: lambda d: f(spark, d, "/root/testdata/sf0.001")
    return {
        "secrets": lambda d: secrets.scan(spark, d),
        "tokens": lambda d: tokens.count_tokens(spark, d, tokenizer, scratch_path(spark, "cache")),
        "sharding": lambda d: sharding.shard_rows(spark, d, [F.col("doc_id"), F.col("_part")], 5),
        "quality": lambda d: quality.quality(spark, d, trusted),
        "mixing": lambda d: mixing.mix(spark, d),
        "language": lambda d: language.identify(spark, d, language.train(spark, d)),
        "near stage": stage(corpus_pipeline.near_duplicate_stage),
        "near stage of repeated ids": lambda d: corpus_pipeline.near_duplicate_stage(spark, d.union(d.limit(3)), ""),
        "secrets stage": stage(corpus_pipeline.secrets_stage),
    }


@pytest.mark.parametrize("name", ["secrets", "tokens", "sharding", "quality", "mixing", "language", "near stage", "near stage of repeated ids", "secrets stage"])
def test_no_column_is_lost(spark, wide, name):
    found = operators(spark)[name](wide)
    assert set(wide.columns) <= set(found.columns)
    rows = found.select("doc_id", *INTERNAL).collect()
    assert rows and all(r[c] == f"{c}{r['doc_id']}" for r in rows for c in INTERNAL)
    assert not {c for c in set(found.columns) - set(wide.columns) if c.startswith("_")}


def test_free_prefix(spark):
    assert free_prefix(spark.range(1).withColumn("_Mix_u", F.lit(1)), "_mix") == "_mix__"


def test_very_long_text(spark):
    long = "word " * 1_000_000 + "end."
    docs = spark.createDataFrame([(1, long, "en", "s"), (2, long, "en", "s"), (3, "short text here", "en", "s")], "doc_id long, text string, lang string, source string")
    found = {r.doc_id: r for r in neardup.near_duplicates(spark, docs).collect()}
    assert (found[1].component_id, found[2].component_id, found[1].n_shingles) == (1, 1, 2)
    counted = {r.doc_id: r.n_tokens for r in tokens.count_tokens(spark, docs, queries.tokenizer_path("byte_bpe_50k.json"), scratch_path(spark, "cache")).collect()}
    assert counted[1] == counted[2] > 1_000_000
    judged = {r.doc_id: (r.n_words, r.base_failed) for r in quality.quality(spark, docs, docs.select("doc_id")).collect()}
    assert judged[1] == (1_000_001, True)
    assert {r.doc_id: r.lang_pred for r in language.identify(spark, docs, language.train(spark, docs)).collect()} == dict.fromkeys((1, 2, 3), "en")
    pieces = packing.pack_documents(spark, docs, queries.tokenizer_path("word_bpe_49k.json"))
    assert pieces.filter("doc_id = 1").agg(F.max("piece")).first()[0] > 200


def test_copies_do_not_fill_the_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(language, "_calibrated", lambda models, langs, bits, n: seen.append(len(langs)))
    rows = [("the very same words again", "en")] * 3000 + [(f"other words number {k} of many", "en") for k in range(50)]
    language.train(spark, spark.createDataFrame(rows, "text string, lang string"), calibration=20)
    assert seen == [20]


SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])  # the driver only: workers start without it
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
    .config("spark.checkpoint.dir", sys.argv[2] + "/shared").config("spark.sql.warehouse.dir", sys.argv[2] + "/warehouse").getOrCreate())
import __spark_entry__
q = __spark_entry__.queries()
for name in ("op9_language", "op11_conversations", "op13_embeddings", "fastq_lanes", "mask_binary_file"):
    print(name, q[name](spark, "/root/testdata/sf0.001").count())
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONPATH": os.pathsep.join(p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and os.path.realpath(p) != repo)}
    (tmp_path / "run.py").write_text(SCRIPT)
    done = subprocess.run([sys.executable, "run.py", repo, str(tmp_path)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
    assert all(int(line.split()[1]) > 0 for line in done.stdout.splitlines() if line.startswith(("op", "fastq", "mask")))


def test_canonical_texts_have_a_short_plan(spark):
    """Tables of code points are part of a plan's text, which the driver keeps for each step of a query."""
    from spotweave.llm import fingerprints

    rows = spark.createDataFrame([("Straße",)], "text string").select(fingerprints.canonical(F.col("text")))
    assert len(rows._jdf.queryExecution().optimizedPlan().toString()) < 200_000
