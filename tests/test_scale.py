"""What must not grow faster than the input: rows spelt out, stored copies, files of a fixed number."""

import random
from pathlib import Path

from pyspark.sql import functions as F

from spotweave import catalogue, catalogue_files, config
from spotweave.functions import packing, sequence
from spotweave.operators import mapping, mask_index, protein, resolve
from spotweave.plans.fixtures import SQL, view
from spotweave.sources import fastq
from spotweave.storage import scratch, shared_dir

TABLES = "/root/testdata/sf0.001"


def test_fixture_is_derived_where_it_is_read(spark):
    """Nothing is stored, columns that aren't read aren't computed, and no filter copies the view's expressions."""
    reads = view(spark, TABLES, "read_pairs")
    assert reads.count() and not list(Path(shared_dir(spark)).glob("fixture-*"))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert plan(reads.select("read_id")).count("md5(") == 0
    some = reads.filter(F.col("seq1").contains("GATTACA") | F.col("seq1").startswith("N"))
    assert plan(some).count("md5(") <= plan(reads).count("md5(")


def test_some_set_of_blocks_agrees():
    rng = random.Random(4)
    for distance, blocks in ((1, 2), (1, 4), (2, 3), (2, 4), (2, 6), (3, 6)):
        for scheme in ("runs", "strides"):
            masks = resolve.block_masks(25, distance, scheme, blocks)
            for _ in range(50):
                other = sum(rng.randrange(1, 4) << 2 * i for i in rng.sample(range(25), distance))
                assert any(not other & m for m in masks)


def test_large_masks_take_more_blocks(spark, monkeypatch):
    """Where many mask rows share a piece there are more blocks, with the same rows; no neighbour is spelt out."""
    monkeypatch.setattr(sequence, "neighbours", None)
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("ACTG") for _ in range(n))
    mask = sorted({word(25) for _ in range(400)})
    reads = sorted({b[:3] + word(1) + b[4:20] + word(1) + b[21:] for b in mask})
    rows = spark.createDataFrame([(b, k, k, k) for k, b in enumerate(mask)], "barcode string, x long, y long, rec_no long")
    spec, barcodes = config.BarcodeSpec(mismatch=2), spark.createDataFrame([(b,) for b in reads], "barcode string")
    dictionary = resolve.last_wins(rows, spec)
    few = {tuple(r) for r in resolve.resolve(barcodes, dictionary, spec).collect()}
    monkeypatch.setattr(resolve, "ROW_WORK", 0)
    assert len(resolve.measured(spark, dictionary, 25, 2).masks) > 3
    assert {tuple(r) for r in resolve.resolve(barcodes, dictionary, spec).collect()} == few
    assert {r[1] for r in few} >= {"mis1", "mis2"}


def test_collisions_equal_all_variants(spark, monkeypatch):
    """Equal to grouping every variant, also with equal barcodes and both tolerances, without spelling all out."""
    rng = random.Random(6)
    words = ["".join(rng.choice("ACTG") for _ in range(6)) for _ in range(60)]
    proteins = spark.createDataFrame([(k, w) for k, w in enumerate([*words, *words[:3]])], "protein_index int, barcode string")
    for mismatch in (0, 1, 2):
        spec = config.ProteinSpec(length=6, mismatch=mismatch)
        every = protein.expand(proteins, spec).groupBy("variant").agg(F.min("protein_index").alias("a"), F.max("protein_index").alias("b")).filter("a <> b")
        want = {tuple(r) for r in every.collect()}
        with monkeypatch.context() as m:
            m.setattr(protein, "expand", None)
            assert {tuple(r) for r in protein.collisions(proteins, spec).collect()} == want and want


def test_more_pairs_arrive_in_more_files(spark, monkeypatch):
    monkeypatch.setattr(catalogue_files, "ARRIVING", 500)
    made = []
    monkeypatch.setattr(catalogue_files, "scratch", lambda spark, label: made.append(f"{shared_dir(spark)}/few-{label}-{len(made)}") or made[-1])
    catalogue_files._arriving(spark, TABLES)
    sizes = [spark.read.parquet(str(f)).count() for f in Path(made[0].removeprefix("file:")).glob("*.parquet")]
    assert len(sizes) > 4 and max(sizes) <= 500 and sum(sizes) == view(spark, TABLES, "read_pairs").count()


def test_reads_are_derived_twice_at_most(spark):
    """Once for the distinct barcodes (stored), once for the join; reads that can't match are no branch of their own."""
    mapped = catalogue.QUERIES["unmapped_reads"](spark, TABLES)
    plan = mapped._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_linenumber#") and plan.count("Union") == 0


def test_proteins_are_few_whatever_they_come_from(spark):
    """Reads are derived once, and aren't dealt over the few sequences of proteins, though the list is drawn from a large table."""
    limit = "spark.sql.autoBroadcastJoinThreshold"
    try:
        spark.conf.set(limit, "16k")
        hits = catalogue.QUERIES["umi_counts"](spark, TABLES)
        assert "hashpartitioning(variant" not in hits._jdf.queryExecution().executedPlan().toString()
        few = {tuple(r) for r in hits.collect()}
    finally:
        spark.conf.unset(limit)
    hits = catalogue.QUERIES["umi_counts"](spark, TABLES)
    assert hits._jdf.queryExecution().optimizedPlan().toString().count("Relation [l_orderkey") == 1
    assert {tuple(r) for r in hits.collect()} == few and few


def test_exact_reads_meet_the_dictionary(spark):
    """As by distinct barcodes: small letters as capitals (n as G), letters that are no bases as in codes, also where a mask's code is of another length."""
    rng = random.Random(7)
    mask = ["".join(rng.choice("ACTG") for _ in range(25)) for _ in range(60)] + ["G" * 25, "T" * 25, "ACGTR" * 5]
    reads = [*mask, mask[0].lower(), "n" * 25, "N" + mask[1][1:], mask[2][:24], "", None, *[b[::-1] for b in mask]]
    pairs = spark.createDataFrame([(k, f"@{k}", r, "I" * 25, "A" * 15, "I" * 15) for k, r in enumerate(reads)], "read_id long, name string, seq1 string, qual1 string, seq2 string, qual2 string")
    codes = spark.createDataFrame([(b, k, k + 1) for k, b in enumerate(mask)], "barcode string, x long, y long").select(sequence.encode("barcode").alias("bc"), "x", "y")
    codes = codes.unionByName(codes.limit(5).withColumn("bc", F.col("bc") + 4**25))
    spec = config.RunSpec(umi=config.UmiSpec(length=0))
    found = resolve.resolve(resolve.distinct_barcodes(mapping.sliced(pairs, spec)), resolve.last_wins(codes, spec.barcode), spec.barcode)
    want = mapping.sliced(pairs, spec).join(found, "barcode", "left").select("read_id", "match_kind", "bc", "x", "y").collect()
    mapped = mapping.map_pairs(pairs, codes, spec)
    got = mapped.select("read_id", "match_kind", "bc", "x", "y").collect()
    by_id = lambda rows: sorted(rows, key=lambda r: r["read_id"])
    assert by_id(got) == by_id(want) and sum(r["x"] is not None for r in got) >= 65
    assert "keys=[barcode" not in mapped._jdf.queryExecution().executedPlan().toString()


def test_read_pairs_equal_their_sql(spark):
    """The rows of the fixture's SQL, derived with few letter maps and little generated code."""
    table = spark.read.parquet(f"{TABLES}/lineitem.parquet")
    want = spark.sql(SQL["read_pairs"].replace("FROM lineitem", "FROM {lineitem}"), lineitem=table)
    by_spot = spark.sql(SQL["protein_read_pairs"].replace("FROM read_pairs", "FROM {pairs}"), pairs=want)
    for name, rows in (("read_pairs", want), ("protein_read_pairs", by_spot)):
        found = view(spark, TABLES, name)
        assert found.dtypes == rows.dtypes
        assert found.exceptAll(rows).count() == 0 and rows.exceptAll(found).count() == 0
        assert found._jdf.queryExecution().optimizedPlan().toString().count("translate(") <= 4


def _moved(df):
    """Names and types of what reads bring to the join with resolved barcodes."""
    nodes = [df._jdf.queryExecution().optimizedPlan()]
    for node in nodes:
        if node.nodeName() == "Join":
            return {f.name(): f.dataType().simpleString() for f in node.left().schema().fields()}
        nodes += [node.children().apply(k) for k in range(node.children().size())]
    return {}


def test_reads_cut_away_do_not_move(spark):
    """Of the first read, of which pairs that are written keep nothing, only that moves."""
    moved = _moved(catalogue.QUERIES["mapped_tags_pe"](spark, TABLES))
    assert {"out_seq1", "out_seq2", "umi"} <= set(moved) and not {"seq1", "qual1", "seq2", "bar_qual"} & set(moved)


def test_trimmed_before_or_after(spark):
    """The same rows whether reads are cut before they move or after, also with the identifier on the second read or without one."""
    pairs, mask = view(spark, TABLES, "read_pairs").limit(500), view(spark, TABLES, "chip_mask")
    for umi in (config.UmiSpec(), config.UmiSpec(start=40, length=10, read=2), config.UmiSpec(length=0)):
        spec = config.RunSpec(barcode=config.BarcodeSpec(mismatch=1), umi=umi)
        names = ["read_id", "tagged_name", "out_seq1", "out_qual1", "out_seq2", "out_qual2"]
        one, two = (mapping.tagged_pairs(mapping.map_pairs(pairs, mask, spec, trimmed=t), spec).select(names).collect() for t in (False, True))
        assert sorted(one) == sorted(two) and len(one) > 100


def test_resolving_leaves_no_shuffles(spark):
    """What resolving barcodes shuffled is gone when it is done, without waiting for the driver's garbage."""
    place = [Path(x) for x in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]
    files = lambda: {f for p in place for f in p.glob("*/shuffle_*.data")}
    pairs, spec = view(spark, TABLES, "read_pairs"), config.RunSpec(barcode=config.BarcodeSpec(mismatch=1))
    before = files()
    found = mask_index.build(spark, view(spark, TABLES, "chip_mask"), spec.barcode, scratch(spark, "index"))
    found = found.resolved(resolve.distinct_barcodes(mapping.sliced(pairs, spec)), spec.barcode)
    assert not files() - before and found.count() > 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_packed_texts(spark):
    """Any text comes back; equal texts are equal bytes where the letters are given; bases and qualities get smaller."""
    rng = random.Random(8)
    letters = ["ACGT", "ACGTN", "FEDC:?5+#GHI", "acgt", "\u00e9\nA", "".join(map(chr, range(33, 97))), "A~", "`!", "A"]
    texts = [None, "", "A" * 70_000, *["".join(rng.choices(rng.choice(letters), k=rng.choice([1, 22, 23, 25, 79, 300]))) for _ in range(800)]]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts * 2)], "k int, t string").repartition(3)
    some = rows.select("k", "t", packing.packed(F.col("t")).alias("p"), packing.packed(F.col("t"), "ACGT").alias("q"))
    back = some.select("k", "t", "q", packing.unpacked(F.col("p")).alias("p"), packing.unpacked(F.col("q")).alias("u")).collect()
    assert len(back) == 2 * len(texts) and all(r["t"] == r["p"] == r["u"] == texts[r["k"] % len(texts)] for r in back)
    assert len({bytes(r["q"]) for r in back if r["t"]}) == len({r["t"] for r in back if r["t"]})
    reads = view(spark, TABLES, "read_pairs").agg(*[F.sum(F.octet_length(packing.packed(F.col(c)))) / F.sum(F.length(c)) for c in ("seq1", "qual1", "seq2", "qual2")])
    assert max(reads.first()) < 0.8


def test_unmapped_pairs_move_packed(spark):
    """Reads of whole pairs move as bytes, with the same rows."""
    pairs, mask, spec = view(spark, TABLES, "read_pairs"), view(spark, TABLES, "chip_mask"), config.RunSpec(barcode=config.BarcodeSpec(mismatch=1))
    odd = pairs.limit(300).withColumn("seq1", F.expr("CASE read_id % 5 WHEN 0 THEN NULL WHEN 1 THEN lower(seq1) WHEN 2 THEN substr(seq1, 1, 20) ELSE concat(seq1, '\u00e9') END".replace("read_id % 5", "length(read_id) % 5")))
    names = [*pairs.columns, "x", "y", "match_kind", "umi_fail", "passed", "umi", "barcode", "reason"]
    key = lambda r: str(tuple(r))
    for some in (pairs, odd):
        one, two = (mapping.map_pairs(some, mask, spec, packed=p).select(names).collect() for p in (False, True))
        assert sorted(one, key=key) == sorted(two, key=key) and any(r["x"] is not None for r in one)
    moved, write = [], fastq.write_unmapped
    try:
        fastq.write_unmapped = lambda pairs, *more: (moved.append(_moved(pairs)), write(pairs, *more))
        found = catalogue.QUERIES["unmapped_pair_files"](spark, TABLES).count()
    finally:
        fastq.write_unmapped = write
    assert found and {k: moved[0][k] for k in ("name", "seq1", "qual1", "seq2", "qual2")} == dict.fromkeys(("name", "seq1", "qual1", "seq2", "qual2"), "binary")


def test_lanes_are_less_than_their_text(spark, monkeypatch):
    """Files of both sides take less than half of the bytes of their records."""
    made = []
    monkeypatch.setattr(catalogue_files, "scratch", lambda spark, label: made.append(scratch(spark, label)) or made[-1])
    rows = catalogue.QUERIES["fastq_lanes"](spark, TABLES)
    text = rows.agg(F.sum(sum((F.length(c) for c in rows.columns if c != "lane"), F.lit(12)))).first()[0]
    files = [f for p in made for f in Path(p.removeprefix("file:")).glob("part-*")]
    assert len(made) == 4 and sum(f.stat().st_size for f in files) < text / 2
