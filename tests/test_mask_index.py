"""The stored index of a mask, resolved barcodes kept with it, and pieces that many mask rows share."""

import random

from pyspark.sql import functions as F

from spotweave import config
from spotweave.functions import sequence
from spotweave.operators import mapping, mask_index, resolve
from spotweave.plans.fixtures import view

TABLES = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(str, df.select("barcode", "match_kind", "bc", "x", "y").collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_index_equals_the_mask_and_resolves_once(spark, tmp_path, monkeypatch):
    mask, pairs = view(spark, TABLES, "chip_mask"), view(spark, TABLES, "read_pairs")
    spec = config.RunSpec(barcode=config.BarcodeSpec(mismatch=2))
    barcodes = resolve.distinct_barcodes(mapping.sliced(pairs, spec))
    want = rows_of(resolve.resolve(barcodes, resolve.last_wins(mask, spec.barcode), spec.barcode))
    made = mask_index.build(spark, mask, spec.barcode, str(tmp_path / "index"), buckets=5)
    half = rows_of(made.resolved(barcodes.filter("hash(barcode) % 2 = 0"), spec.barcode))
    assert set(half) < set(want) and half
    seen, real = [], resolve.resolve
    monkeypatch.setattr(resolve, "resolve", lambda b, *a, **k: seen.append(b.count()) or real(b, *a, **k))
    assert rows_of(made.resolved(barcodes, spec.barcode)) == want
    opened = mask_index.open_index(spark, str(tmp_path / "index"))
    assert rows_of(opened.resolved(barcodes, spec.barcode)) == want
    assert len(seen) == 1 and 0 < seen[0] < barcodes.count()  # only the unseen half, and nothing the second time
    one = lambda m: sorted(map(str, mapping.map_pairs(pairs, m, spec).select("read_id", "match_kind", "x", "y", "passed").collect()))
    assert one(opened) == one(mask)


def test_mask_of_an_index_is_not_shuffled(spark, tmp_path):
    mask = view(spark, TABLES, "chip_mask")
    spec = config.BarcodeSpec()
    made = mask_index.build(spark, mask, spec, str(tmp_path / "index"), buckets=6)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        codes = mask.select("barcode", sequence.encode("barcode").alias("code"))
        hits = resolve.exact(codes, made.dictionary())
        text = plan(hits)
        assert text.count("Exchange") == 1 and "Bucketed: true" in text  # that of the barcodes
        assert hits.count() == codes.join(resolve.last_wins(mask, spec), F.col("code") == F.col("bc")).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def crowded(n, seed):
    """Barcodes that share a run of nine bases."""
    rng = random.Random(seed)
    return ["ACTGACTGA" + "".join(rng.choice("ACTG") for _ in range(16)) for _ in range(n)]


def test_crowded_pieces_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(resolve, "CROWD", 50)
    spec, mask = config.BarcodeSpec(mismatch=2), sorted(set(crowded(2000, 1)))
    rng = random.Random(2)

    def spoilt(b, k):
        for i in rng.sample(range(25), k):
            b = b[:i] + rng.choice([c for c in "ACTG" if c != b[i]]) + b[i + 1 :]
        return b

    reads = sorted({spoilt(b, rng.randrange(4)) for b in mask[:300]})
    dictionary = resolve.last_wins(spark.createDataFrame([(b, k, k, k) for k, b in enumerate(mask)], "barcode string, x long, y long, rec_no long"), spec)
    got = {r.barcode: (r.match_kind, r.x) for r in resolve.resolve(spark.createDataFrame([(b,) for b in reads], "barcode string"), dictionary, spec).collect()}
    want = {}
    for b in reads:
        near = [sum(p != q for p, q in zip(b, m)) for m in mask]
        low = min(near)
        if low <= 2:
            hits = [k for k, d in enumerate(near) if d == low]
            want[b] = (("exact", "mis1", "mis2")[low], hits[0]) if len(hits) == 1 else ("ambiguous", None)
    assert got == want and len({k for k, _ in want.values()}) > 2


def test_pieces_follow_measured_frequency(spark):
    """Bases every third place are chosen where a run is shared by all rows, and no task gets a piece's whole crowd."""
    mask = spark.createDataFrame([(b,) for b in crowded(3000, 3)], "barcode string").select(sequence.encode("barcode").alias("bc"), F.lit(1).cast("long").alias("x"), F.lit(1).cast("long").alias("y"))
    found = resolve.measured(spark, mask, 25, 2)
    assert found.masks == resolve.piece_masks(25, 2, "strides") and found.crowds.count() == 0
    assert sum(resolve.piece_masks(25, 2, "runs")) == sum(resolve.piece_masks(25, 2, "strides")) == (1 << 50) - 1
