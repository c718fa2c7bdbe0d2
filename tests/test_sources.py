"""Byte ranges, pairs, growing files and binary masks, against files read line by line."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from spotweave.sources import checks, fastq, fastq_bytes, mask_binary, tables
from spotweave.sources.store import listed


def records(n, seed=2, side="r"):
    rng = random.Random(seed)
    out = [(f"@{side}{i}", "ACGT" * rng.randrange(1, 9), "+") for i in range(n)]
    return [(*r, "".join(rng.choice("@+I#") for _ in r[1])) for r in out]


def text_of(rows, rng=None, end="\n"):
    """Records as text, with lines between some of them that are none."""
    junk = lambda: "" if rng is None else rng.choice(["", "", "junk" + end, end, "lost" + end + "++" + end])
    return "".join(junk() + end.join(r) + end for r in rows)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def load(spark, **options):
    fastq.register(spark)
    return spark.read.format("fastq").options(**options).load()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("split", [97, 4096])
def test_ranges_find_their_records(spark, tmp_path, end, split):
    rows = records(300)
    (tmp_path / "a.fq").write_text("junk\n\n" + text_of(rows, random.Random(1), end) + "@cut\nAC\n", newline="")
    found = load(spark, path1=str(tmp_path / "a.fq"), split_bytes=split)
    assert found.rdd.getNumPartitions() > 3 and "Exchange" not in plan(found)
    assert sorted(tuple(r)[2:6] for r in found.collect()) == sorted(rows)


def test_folders_compressed_and_without_qualities(spark, tmp_path):
    rows = records(90)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "b.fq").write_text(text_of(rows[40:]).rstrip("\n"))
    with gzip.open(tmp_path / "in" / "a.fq.gz", "wt") as f:
        f.write(text_of(rows[:20]))
    with gzip.open(tmp_path / "in" / "a.fq.gz", "at") as f:  # a second member
        f.write(text_of(rows[20:40]))
    (tmp_path / "in" / "_SUCCESS").write_text("")
    found = fastq.read_fastq(spark, f"file://{tmp_path}/in", lane=3, numbered=True)
    assert sorted(map(tuple, found.collect())) == [(3, k, *r) for k, r in enumerate(rows)]
    (tmp_path / "short.fq").write_text(text_of([r[:3] for r in rows]))
    short = load(spark, path1=str(tmp_path / "short.fq"), has_quality="false", split_bytes=101)
    assert sorted(tuple(r)[2:6] for r in short.collect()) == sorted((*r[:3], "K" * len(r[1])) for r in rows)
    (tmp_path / "none.fq").write_text("")
    assert load(spark, path1=str(tmp_path / "none.fq")).count() == 0
    with pytest.raises(Exception, match="nowhere"):
        load(spark, path1=str(tmp_path / "nowhere")).collect()


@pytest.mark.parametrize("packed", [False, True])
def test_pairs_by_ranges(spark, tmp_path, monkeypatch, packed):
    one, two = records(400, 3, "a"), records(380, 4, "b")
    (tmp_path / "1").mkdir()
    (tmp_path / "1" / "x.fq").write_text(text_of(one[:150], random.Random(5)))
    (tmp_path / "1" / "y.fq").write_text(text_of(one[150:]))
    if packed:
        with gzip.open(tmp_path / "2.fq.gz", "wt") as f:
            f.write(text_of(two))
    else:
        (tmp_path / "2.fq").write_text(text_of(two, random.Random(6), "\r\n"), newline="")
    sides = str(tmp_path / "1"), str(tmp_path / ("2.fq.gz" if packed else "2.fq"))
    index = str(tmp_path / "index")
    fastq.index_fastq(spark, list(sides), index, split_bytes=1500, step_bytes=400)
    found = load(spark, path1=sides[0], path2=sides[1], index=index, split_bytes=900)
    assert found.rdd.getNumPartitions() > 8 and "Exchange" not in plan(found)
    want = [(0, k, *a, *b, False) for k, (a, b) in enumerate(zip(one, two))]
    assert sorted(map(tuple, found.collect())) == want
    whole = load(spark, path1=sides[0], path2=sides[1])
    assert whole.rdd.getNumPartitions() == 1 and sorted(map(tuple, whole.collect())) == want
    lanes = fastq.read_fastq_pairs(spark, [sides, (sides[1], sides[0])])
    assert lanes.count() == 760 and "Exchange" not in plan(lanes)


@pytest.mark.parametrize("n", [300, 301])
def test_interleaved_by_ranges(spark, tmp_path, n):
    rows = records(n)
    (tmp_path / "a.fq").write_text(text_of(rows, random.Random(7)))
    index = str(tmp_path / "index")
    fastq.index_fastq(spark, [str(tmp_path / "a.fq")], index, split_bytes=1000, step_bytes=300)
    found = load(spark, path1=str(tmp_path / "a.fq"), interleaved="true", index=index, split_bytes=500)
    assert found.rdd.getNumPartitions() > 5
    assert sorted(map(tuple, found.collect())) == [(0, k, *rows[2 * k], *rows[2 * k + 1], False) for k in range(n // 2)]


def test_small_reads_give_the_same(tmp_path, monkeypatch):
    rows = records(120)
    (tmp_path / "a.fq").write_text("x\n" + text_of(rows, random.Random(8)))
    for chunk in (1, 7, 64, 1000):
        monkeypatch.setattr(fastq_bytes, "CHUNK", chunk)
        found = [x for held, s, e, at, _, _ in fastq_bytes.of_range(str(tmp_path / "a.fq"), 0, None, 4) for x in fastq_bytes.table(held, s, e, at, 4).to_pylist()]
        assert [tuple(x.values()) for x in found] == rows


def test_growing_file_gives_each_record_once(spark, tmp_path):
    rows = records(90)
    whole = text_of(rows)
    (tmp_path / "in").mkdir()
    grown, out, log = tmp_path / "in" / "a.fq", str(tmp_path / "out"), str(tmp_path / "log")
    fastq.register(spark)
    cuts = [0, len(whole) // 3 + 5, len(whole) * 2 // 3 + 1, len(whole)]  # within records
    seen = []
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        with open(grown, "a") as f:
            f.write(whole[a:b])
        if k == 1:
            (tmp_path / "in" / "b.fq").write_text(text_of(records(5, 9, "late")))
        arriving = spark.readStream.format("fastq").option("path1", str(tmp_path / "in")).option("split_bytes", "700").load()
        query = arriving.writeStream.format("parquet").option("checkpointLocation", log).option("path", out).trigger(availableNow=True).start()
        query.awaitTermination(120)
        query.stop()
        seen.append(spark.read.parquet(out).count())
    assert seen[0] < seen[1] < seen[2] == 95
    found = [tuple(r)[2:6] for r in spark.read.parquet(out).collect()]
    assert sorted(found) == sorted(rows + records(5, 9, "late"))


def test_binary_masks(spark, tmp_path):
    place = str(tmp_path / "mask")
    mask = spark.range(5000).select((F.col("id") * 7919 % 100_003).alias("bc"), F.col("id").alias("x"), (F.lit(4294967295) - F.col("id")).alias("y"))
    mask_binary.write_mask_binary(mask.coalesce(3), place)
    found = mask_binary.read_mask_binary(spark, place, 2)
    assert sorted(tuple(r)[:3] for r in found.collect()) == sorted(map(tuple, mask.collect()))
    mask_binary.register(spark)
    cut = spark.read.format("chip_mask").option("split_bytes", 1000).load(place)
    assert cut.rdd.getNumPartitions() > 50 and "Exchange" not in plan(cut)
    assert [r.rec_no for r in cut.orderBy("rec_no").collect()] == list(range(5000))
    raw = b"".join(open(f, "rb").read() for f, _ in listed(place))
    assert [r.bc for r in cut.orderBy("rec_no").collect()] == [int.from_bytes(raw[k : k + 8], "little") for k in range(0, len(raw), 16)]
    mask_binary.write_mask_binary(mask.limit(10), place, overwrite=True)
    assert mask_binary.read_mask_binary(spark, place).count() == 10
    (tmp_path / "odd.bin").write_bytes(b"x" * 20)
    with pytest.raises(Exception, match="whole record"):
        mask_binary.read_mask_binary(spark, str(tmp_path / "odd.bin")).count()


def test_failed_write_leaves_no_file(spark, tmp_path):
    place = tmp_path / "mask"
    bad = F.when(F.col("id") == 900, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id"))
    mask = spark.range(0, 1000, 1, 4).select(F.col("id").alias("bc"), F.col("id").alias("x"), bad.alias("y"))
    with pytest.raises(Exception, match="broken"):
        mask_binary.write_mask_binary(mask, str(place))
    assert not place.exists() or list(place.iterdir()) == []


def test_order_of_masks_in_several_files(spark, tmp_path):
    """A small file before a large one stays before it, though Spark packs files by size."""
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "a").write_text("AAAC\t1\t1\nCCCC\t5\t5\n")
    (tmp_path / "m" / "b").write_text("".join(f"GG{k:04}\t{k}\t0\n" for k in range(3000)) + "AAAC\t2\t2\n")
    (tmp_path / "n").write_text("CCCC\t6\t6\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in before:
        spark.conf.set(k, "4096")
    try:
        found = tables.read_mask_text(spark, [str(tmp_path / "m"), str(tmp_path / "n")]).orderBy("src", "rec_no").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = [("AAAC", 1), ("CCCC", 5), *[(f"GG{k:04}", k) for k in range(3000)], ("AAAC", 2), ("CCCC", 6)]
    assert [(r.barcode, r.x) for r in found] == want and [(r.src, r.rec_no) for r in found] == [*[(0, k) for k in range(3003)], (1, 0)]


def test_jobs_are_checked_before_they_are_planned(tmp_path):
    a, b, mask, out = (str(tmp_path / n) for n in ("a.fq", "b.fq", "mask.tsv", "out"))
    for path in (a, b, mask):
        open(path, "w").close()
    assert checks.check_mapping(f"{a},{b}", f"{b}, {a}", mask, [out]) == [(a, b), (b, a)]
    checks.check_job([str(tmp_path), str(tmp_path / "*.fq")], [out])
    with pytest.raises(ValueError, match="2 lanes of first reads, 1 of second reads"):
        checks.check_mapping(f"{a},{b}", b, mask, [out])
    with pytest.raises(ValueError, match="no input given"):
        checks.check_mapping("", "", mask, [out])
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError) as e:
        checks.check_job([a, "", f"{tmp_path}/gone.fq", f"{tmp_path}/empty"], [out, out + "/", a])
    for part in ("input 2 has no name", "no such path", "no files in", "output named 2 times", "output is an input"):
        assert part in str(e.value)
    with pytest.raises(ValueError, match="no output given"):
        checks.check_job([a], [])
