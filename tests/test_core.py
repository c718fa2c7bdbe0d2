"""Functions, sources, operators and streams against plain Python models."""

import gzip
import random
import struct
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from spotweave import config
from spotweave.functions import reads as R
from spotweave.functions import sequence as S
from spotweave.functions import text
from spotweave.operators import mapping, masks, protein, resolve
from spotweave.plans.fixtures import view
from spotweave.sources import fastq, mask_binary, tables
from spotweave.streaming import jobs

TABLES = "/root/testdata/sf0.001"
CODE = dict(zip("ACTGN", (0, 1, 2, 3, 3)))


def code(seq):
    return sum(CODE[b] << 2 * i for i, b in enumerate(seq))


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_sequence_functions(spark):
    rng = random.Random(1)
    rows = [("".join(rng.choice("ACTGN") for _ in range(25)), "".join(rng.choice("ACTG") for _ in range(25))) for _ in range(50)]
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select(S.encode("a"), S.decode(S.encode("b"), 25), S.hamming(S.encode("a"), S.encode("b")), S.n_index("a"), S.encode_reverse_complement("b")).collect()
    flip = str.maketrans("ACGT", "TGCA")
    for (a, b), (x, back, d, n, rc) in zip(rows, got):
        assert x == code(a) and back == b
        assert d == sum(CODE[p] != CODE[q] for p, q in zip(a, b))
        assert n == (-1 if "N" not in a else a.index("N") if a.count("N") == 1 else -2)
        assert rc == code(b.translate(flip)[::-1])
    assert one(spark, S.reverse_complement(F.lit("AAAATTTTCCCCGGGG")))[0] == "CCCCGGGGAAAATTTT"
    assert [S.neighbour_count(25, k) for k in (1, 2, 3)] == [75, 2775, 64875] and S.poly_t(3) == code("TTT")
    for k in (1, 2):
        near = one(spark, S.neighbours(F.lit(code("ACTGA")), 5, k))[0]
        assert len(set(near)) == len(near) == S.neighbour_count(5, k) - S.neighbour_count(5, k - 1)
    x, y, g = S.unpack_cell(S.pack_cell(F.lit(70000), F.lit(9), F.lit(65535)))
    assert tuple(one(spark, x, y, g)) == (70000, 9, 65535)
    assert tuple(one(spark, *S.unpack_position(S.pack_position(F.lit(4294967295), F.lit(7))))) == (4294967295, 7)


def test_read_functions(spark):
    name = F.lit("@NS500713:64:HFKJJBGXY:1:11101:20469:1097 1:N:0:TATAGCCT+GGTCCCGA")
    assert tuple(one(spark, R.last_index(name), R.first_index(name))) == ("GGTCCCGA", "TATAGCCT")
    assert one(spark, R.at_least(F.lit("!+5?I"), "5"))[0] == 3
    assert one(spark, R.phred64_to_33(F.lit("@h!")))[0] == "!I!"
    assert tuple(one(spark, *R.name_position(F.lit("FLC001R00200000042")))) == (42, 1, 2)
    assert tuple(one(spark, *R.name_position(F.lit("xC003R004_17"), underscore=True))) == (17, 3, 4)
    assert one(spark, R.trim_front(F.lit("abc"), 3))[0] == "" and one(spark, R.trim_back(F.lit("abc"), 9))[0] == "abc"
    assert one(spark, text.percent(F.lit(1), F.lit(3)))[0] == "33.33" and one(spark, text.percent(F.lit(1), F.lit(0)))[0] == "0.0"
    assert one(spark, text.thousands(F.lit(1234567)))[0] == "1,234,567"
    assert one(spark, text.tokens(F.lit(",,a,b")))[0] == ["a", "b"]
    with pytest.raises(ValueError):
        config.BarcodeSpec(length=40)


def test_overlap_merge(spark):
    # fixed test values: a pair and what it merges to
    left = "TTTTTTCTCTTGGACTCTAACACTGTTTTTTCTTATGAAAACACAGGAGTGATGACTAGTTGAGTGCATTCTTATGAGACTCATAGTCATTCTATGATGTAG"
    right = "AAAAAACTACACCATAGAATGACTATGAGTCTCATAAGAATGCACTCAACTAGTCATCACTCCTGTGTTTTCATAAGAAAAAACAGTGTTAGAGTCCAAGAG"
    q1 = "AAAAA6EEEEEEEEEEEEEEEEE#EEEEEEEEEEEEEEEEEEEEEEEEEEEEEEEEEEAEEEAEEEEEEEEEEEEEEEEEEEEEEEEEEEEEEEEEEEEEEE"
    q2 = "AAAAA6EEEEE/EEEEEEEEEEE#EEEEEEEEEEEEEEEEEEEEEEEEEEEEEEEEEEAEEEAEEEEEEEEEEEEEEEEEEEEEEEEEEEEEEEEEEEEEEE"
    pairs = spark.createDataFrame([(left, q1, right, q2)], "seq1 string, qual1 string, seq2 string, qual2 string")
    merged = mapping.overlap_merge(pairs).collect()
    assert [r["merged_seq"] for r in merged] == [left + "TTTTTT"]


def test_overlap_merge_against_search(spark):
    rng = random.Random(9)
    rows = []
    for _ in range(120):
        n, m, o = rng.randrange(34, 60), rng.randrange(34, 60), rng.randrange(28, 40)
        insert = "".join(rng.choice("ACGT") for _ in range(n + m - min(o, n, m)))
        left, right = list(insert[:n]), list(insert[len(insert) - m :])
        q1, q2 = ["".join(rng.choice("#0?I") for _ in range(k)) for k in (n, m)]
        for _ in range(rng.randrange(4)):
            at = rng.randrange(n)
            left[at] = rng.choice("ACGT")
            q1 = q1[:at] + rng.choice("#0") + q1[at + 1 :]
        rc = "".join(right).translate(str.maketrans("ACGT", "TGCA"))[::-1]
        rows.append(("".join(left), q1, rc, q2[::-1]))

    def merge(a, p, rc, q):
        b, q = rc.translate(str.maketrans("ACGT", "TGCA"))[::-1], q[::-1]
        for o in range(30, min(len(a), len(b)) + 1):
            z = list(zip(a[len(a) - o :], b, p[len(a) - o :], q))
            bad = [x for x in z if x[0] != x[1]]
            if len(bad) < 3 and all(x[2] >= "?" and x[3] <= "0" or x[2] <= "0" and x[3] >= "?" for x in bad):
                win = [x[2] >= "?" and x[3] <= "0" for x in z]
                seq = "".join(x[0] if w else x[1] for x, w in zip(z, win))
                qual = "".join(chr(ord(x[2]) + ord(x[3]) - 33) if x[0] == x[1] else x[2] if w else x[3] for x, w in zip(z, win))
                return a[: len(a) - o] + seq + b[o:], p[: len(a) - o] + qual + q[o:], o, len(bad)
        return None

    want = Counter(x for x in (merge(*r) for r in rows) if x)
    got = mapping.overlap_merge(spark.createDataFrame(rows, "seq1 string, qual1 string, seq2 string, qual2 string"))
    assert Counter(tuple(r) for r in got.select("merged_seq", "merged_qual", "overlap", "diff").collect()) == want and len(want) > 20


def test_intermediates_are_deleted(spark, tmp_path):
    from pathlib import Path

    from spotweave.storage import intermediates, shared_dir, stored

    held = lambda: {p.name for p in Path(shared_dir(spark)).glob("tried-*")}
    with intermediates(spark, keep=1):
        stored(spark, spark.range(3), "tried-first")
        with intermediates(spark, keep=1):
            stored(spark, spark.range(3), "tried-inner")
            stored(spark, spark.range(3), "tried-kept")
        assert len(held()) == 2
        last = stored(spark, spark.range(5), "tried-last")
    assert last.count() == 5 and len(held()) == 1


def test_fastq(spark, tmp_path):
    fastq.register(spark)
    records = [(f"@r{i}/1", "ACGT", "+", "@III") for i in range(7)]
    body = "junk\r\n" + "".join("\r\n".join(r) + "\r\n" for r in records)
    (tmp_path / "a.fq").write_text(body, newline="")
    with gzip.open(tmp_path / "b.fq.gz", "wt", newline="") as f:
        f.write(body)
    (tmp_path / "bad.fq").write_text("@x\nACG\n+\nII\n" + "\n".join(records[0]) + "\n")
    load = lambda **o: spark.read.format("fastq").options(**o).load()
    a, b = str(tmp_path / "a.fq"), str(tmp_path / "b.fq.gz")
    for path in (a, b):
        assert [tuple(r)[2:6] for r in load(path1=path).collect()] == records
    pairs = load(path1=f"{a},{b}", path2=f"{b},{a}").collect()
    assert len(pairs) == 14 and {r["lane"] for r in pairs} == {0, 1} and pairs[0]["seq2"] == "ACGT"
    assert load(path1=a, interleaved="true").count() == 3 == load(path1=b, interleaved="true").count()
    assert load(path1=str(tmp_path / "bad.fq"), mode="DROPMALFORMED").count() == 1
    assert load(path1=str(tmp_path / "bad.fq"), mode="PERMISSIVE").filter("malformed").count() == 1
    with pytest.raises(Exception, match="differ in length"):
        load(path1=str(tmp_path / "bad.fq")).collect()
    out = load(path1=a)
    fastq.write_reads(out, str(tmp_path / "out"), "name1", "seq1", "strand1", "qual1", "gzip")
    back = fastq.read_fastq(spark, str(tmp_path / "out"))
    assert sorted(tuple(r)[2:] for r in back.collect()) == records
    assert fastq.read_interleaved(spark, str(tmp_path / "out")).count() == 3
    both = load(path1=a, path2=b)
    fastq.write_pairs(both, str(tmp_path / "o1"), str(tmp_path / "o2"), ("name1", "seq1", "strand1", "qual1", "name2", "seq2", "strand2", "qual2"))
    lines = [spark.read.text(str(tmp_path / o)).collect() for o in ("o1", "o2")]
    assert lines[0] == lines[1] and len(lines[0]) == 28


def test_table_files(spark, tmp_path):
    (tmp_path / "m3").write_text("AAAC\t1\t2\nshort\n\nCCCC\t3\t4\n")
    (tmp_path / "m5").write_text("AAAC\tq\tr\t1\t2\nA\t1\t2\t3\n")
    assert [tuple(r)[:3] for r in tables.read_mask_text(spark, str(tmp_path / "m3")).orderBy("rec_no").collect()] == [("AAAC", 1, 2), ("CCCC", 3, 4)]
    assert [tuple(r)[:3] for r in tables.read_mask_text(spark, str(tmp_path / "m5")).collect()] == [("AAAC", 1, 2)]
    rows = [(code("ACTG" * 6 + "A"), 4294967295, 7), (5, 0, 1)]
    mask = spark.createDataFrame(rows, "bc long, x long, y long")
    mask_binary.write_mask_binary(mask, str(tmp_path / "bin"))
    raw = b"".join(p.read_bytes() for p in sorted((tmp_path / "bin").iterdir()))
    assert sorted(struct.iter_unpack("<QII", raw)) == sorted(rows)
    assert sorted(tuple(r)[:3] for r in mask_binary.read_mask_binary(spark, str(tmp_path / "bin")).collect()) == sorted(rows)
    (tmp_path / "c").write_text("1 2 3\n 4\t5  6\nbad\n")
    assert [tuple(r) for r in tables.read_counts(spark, str(tmp_path / "c")).collect()] == [(1, 2, 3), (4, 5, 6)]
    (tmp_path / "p").write_text("0\tACGT\tP0\n\n1\tGGGG\tP1\n")
    assert tables.read_proteins(spark, str(tmp_path / "p")).count() == 2
    (tmp_path / "f").write_text("TTTT 46\nTTTT 47\nGA -1\n")
    from spotweave.operators.filters import fixed_spec

    assert set(fixed_spec(tables.read_fixed(spark, str(tmp_path / "f")), 50).sequences) == {("TTTT", 46), ("GA", -1)}
    cells = masks.from_matrix(spark.createDataFrame([([[[0, 5], [6, 0]]],)], "m array<array<array<bigint>>>"), "m")
    assert sorted(tuple(r) for r in masks.from_cells(cells, 10, 20).collect()) == [(5, 20, 10), (6, 21, 10)]


@pytest.mark.parametrize("mismatch", [0, 1, 2, 3])
def test_resolution_against_search(spark, mismatch):
    rng = random.Random(mismatch)
    mask = {"".join(rng.choice("ACTG") for _ in range(6)): (i, i + 1) for i in range(60)}
    codes = list({"".join(rng.choice("ACTGN" if rng.random() < 0.3 else "ACTG") for _ in range(6)) for _ in range(120)} | set(list(mask)[:10]) | {"TTTTTT", "ACT"})
    spec = config.BarcodeSpec(length=6, mismatch=mismatch)
    dictionary = resolve.last_wins(spark.createDataFrame([(b, x, y, i) for i, (b, (x, y)) in enumerate(mask.items())], "barcode string, x long, y long, rec_no long"), spec)
    rows = spark.createDataFrame([(c if len(c) == 6 else None,) for c in codes], "barcode string")
    got = {r["barcode"]: (r["match_kind"], r["x"]) for r in resolve.resolve(rows, dictionary, spec).collect()}
    want = {}
    for c in codes:
        n = c.count("N")
        if len(c) < 6 or c == "TTTTTT" or n > 1 or n and not mismatch:
            continue
        apart = lambda a, b: sum(p != q for p, q in zip(a, b))
        if n:
            hits = [b for b in mask if apart(b, c) == 1]
            kind = "n"
        else:
            d = next((k for k in range(mismatch + 1) if any(apart(b, c) == k for b in mask)), None)
            hits = [b for b in mask if d is not None and apart(b, c) == d]
            kind = "exact" if d == 0 else f"mis{d}"
        if hits:
            want[c] = (kind, mask[hits[0]][0]) if len(hits) == 1 else ("ambiguous", None)
    assert got == want


def test_merge_stats_against_sequence(spark):
    rng = random.Random(4)
    rows = [(s, i, rng.randrange(12), rng.randrange(2), 0) for s in range(2) for i in range(40)]
    records = spark.createDataFrame(rows, "src int, rec_no long, bc long, x long, y long")
    held, lost, total, overlap, dup = {}, set(), 0, 0, 0
    for _, _, bc, x, _ in rows:
        total += 1
        if bc in lost:
            dup += 1
        elif bc not in held:
            held[bc] = x
        elif held[bc] == x:
            overlap += 1
        else:
            lost.add(bc)
            del held[bc]
            dup += 2
    assert tuple(masks.merge_stats(records).first()) == (total, overlap, dup, len(held))
    assert {r["bc"]: r["x"] for r in masks.kept(records).collect()} == held


def test_umi_collapse_against_sequence(spark):
    rng = random.Random(6)
    rows = [(g, 0, 0, u, rng.randrange(1, 9)) for g in range(25) for u in {"".join(rng.choice("ACTG") for _ in range(3)) for _ in range(rng.randrange(1, 16))}]
    counts = spark.createDataFrame(rows, "x long, y long, protein_index int, umi string, n long")
    got = Counter((r["x"], r["umi"], r["n"]) for r in protein.umi_collapse(spark, protein.umi_rank(counts), 3).collect())
    groups, want = defaultdict(list), Counter()
    for x, _, _, u, n in rows:
        groups[x].append([u, n])
    for x, members in groups.items():
        order = sorted(members, key=lambda m: (-m[1], -code(m[0])))
        gone = set()
        if len(order) >= 5:
            for i in range(len(order) - 1, 0, -1):
                for j in range(i):
                    if sum(a != b for a, b in zip(order[i][0], order[j][0])) <= 1:
                        order[j][1] += order[i][1]
                        gone.add(i)
                        break
        want.update((x, u, n) for i, (u, n) in enumerate(order) if i not in gone)
    assert got == want


def test_streams_equal_batch(spark, tmp_path):
    pairs, mask = view(spark, TABLES, "read_pairs").limit(400), view(spark, TABLES, "chip_mask")
    pairs.repartition(2).write.parquet(str(tmp_path / "in"))
    batch, spec = spark.read.parquet(str(tmp_path / "in")), config.RunSpec()
    want = mapping.map_pairs(batch, mask, spec)
    arriving = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    jobs.map_stream(arriving, mask, spec, str(tmp_path / "out"), str(tmp_path / "c1")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out")).drop("batch")
    assert Counter(map(str, out.select(*want.columns).collect())) == Counter(map(str, want.collect()))
    stored = spark.readStream.schema(out.schema).parquet(str(tmp_path / "out") + "/batch=*")
    jobs.count_table_stream(stored, str(tmp_path / "n"), str(tmp_path / "c3")).awaitTermination()
    assert Counter(map(tuple, jobs.latest_counts(spark, str(tmp_path / "n")).collect())) == Counter(map(tuple, mapping.position_counts(want).collect()))
    jobs.metric_stream(arriving, mask, spec, str(tmp_path / "m"), str(tmp_path / "c4")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "m")).count() > 1
    assert jobs.metric_totals(spark, str(tmp_path / "m")).collect() == mapping.run_metrics(batch, want).collect()
    jobs.count_stream(stored, "spots", str(tmp_path / "c2")).awaitTermination()
    assert Counter(map(tuple, spark.table("spots").collect())) == Counter(map(tuple, mapping.position_counts(want).collect()))


def test_metric_text(spark, tmp_path):
    """All lines of both modes in order, from counts that a plain loop makes; halves go up; of nothing there is no percent."""
    pair = lambda k, bar, quality, umi, second: (k, f"@r{k}", bar + umi, quality * 35, second, "I" * 15)
    bar, other, lost = "ACGTA" * 5, "CCGTA" * 5, "GGGGG" * 5
    rows = [pair(k, bar, "I", "ACGTACGTAC", "ACGTACGTACGTACG") for k in range(5)]
    rows += [pair(5, bar[:-1] + "C", "5", "ACGTNCGTAC", "T" * 15), pair(6, bar, "+", "A" * 10, "T" * 15), pair(7, lost, "!", "ACGTACGTAC", "T" * 15)]
    pairs = spark.createDataFrame(rows, "read_id long, name string, seq1 string, qual1 string, seq2 string, qual2 string")
    mask = spark.createDataFrame([(bar, 1, 2, 0, 0), (other, 3, 4, 0, 1)], "barcode string, x long, y long, src int, rec_no long")
    proteins = spark.createDataFrame([(1, "ACGTACGTACGTACG", "p")], "protein_index int, barcode string, protein_name string")
    spec = config.RunSpec(barcode=config.BarcodeSpec(mismatch=1), protein=config.ProteinSpec(mismatch=0))
    mapped = mapping.map_pairs(pairs, mask, spec)
    hits = protein.protein_reads(pairs, mask, proteins, spec)
    tables.write_metrics(tables.report_lines(protein.run_report(pairs, mapped, hits, spec)), str(tmp_path / "m"))
    want = """total_reads:\t8|fixed_sequence_contianing_reads:\t0\t0.00%|pass_filter_reads:\t8|mapped_reads:\t7\t87.50%
barcode_exactlyOverlap_reads:\t6\t75.00%|barcode_misOverlap_reads:\t1\t12.50%|barcode_withN_reads:\t0\t0.00%
Q10_bases_in_barcode:\t87.50%|Q20_bases_in_barcode:\t75.00%|Q30_bases_in_barcode:\t62.50%
Q10_bases_in_umi:\t100.00%|Q20_bases_in_umi:\t85.71%|Q30_bases_in_umi:\t71.43%
Q10_bases_in_reads:\t71.43%|Q20_bases_in_reads:\t71.43%|Q30_bases_in_reads:\t71.43%
umi_filter_reads:\t2\t25.00%|umi_with_N_reads:\t1\t12.50%|umi_with_polyA_reads:\t1\t12.50%
umi_with_low_quality_base_reads:\t0\t0.00%|mapped_proteinBarcode_reads:\t5\t100.00%"""
    want = want.replace("\n", "|").split("|")
    assert [r[0] for r in spark.read.text(str(tmp_path / "m")).collect()] == want
    nothing = pairs.limit(0)
    empty = mapping.run_report(nothing, mapping.map_pairs(nothing, mask, spec), spec)
    assert {r["pct"] for r in tables.report_lines(empty).collect()} == {None}


def test_queries_equal_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("orders", "lineitem", "events", "supplier"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{TABLES}/{t}.parquet'")
    for name in ("map_exact_counts", "mask_merge_stats", "merge_count_lists", "encode_decode", "fixed_filter_list", "text_functions"):
        found = entry_point.queries()[name](spark, TABLES)
        sql = con.execute(entry_point.oracle_sql()[name])
        names = [d[0] for d in sql.description]
        assert Counter(map(tuple, found.select(*names).collect())) == Counter(sql.fetchall()), name


def test_protein_collisions_cover_every_chip_barcode(spark):
    from spotweave import catalogue

    place = "/root/testdata/sf0.001"
    first = {}
    for r in catalogue._mask(spark, place).select("barcode", "rec_no").collect():
        first[r["barcode"]] = min(r["rec_no"], first.get(r["barcode"], r["rec_no"]))
    held = {}
    for code, k in first.items():
        for v in {code} | {code[:i] + b + code[i + 1 :] for i in range(25) for b in "ACTG"}:
            held.setdefault(v, []).append(k)
    want = {(v, min(k), max(k)) for v, k in held.items() if len(k) > 1}
    got = catalogue.queries()["protein_collisions"](spark, place).collect()
    assert len(got) == len(want) and set(map(tuple, got)) == want
    print(len(first), len(want))


def test_first_index_equals_its_definition(spark):
    """Also for names whose separators have too little after them; each text is searched once."""
    names = ["", "a", "@a:b", "@abc:", "@a:bc", "@a:b:cd+ef", "@a:b:cd+e", "@ab:cd+", "@:+ab", "@ab+cd:e", "x:a+b+cd", "x:ab\n+cd", "abcdef", "@a+bc:de+fg:h"]
    want = []
    for n in names:
        at = [k for k, c in enumerate(n) if c == ":" and len(n) - k > 2]
        rest = n[at[-1] + 1 :] if at and len(n) >= 5 else ""
        plus = rest.find("+")
        want.append(rest[:plus] if plus >= 0 and len(rest) - plus > 2 else rest)
    rows = spark.createDataFrame([(k, n) for k, n in enumerate(names)], "k int, n string")
    found = rows.select("k", R.first_index(F.col("n")).alias("i"))
    assert [r["i"] for r in found.orderBy("k").collect()] == want
    assert found._jdf.queryExecution().optimizedPlan().toString().count("regexp") == 1


def test_overlap_merge_of_many_lengths(spark):
    """Reads of unequal lengths and null reads in one batch; no array of letters is in the plan."""
    seq = "ACGTTGCAAGGTCCATACGTAGCTAGGATCCATTGCAACG"
    rows = [(k, seq[-k:], "I" * k, S.reverse_complement_text(seq[-k:]), "I" * k) for k in (29, 33, 36, 39)] + [(1, None, None, seq, "I" * 39), (2, "", "", "", "")]
    pairs = spark.createDataFrame(rows, "k int, seq1 string, qual1 string, seq2 string, qual2 string")
    merged = mapping.overlap_merge(pairs)
    assert {r["k"]: (r["merged_seq"], r["overlap"]) for r in merged.collect()} == {k: (seq[-k:], k) for k in (33, 36, 39)}
    assert "lambda" not in merged._jdf.queryExecution().optimizedPlan().toString()
