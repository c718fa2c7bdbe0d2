"""Registered queries that write and read files in the shared folder, and of the remaining column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave import catalogue as C
from spotweave.catalogue import query
from spotweave.config import BarcodeSpec, FixedSpec, RunSpec, UmiSpec
from spotweave.functions import reads as R
from spotweave.functions import sequence, text
from spotweave.operators import filters, mapping, masks, protein, resolve
from spotweave.plans.fixtures import view
from spotweave.sources import fastq, mask_binary, tables
from spotweave.storage import scratch
from spotweave.streaming import jobs

_W, _PAIRS = C._with, ["read_pairs"]
_SIDES = ("name", "seq1", "strand", "qual1", "name", "seq2", "strand", "qual2")


def _stranded(spark: SparkSession, d: str, kept: Column | None = None) -> DataFrame:
    return view(spark, d, "read_pairs", kept).withColumn("strand", F.lit("+"))


@query(_W(_PAIRS) + "SELECT name, seq2 AS seq, '+' AS strand, qual2 AS qual FROM read_pairs")
def fastq_scan(spark: SparkSession, d: str) -> DataFrame:
    """Second reads written as plain FASTQ and read back by splits."""
    path = scratch(spark, "fastq")
    fastq.write_reads(_stranded(spark, d), path, "name", "seq2", "strand", "qual2")
    return fastq.read_fastq(spark, path).select("name", "seq", "strand", "qual")


@query(_W(_PAIRS) + "SELECT name, substr(seq1, 1, 30) AS seq, substr(qual1, 1, 30) AS qual FROM read_pairs")
def fastq_gzip_scan(spark: SparkSession, d: str) -> DataFrame:
    """First reads, resized to 30 bases, written as gzip and read back."""
    path = scratch(spark, "fastq")
    short = _stranded(spark, d).withColumns({"s": R.resize(F.col("seq1"), 30), "q": R.resize(F.col("qual1"), 30)})
    fastq.write_reads(short, path, "name", "s", "strand", "q", "gzip")
    return fastq.read_fastq(spark, path).select("name", "seq", "qual")


@query(_W(_PAIRS) + "SELECT CAST(suppkey % 2 AS INT) AS lane, name AS name1, seq1, qual1, name AS name2, seq2, qual2 FROM read_pairs")
def fastq_lanes(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of two lanes, both sides written as gzip in the same order and met again by number."""
    lanes = []
    for k in (0, 1):
        sides = scratch(spark, "lane"), scratch(spark, "lane")
        fastq.write_pairs(_stranded(spark, d, F.col("suppkey") % 2 == k), *sides, _SIDES, "gzip")
        lanes.append(sides)
    return fastq.read_fastq_pairs(spark, lanes).select("lane", "name1", "seq1", "qual1", "name2", "seq2", "qual2")


@query(_W(_PAIRS) + "SELECT name AS name1, seq1, qual1, name AS name2, seq2, qual2 FROM read_pairs")
def fastq_interleaved(spark: SparkSession, d: str) -> DataFrame:
    """Pairs that alternate in one file."""
    path, p = scratch(spark, "interleaved"), F.concat_ws("\n", "name", "seq1", "strand", "qual1", "name", "seq2", "strand", "qual2")
    _stranded(spark, d).select(p.alias("value")).write.text(path)
    return fastq.read_interleaved(spark, path).select("name1", "seq1", "qual1", "name2", "seq2", "qual2")


@query(_W(_PAIRS) + "SELECT name, seq2 AS seq, '+' AS strand, repeat('K', length(seq2)) AS qual FROM read_pairs")
def fastq_without_quality(spark: SparkSession, d: str) -> DataFrame:
    """Records without qualities."""
    path = scratch(spark, "fastq")
    _stranded(spark, d).select(F.concat_ws("\n", "name", "seq2", "strand").alias("value")).write.text(path)
    return fastq.read_fastq(spark, path, has_quality=False).select("name", "seq", "strand", "qual")


@query(C._mapped_sql(1) + "SELECT name, seq2 AS seq, qual2 AS qual FROM mapped WHERE x IS NULL OR umi_fail IS NOT NULL")
def unmapped_single_file(spark: SparkSession, d: str) -> DataFrame:
    """Second reads of unmapped pairs, written and read back."""
    path = scratch(spark, "unmapped")
    fastq.write_unmapped(C._mapped(spark, d, 1).withColumn("strand", F.lit("+")), None, path)
    return fastq.read_fastq(spark, path).select("name", "seq", "qual")


@query(C._mapped_sql(1) + "SELECT name AS name1, seq1, name AS name2, seq2 FROM mapped WHERE x IS NULL OR umi_fail IS NOT NULL")
def unmapped_pair_files(spark: SparkSession, d: str) -> DataFrame:
    """Both reads of unmapped pairs, in two files of the same order."""
    sides = scratch(spark, "unmapped"), scratch(spark, "unmapped")
    fastq.write_unmapped(C._mapped(spark, d, 1, packed=True).withColumn("strand", F.lit("+")), *sides)
    return fastq.read_fastq_pairs(spark, [sides]).select("name1", "seq1", "name2", "seq2")


@query(C._mapped_sql(1) + f"SELECT {C._TAG} AS name, seq2 AS seq, qual2 AS qual FROM mapped WHERE x IS NOT NULL AND umi_fail IS NULL")
def mapped_file(spark: SparkSession, d: str) -> DataFrame:
    """Tagged second reads of the mapped output, written as gzip and read back."""
    path, s = scratch(spark, "mapped"), C.spec(1)
    out = mapping.tagged_single(C._mapped(spark, d, 1), s).filter("passed").withColumns({"strand": F.lit("+"), "tag": F.concat("tagged_name", F.lit(""))})
    fastq.write_reads(out, path, "tag", "seq2", "strand", "qual2", "gzip")
    return fastq.read_fastq(spark, path).select("name", "seq", "qual")


@query(_W(["chip_mask"]) + "SELECT barcode, x, y FROM chip_mask")
def mask_text_file(spark: SparkSession, d: str) -> DataFrame:
    """A mask as text and back."""
    path = scratch(spark, "mask")
    tables.write_mask_text(masks.coded(view(spark, d, "chip_mask")), path)
    return tables.read_mask_text(spark, path).select("barcode", "x", "y")


@query(_W(["chip_mask"]) + "SELECT barcode, x, y FROM chip_mask")
def mask_wide_text_file(spark: SparkSession, d: str) -> DataFrame:
    """A mask with five columns."""
    path = scratch(spark, "mask")
    view(spark, d, "chip_mask").select("barcode", F.lit("a").alias("a"), F.lit("b").alias("b"), "x", "y").write.csv(path, sep="\t")
    return tables.read_mask_text(spark, path).select("barcode", "x", "y")


@query(_W(["chip_mask"]) + f"SELECT {C._CODE} AS bc, x, y FROM chip_mask")
def mask_binary_file(spark: SparkSession, d: str) -> DataFrame:
    """A mask as 16-byte records and back."""
    path = scratch(spark, "mask")
    mask_binary.write_mask_binary(masks.coded(view(spark, d, "chip_mask")), path)
    return mask_binary.read_mask_binary(spark, path).select("bc", "x", "y")


@query(C._U + "SELECT CAST(min(y) AS INT) AS row_offset, CAST(min(x) AS INT) AS col_offset, 25 AS barcode_length, 500 AS pitch FROM u")
def mask_cell_header(spark: SparkSession, d: str) -> DataFrame:
    """What stands beside the dense cells."""
    return masks.cell_header(C._records(spark, d))


@query(_W(["barcode_list"]) + "SELECT x, y, CAST(sum(n) AS BIGINT) AS n FROM barcode_list GROUP BY x, y")
def count_files(spark: SparkSession, d: str) -> DataFrame:
    """Three count lists as files, read and summed."""
    lists, paths = view(spark, d, "barcode_list"), []
    for k in range(3):
        paths.append(scratch(spark, "counts"))
        tables.write_counts(lists.filter(F.col("file_no") == k), paths[-1])
    read = [tables.read_counts(spark, p) for p in paths]
    return masks.merge_counts(read[0].unionByName(read[1]).unionByName(read[2]))


@query(_W(["protein_list"]) + "SELECT protein_index, barcode, protein_name FROM protein_list")
def protein_list_file(spark: SparkSession, d: str) -> DataFrame:
    """A protein list as a file."""
    path = scratch(spark, "proteins")
    view(spark, d, "protein_list").select("protein_index", "barcode", "protein_name").write.csv(path, sep="\t")
    return tables.read_proteins(spark, path)


@query(_W(["protein_list", "read_pairs"]) + "SELECT read_id FROM read_pairs WHERE list_bool_or(list_transform((SELECT list(struct_pack(b := substr(barcode, 1, 4), s := protein_index * 7)) FROM protein_list), lambda z: z.s + 4 <= 50 AND position(z.b IN seq1) = z.s + 1))")
def fixed_list_file(spark: SparkSession, d: str) -> DataFrame:
    """Pairs with a fixed sequence of a list that is read from a file."""
    path = scratch(spark, "fixed")
    lines = view(spark, d, "protein_list").select(F.concat_ws(" ", F.substring("barcode", 1, 4), (F.col("protein_index") * 7).cast("string")).alias("value"))
    lines.write.text(path)
    found = filters.fixed_spec(tables.read_fixed(spark, path), 50)
    return view(spark, d, "read_pairs").filter(filters.has_fixed(found, F.col("seq1"))).select("read_id")


@query(C._collapse_sql() + "SELECT protein_name AS geneID, x, y, count(*) AS MIDCount FROM col JOIN protein_list l ON col.protein_index = l.protein_index GROUP BY protein_name, x, y")
def gem_file(spark: SparkSession, d: str) -> DataFrame:
    """The count matrix as a file with a header."""
    path = scratch(spark, "gem")
    tables.write_gem(protein.gem(C._collapsed(spark, d), view(spark, d, "protein_list")), path)
    return spark.read.csv(path, sep="\t", header=True, schema="geneID string, x long, y long, MIDCount long")


@query(C._collapse_sql() + "SELECT y, x, protein_index, umi, n FROM col")
def gem_raw_file(spark: SparkSession, d: str) -> DataFrame:
    """The raw matrix as a file without a header, y before x."""
    path = scratch(spark, "gem")
    tables.write_gem_raw(protein.gem_raw(C._collapsed(spark, d)), path)
    return spark.read.csv(path, sep="\t", schema="y long, x long, protein_index int, umi string, n long")


def _line_sql(source: str, protein: bool = False) -> str:
    """SQL of the lines of a metrics text from a one-row table of counters and bases."""

    def line(name: str, count: str, whole: str | None = None) -> str:
        pct = f"CASE WHEN {whole} > 0 THEN chr(9) || printf('%.2f%%', ((CAST({count} AS BIGINT) * 20000 + {whole}) // ({whole} * 2)) / 100.0) ELSE '' END" if whole else "''"
        shown = "" if name.startswith("Q") else f", chr(9), {count}"
        return f"SELECT concat('{name}:'{shown}, {pct}) AS value FROM {source}"

    found = [line("total_reads", "total_reads"), line("fixed_sequence_contianing_reads", "total_reads - pass_filter", "total_reads"), line("pass_filter_reads", "pass_filter")]
    names = {"mapped_reads": "mapped", "barcode_exactlyOverlap_reads": "exact", "barcode_misOverlap_reads": "mismatched", "barcode_withN_reads": "with_n"}
    names |= {"umi_filter_reads": "umi_filtered", "umi_with_N_reads": "umi_n", "umi_with_polyA_reads": "umi_poly_a", "umi_with_low_quality_base_reads": "umi_low_quality"}
    found += [line(n, c, "pass_filter") for n, c in names.items()]
    bases = {"barcode": ("barcode", "(pass_filter * 25)"), "umi": ("umi", "(mapped * 10)")} | ({"reads": ("protein", "(mapped * 15)")} if protein else {})
    found += [line(f"{q.upper()}_bases_in_{n}", f"{c}_{q}", whole) for n, (c, whole) in bases.items() for q in R.QUALITY]
    if protein:
        found.append(line("mapped_proteinBarcode_reads", "protein", "(mapped - umi_filtered)"))
    return " UNION ALL ".join(found).replace("total_reads - pass_filter", "(total_reads - pass_filter)")


_PASSED = f"position('{C.FIXED}' IN seq1) = 0 AND position('CTGAGAGGCA' IN seq1) = 0"


@query(C._mapped_sql(1).rstrip() + ",\n" + C._METRICS + f",\nq AS (SELECT {C._SUMS} FROM mapped WHERE {_PASSED}), report AS (SELECT * FROM counts, q)\n" + _line_sql("report"))
def metrics_file(spark: SparkSession, d: str) -> DataFrame:
    """Counters, percentages and qualities of a run as text."""
    pairs, s, path = view(spark, d, "read_pairs"), C.spec(1, ((C.FIXED, -1),)), scratch(spark, "metrics")
    row = mapping.run_report(pairs, mapping.map_pairs(pairs, C.index(spark, d), s), s)
    tables.write_metrics(tables.report_lines(row), path)
    return spark.read.text(path)


_PROTEIN_ROWS = f"""cut AS (SELECT *, substr(seq1,1,25) AS barcode, substr(qual1,1,25) AS bar_qual, substr(seq1,26,10) AS umi, substr(qual1,26,10) AS umi_qual FROM protein_read_pairs),
mapped AS (SELECT cut.*, s.x, CASE WHEN s.x IS NOT NULL THEN {C._FAIL} END AS umi_fail FROM cut LEFT JOIN spot_mask s ON cut.barcode = s.barcode)"""
_PROTEIN_REPORT = f"""report AS (SELECT (SELECT count(*) FROM protein_read_pairs) AS total_reads, count(*) AS pass_filter, count(x) AS mapped, count(x) AS exact, 0 AS mismatched, 0 AS with_n,
 count(umi_fail) AS umi_filtered, count(*) FILTER (umi_fail = 'n') AS umi_n, count(*) FILTER (umi_fail = 'poly_a') AS umi_poly_a, count(*) FILTER (umi_fail = 'low_quality') AS umi_low_quality,
 {C._SUMS}, {", ".join(f"sum(CASE WHEN x IS NOT NULL AND umi_fail IS NULL THEN {C._count_ge('substr(qual2,1,15)', f)} ELSE 0 END) AS protein_{q}" for q, f in R.QUALITY.items())},
 (SELECT count(*) FROM hits) AS protein FROM mapped)
"""


@query(_W(C._P, C._PR, C._HITS, _PROTEIN_ROWS, _PROTEIN_REPORT) + _line_sql("report", True))
def protein_metrics_file(spark: SparkSession, d: str) -> DataFrame:
    """The text of a run in protein mode."""
    pairs, path = view(spark, d, "protein_read_pairs"), scratch(spark, "metrics")
    mapped = mapping.map_pairs(pairs, view(spark, d, "spot_mask"), C.PROTEIN)
    tables.write_metrics(tables.report_lines(protein.run_report(pairs, mapped, C._hits(spark, d), C.PROTEIN)), path)
    return spark.read.text(path)


@query(
    C.ORACLES["mask_merge_stats"].replace("SELECT CAST(sum(n) AS BIGINT) AS total", "SELECT unnest([struct_pack(m := 'total', v := t.total), struct_pack(m := 'overlap', v := t.overlap), struct_pack(m := 'dup', v := t.dup), struct_pack(m := 'unique_barcodes', v := t.unique_barcodes)]) AS z FROM (SELECT CAST(sum(n) AS BIGINT) AS total")
    + " ) t"
)
def merge_report(spark: SparkSession, d: str) -> DataFrame:
    """Numbers of the merge, a row each."""
    numbers, _ = tables.merge_report(masks.merge_stats(C._records(spark, d)), ["a", "b"])
    return numbers.select("metric", F.col("value").cast("long").alias("value"))


C.ORACLES["merge_report"] = "SELECT z.m AS metric, z.v AS value FROM (" + C.ORACLES["merge_report"] + ") q"


@query(
    _W(C._P, C._PR, C._HITS, f"c AS (SELECT count(*) AS mapped, count({C._FAIL}) AS umi_failed, (SELECT count(*) FROM hits) AS protein FROM pr JOIN spot_mask s ON pr.barcode = s.barcode)")
    + f"SELECT *, {C._pct('protein', '(mapped - umi_failed)')} AS protein_pct FROM c"
)
def protein_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Pairs with a protein, of mapped pairs whose identifier passes."""
    mapped = mapping.map_pairs(view(spark, d, "protein_read_pairs"), view(spark, d, "spot_mask"), C.PROTEIN)
    return protein.protein_metrics(C._hits(spark, d), mapped)


_RC_CODE = C._CODE.replace("substr(barcode,", "substr(rc,")


@query(_W(["chip_mask"], "r AS (SELECT barcode, reverse(translate(barcode, 'ACGT', 'TGCA')) AS rc FROM chip_mask)") + f"SELECT barcode, {_RC_CODE} AS code FROM r")
def reverse_complement_codes(spark: SparkSession, d: str) -> DataFrame:
    """Codes of reversed complements."""
    return view(spark, d, "chip_mask").select("barcode", sequence.encode_reverse_complement("barcode").alias("code"))


@query(_W(_PAIRS) + "SELECT read_id, substr(seq1, CAST(suppkey % 60 AS INT) + 1) AS front, substr(seq1, 1, CAST(suppkey % 60 AS INT)) AS back, substr(qual1, 1, 17) AS sized FROM read_pairs")
def trims(spark: SparkSession, d: str) -> DataFrame:
    """Reads trimmed in front and behind, also beyond their length."""
    by = [(n, R.trim_front(F.col("seq1"), n), R.trim_back(F.col("seq1"), n)) for n in range(60)]
    pick = lambda k: F.coalesce(*[F.when(F.col("suppkey") % 60 == row[0], row[k]) for row in by])
    return view(spark, d, "read_pairs").select("read_id", pick(1).alias("front"), pick(2).alias("back"), R.resize(F.col("qual1"), 17).alias("sized"))


def _trimmed(spark: SparkSession, d: str, spec: RunSpec) -> DataFrame:
    s1, s2 = R.pair_trims(spec.barcode, spec.umi, F.col("seq1"), F.col("seq2"))
    return view(spark, d, "read_pairs").select("read_id", s1.alias("out1"), s2.alias("out2"))


@query(_W(_PAIRS) + "SELECT read_id, substr(seq1, 26) AS out1, seq2 AS out2 FROM read_pairs")
def pair_trims_without_umi(spark: SparkSession, d: str) -> DataFrame:
    """Pairs without an identifier: the barcode's read loses its front."""
    return _trimmed(spark, d, RunSpec(umi=UmiSpec(start=-1)))


@query(_W(_PAIRS) + "SELECT read_id, seq1 AS out1, substr(seq2, 1, 20) AS out2 FROM read_pairs")
def pair_trims_second_umi(spark: SparkSession, d: str) -> DataFrame:
    """Barcode and identifier on the second read: it is cut where the barcode starts."""
    return _trimmed(spark, d, RunSpec(barcode=BarcodeSpec(start=20, read=2), umi=UmiSpec(start=50, read=2)))


_SI = "CASE WHEN n > 1000000000000 THEN printf('%.6f T', n / 1e12) WHEN n > 1000000000 THEN printf('%.6f G', n / 1e9) WHEN n > 1000000 THEN printf('%.6f M', n / 1e6) WHEN n > 1000 THEN printf('%.6f K', n / 1e3) ELSE printf('%.6f', CAST(n AS DOUBLE)) END"


@query(_W(["chip_mask"], "m AS (SELECT rec_no, CASE WHEN rec_no % 3 = 0 THEN rec_no % 1000 ELSE (rec_no % 1000000000) * 1000 END AS n FROM chip_mask)") + f"SELECT rec_no, {_SI} AS si, format('{{:,}}', n) AS commas FROM m")
def number_texts(spark: SparkSession, d: str) -> DataFrame:
    """Numbers with units and with commas."""
    n = F.when(F.col("rec_no") % 3 == 0, F.col("rec_no") % 1000).otherwise((F.col("rec_no") % 1000000000) * 1000)
    return view(spark, d, "chip_mask").select("rec_no", text.si_number(n).alias("si"), text.thousands(n).alias("commas"))


_PLACES = "lpad(CAST(x % 1000 AS VARCHAR), 3, '0') AS c, lpad(CAST(y % 1000 AS VARCHAR), 3, '0') AS r, lpad(CAST(rec_no % 100000000 AS VARCHAR), 8, '0') AS s"


@query(
    _W(["chip_mask"], f"m AS (SELECT *, {_PLACES} FROM chip_mask)")
    + "SELECT rec_no, CAST(rec_no % 100000000 AS INT) AS spot, CAST(x % 1000 AS INT) AS col, CAST(y % 1000 AS INT) AS \"row\", CAST(rec_no AS VARCHAR) AS lined, substr(concat(barcode, '@x'), 1, 26) AS held, true AS short FROM m"
)
def name_parts(spark: SparkSession, d: str) -> DataFrame:
    """Places and barcodes in names, both layouts."""
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    c, r = pad(F.col("x") % 1000, 3), pad(F.col("y") % 1000, 3)
    fixed = R.name_position(F.concat(F.lit("@L1C"), c, F.lit("R"), r, pad(F.col("rec_no") % 100000000, 8)))
    lined = R.name_position(F.concat(F.lit("@L1C"), c, F.lit("R"), r, F.lit("_"), F.col("rec_no").cast("string")), underscore=True)
    held, short = R.name_barcode(F.concat(F.lit("@"), F.col("barcode"), F.lit("@x")), 26)
    return view(spark, d, "chip_mask").select(
        "rec_no", fixed[0].alias("spot"), lined[1].alias("col"), fixed[2].alias("row"), lined[0].cast("string").alias("lined"), held.alias("held"), short.alias("short")
    )


@query(_W(["protein_list"]) + "SELECT protein_index, 45 AS near1, 990 AS near2, CAST(715827882 AS BIGINT) AS poly_t FROM protein_list")
def neighbour_counts(spark: SparkSession, d: str) -> DataFrame:
    """How many sequences lie around each protein barcode, counted, and the code of as many T."""
    around = lambda k: F.size(F.array_distinct(F.concat(*[sequence.neighbours(sequence.encode("barcode"), 15, j) for j in range(1, k + 1)])))
    return view(spark, d, "protein_list").select("protein_index", around(1).alias("near1"), around(2).alias("near2"), F.lit(sequence.poly_t(15)).cast("long").alias("poly_t"))


@query(_W(["read_pairs", "chip_mask"], *C._resolution(2)) + "SELECT barcode, match_kind, mb AS matched, x, y FROM res")
def map_k2_by_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """Neighbours at two substitutions by pairs of four blocks, the cut for large masks, whatever this mask's measure says."""
    s = C.spec(2)
    cut, mask = mapping.sliced(view(spark, d, "read_pairs"), s), C.index(spark, d).dictionary()
    blocks = lambda k: resolve.measured(spark, mask, s.barcode.length, k, 2 * k)
    found = resolve.resolve(resolve.distinct_barcodes(cut), mask, s.barcode, blocks)
    return found.select("barcode", "match_kind", sequence.decode("bc", 25).alias("matched"), "x", "y")


@query(C._collapse_sql() + "SELECT read_id, x, y, protein_index, umi FROM hits")
def protein_reads_ignore_fixed(spark: SparkSession, d: str) -> DataFrame:
    """In protein mode fixed sequences drop nothing."""
    s = RunSpec(protein=C.PROTEIN.protein, fixed=FixedSpec(((C.FIXED, -1),)))
    return protein.protein_reads(view(spark, d, "protein_read_pairs"), view(spark, d, "spot_mask"), view(spark, d, "protein_list"), s)


_CUT = "CASE WHEN suppkey % 5 = 0 THEN substr(qual2, 2) ELSE qual2 END"


@query(_W(_PAIRS) + f"SELECT name, suppkey % 5 = 0 AS malformed, length({_CUT}) AS kept FROM read_pairs")
def fastq_malformed(spark: SparkSession, d: str) -> DataFrame:
    """Records whose qualities are too short, marked."""
    path = scratch(spark, "fastq")
    cut = F.when(F.col("suppkey") % 5 == 0, F.substring("qual2", 2, 1 << 30)).otherwise(F.col("qual2"))
    fastq.write_reads(_stranded(spark, d).withColumn("q", cut), path, "name", "seq2", "strand", "q")
    found = fastq.checked(fastq.read_fastq(spark, path), "PERMISSIVE")
    return found.select("name", "malformed", F.length("qual").cast("long").alias("kept"))


@query(_W(["chip_mask"]) + "SELECT rec_no, (x % 65536) * 65536 + y % 65536 AS code, x % 65536 AS x, y % 65536 AS y FROM chip_mask")
def field_codes(spark: SparkSession, d: str) -> DataFrame:
    """Packed pairs of 16 bits, and what they hold."""
    code = sequence.pack_fields(F.col("x") % 65536, F.col("y") % 65536)
    x, y = sequence.unpack_fields(code)
    return view(spark, d, "chip_mask").select("rec_no", code.alias("code"), x.alias("x"), y.alias("y"))


#: Pairs of an arriving file at most.
ARRIVING = 1_000_000


def _arriving(spark: SparkSession, d: str) -> DataFrame:
    """What mapping reads of the read pairs, as a stream of files (four at least) that are written where pairs are derived; a batch takes half of them.

    With more pairs there are more files, not longer ones, so what a task writes or reads doesn't grow.
    """
    path, pairs = scratch(spark, "arriving"), view(spark, d, "read_pairs").select("seq1", "qual1", "seq2", "qual2")
    longest = min(ARRIVING, max(1, -(-pairs.count() // 4)))
    pairs.write.option("maxRecordsPerFile", longest).option("compression", "zstd").parquet(path)
    files = len(spark.read.parquet(path).inputFiles())
    return spark.readStream.schema(pairs.schema).option("maxFilesPerTrigger", max(1, -(-files // 2))).parquet(path)


@query(C.ORACLES["map_exact_counts"])
def stream_counts(spark: SparkSession, d: str) -> DataFrame:
    """Reads of each position, mapped and counted as files of pairs arrive."""
    out, counts = scratch(spark, "stream"), scratch(spark, "stream")
    mask, pairs = C.index(spark, d), _arriving(spark, d)
    jobs.map_stream(pairs, mask, C.spec(), out, scratch(spark, "log"), keep=["x", "y"]).awaitTermination()
    mapped = spark.readStream.schema(spark.read.parquet(out).drop("batch").schema).parquet(f"{out}/batch=*")
    jobs.count_table_stream(mapped, counts, scratch(spark, "log")).awaitTermination()
    return jobs.latest_counts(spark, counts)


@query(C.ORACLES["run_metrics"].replace(C._mapped_sql(2).rstrip(), C._mapped_sql(0).rstrip()))
def stream_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Counters and percentages of a run whose pairs arrive as files."""
    path = scratch(spark, "metrics")
    jobs.metric_stream(_arriving(spark, d), C.index(spark, d), C.spec(0, ((C.FIXED, -1),)), path, scratch(spark, "log")).awaitTermination()
    return jobs.metric_totals(spark, path)
