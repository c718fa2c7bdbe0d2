"""Readers and writers of masks, count lists, protein lists, fixed sequences and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spotweave.functions import reads as R
from spotweave.functions import sequence


def ordered_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines of text paths: ``src`` (which path), ``rec_no`` (the line's place in all files of the path, by name), ``value``.

    Files are split among tasks. Lines of a split are counted where they are; where a split starts follows from the
    counts of those before it (one row for each split).
    """
    parts = [spark.read.text(p).select(F.lit(k).alias("src"), "value", F.input_file_name().alias("file"), F.input_file_block_start().alias("block")) for k, p in enumerate(paths)]
    lines = reduce(DataFrame.unionAll, parts).withColumn("mark", F.monotonically_increasing_id())
    splits = lines.groupBy("src", "file", "block").agg(F.count("*").alias("n"), F.min("mark").alias("first"))
    before = Window.partitionBy("src").orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("src", "file", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return lines.join(starts, ["src", "file", "block"]).select("src", (F.col("mark") + F.col("shift")).alias("rec_no"), "value")


def read_mask_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Tab-separated masks, barcode, x, y; with five columns or more x and y are the fourth and fifth. Other rows are dropped.

    Several paths are masks one after another: ``src`` is a mask's number, ``rec_no`` a line's place in it, so that "the last wins" follows
    the input, whatever the sizes of files and splits.
    """
    parts = F.split("value", "\t")
    wide = F.size(parts) >= 5
    lines = ordered_lines(spark, [path] if isinstance(path, str) else path).filter((F.size(parts) == 3) | wide)
    x, y = (F.when(wide, F.get(parts, F.lit(k + 3))).otherwise(F.get(parts, F.lit(k + 1))) for k in (0, 1))
    typed = lines.select(F.get(parts, F.lit(0)).alias("barcode"), x.try_cast("long").alias("x"), y.try_cast("long").alias("y"), "src", "rec_no")
    return typed.filter("x is not null and y is not null")


def write_mask_text(mask: DataFrame, path: str, length: int = 25) -> None:
    """Barcode, x, y, tab-separated."""
    out = mask.select(F.concat_ws("\t", sequence.decode("bc", length), F.col("x").cast("string"), F.col("y").cast("string")).alias("value"))
    out.write.text(path)


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """Count lists, ``x y count`` between whitespace."""
    p = F.split(F.trim("value"), r"\s+")
    lines = spark.read.text(path).filter(F.size(p) >= 3)
    return lines.select(*[F.get(p, F.lit(i)).try_cast("long").alias(n) for i, n in enumerate(("x", "y", "n"))]).dropna()


def write_counts(counts: DataFrame, path: str) -> None:
    """``x``, ``y``, ``n``, tab-separated."""
    counts.select("x", "y", "n").write.csv(path, sep="\t")


def read_proteins(spark: SparkSession, path: str) -> DataFrame:
    """Protein lists: index, barcode, name, tab-separated; short rows are dropped."""
    schema = "protein_index int, barcode string, protein_name string"
    return spark.read.csv(path, sep="\t", schema=schema, mode="DROPMALFORMED").dropna()


def read_fixed(spark: SparkSession, path: str) -> DataFrame:
    """Fixed sequences: sequence and start between whitespace."""
    p = F.split(F.trim("value"), r"\s+")
    lines = spark.read.text(path).filter(F.size(p) >= 2)
    return lines.select(p[0].alias("seq"), F.get(p, F.lit(1)).try_cast("int").alias("start")).dropna()


def write_gem(gem: DataFrame, path: str) -> None:
    """Matrix with a header."""
    gem.select("geneID", "x", "y", "MIDCount").write.csv(path, sep="\t", header=True)


def write_gem_raw(raw: DataFrame, path: str, length: int = 10) -> None:
    """Surviving identifiers without a header, y before x."""
    raw.select("y", "x", "protein_index", sequence.decode("umi_code", length).alias("umi"), "n").write.csv(path, sep="\t")


def metric_lines(row: DataFrame) -> DataFrame:
    """A one-row table of counters as ``metric``, ``value``, ``pct``: percentages (``<metric>_pct``) stand beside their counter."""
    names = [c for c in row.columns if not c.endswith("_pct")]
    pct = lambda n: F.col(f"{n}_pct") if f"{n}_pct" in row.columns else F.lit(None)
    lines = [F.struct(F.lit(n).alias("metric"), F.col(n).cast("long").alias("value"), pct(n).cast("double").alias("pct")) for n in names]
    return row.select(F.explode(F.array(*lines)).alias("m")).select("m.*")


#: Lines of a run's metrics text in order: name, count, and what its percent refers to.
_READS = (
    ("total_reads", "total_reads", None),
    ("fixed_sequence_contianing_reads", "fixed_filtered", "total_reads"),
    ("pass_filter_reads", "pass_filter", None),
    ("mapped_reads", "mapped", "pass_filter"),
    ("barcode_exactlyOverlap_reads", "exact", "pass_filter"),
    ("barcode_misOverlap_reads", "mismatched", "pass_filter"),
    ("barcode_withN_reads", "with_n", "pass_filter"),
)
_IDENTIFIERS = (
    ("umi_filter_reads", "umi_filtered", "pass_filter"),
    ("umi_with_N_reads", "umi_n", "pass_filter"),
    ("umi_with_polyA_reads", "umi_poly_a", "pass_filter"),
    ("umi_with_low_quality_base_reads", "umi_low_quality", "pass_filter"),
)
_PROTEIN = ("mapped_proteinBarcode_reads", "protein", "protein_of")
_BASES = {"barcode": "barcode", "umi": "umi", "protein": "reads"}


def report_lines(row: DataFrame) -> DataFrame:
    """The row of ``run_report`` (of either mode) as ``metric``, ``value``, ``pct``, in the order of the text.

    Lines of qualities have a percent only. Percentages have two decimals, computed in whole numbers (halves go
    up); of nothing there is none.
    """

    def percent(part: str, whole: str):
        return F.when(F.col(whole) > 0, F.expr(f"({part} * 20000 + {whole}) div ({whole} * 2)")) / 100

    def line(name: str, count: str, whole: str | None):
        return name, F.col(count), percent(count, whole) if whole else F.lit(None)

    protein = "protein" in row.columns
    qualities = [
        (f"{q.upper()}_bases_in_{_BASES[c]}", F.lit(None), percent(f"{c}_{q}", f"{c}_bases"))
        for c in (_BASES if protein else ("barcode", "umi"))
        for q in R.QUALITY
    ]
    lines = [*[line(*x) for x in _READS], *qualities, *[line(*x) for x in (*_IDENTIFIERS, *([_PROTEIN] if protein else []))]]
    parts = [F.struct(F.lit(m).alias("metric"), v.cast("long").alias("value"), p.cast("double").alias("pct")) for m, v, p in lines]
    return row.select(F.explode(F.array(*parts)).alias("m")).select("m.*")


def write_metrics(rows: DataFrame, path: str) -> None:
    """``metric:``, value and, where there is one, percent with two decimals, tab-separated."""
    parts = [F.concat("metric", F.lit(":")), F.col("value").cast("string")]
    if "pct" in rows.columns:
        parts.append(F.format_string("%.2f%%", F.col("pct")))
        parts[-1] = F.when(F.col("pct").isNotNull(), parts[-1])
    rows.select(F.concat_ws("\t", *parts).alias("value")).write.text(path)


def merge_report(stats: DataFrame, files: list[str]) -> tuple[DataFrame, DataFrame]:
    """The numbers of a mask merge and its numbered input files."""
    names = ["total", "overlap", "dup", "unique_barcodes"]
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])
    spark = stats.sparkSession
    return stats.select(F.explode(pairs).alias("m")).select("m.*"), spark.createDataFrame(list(enumerate(files, 1)), "idx int, file string")
