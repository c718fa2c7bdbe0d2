"""Chip masks (barcode to position): merging, conversion, cells, statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spotweave.functions import sequence

#: Fixed value: distance of two spots.
PITCH = 500


def coded(mask: DataFrame, length: int = 25, start: int = 0) -> DataFrame:
    """A mask with ``bc``, the code of its barcode."""
    return mask.withColumn("bc", sequence.encode(F.substring("barcode", start + 1, length)))


def union(*parts: DataFrame) -> DataFrame:
    """Masks one after another, with ``src`` as their number."""
    marked = [p.withColumn("src", F.lit(i)) for i, p in enumerate(parts)]
    return reduce(lambda a, b: a.unionByName(b), marked)


def kept(records: DataFrame) -> DataFrame:
    """Barcodes all of whose records have one position: ``bc``, ``x``, ``y``."""
    at = F.struct("x", "y")
    one = records.groupBy("bc").agg(F.min(at).alias("p"), F.max(at).alias("q"))
    return one.filter("p = q").select("bc", "p.*")


def conflicts(records: DataFrame) -> DataFrame:
    """Barcodes with several positions."""
    at = F.struct("x", "y")
    return records.groupBy("bc").agg(F.min(at).alias("p"), F.max(at).alias("q")).filter("p <> q").select("bc")


def merge_stats(records: DataFrame) -> DataFrame:
    """One row: ``total``, ``overlap``, ``dup``, ``unique_barcodes`` of records in input order (``src``, ``rec_no``).

    Of a barcode with n records whose first m share the first position, m - 1 overlap; if others
    follow they and the first are duplicates, else the barcode is unique.
    """
    order = Window.partitionBy("bc").orderBy("src", "rec_no")
    first = F.first(F.struct("x", "y")).over(order)
    other = F.max((F.struct("x", "y") != first).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    runs = records.withColumn("late", other).groupBy("bc").agg(F.count("*").alias("n"), F.count_if(F.col("late") == 0).alias("m"))
    return runs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.col("m") - 1), F.lit(0)).alias("overlap"),
        F.coalesce(F.sum(F.when(F.col("m") < F.col("n"), F.col("n") - F.col("m") + 1).otherwise(0)), F.lit(0)).alias("dup"),
        F.count_if(F.col("m") == F.col("n")).alias("unique_barcodes"),
    )


def slide_range(mask: DataFrame) -> DataFrame:
    """One row: ``col_start``, ``col_end``, ``row_start``, ``row_end``."""
    return mask.agg(F.min("x").alias("col_start"), F.max("x").alias("col_end"), F.min("y").alias("row_start"), F.max("y").alias("row_end"))


def barcode_types(records: DataFrame) -> DataFrame:
    """Number of distinct barcodes."""
    return records.select("bc").distinct().agg(F.count("*").alias("barcode_types"))


def singletons(records: DataFrame) -> DataFrame:
    """Barcodes with exactly one record: ``bc``, ``x``, ``y``."""
    found = records.groupBy("bc").agg(F.count("*").alias("n"), F.min(F.struct("x", "y")).alias("p"))
    return found.filter("n = 1").select("bc", "p.*")


def singleton_stats(records: DataFrame) -> DataFrame:
    """One row: ``total``, ``dup`` (records of repeated barcodes), ``types``, ``unique_types``."""
    n = records.groupBy("bc").agg(F.count("*").alias("n"))
    return n.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("dup"),
        F.count("*").alias("types"),
        F.count_if(F.col("n") == 1).alias("unique_types"),
    )


def cells(mask: DataFrame, segment: int = 1) -> DataFrame:
    """Dense matrix cells ``row``, ``col``, ``seg``, ``bc``, rebased to the slide range; of a cell's barcodes the ``segment`` lowest."""
    order = Window.partitionBy("x", "y").orderBy("bc")
    ranked = mask.withColumn("seg", F.row_number().over(order) - 1).filter(F.col("seg") < segment)
    header = slide_range(mask)  # one row
    return ranked.join(F.broadcast(header)).select(
        (F.col("y") - F.col("row_start")).cast("int").alias("row"), (F.col("x") - F.col("col_start")).cast("int").alias("col"), F.col("seg").cast("int").alias("seg"), "bc"
    )


def cell_header(mask: DataFrame, length: int = 25, pitch: int = PITCH) -> DataFrame:
    """One row beside ``cells``: ``row_offset``, ``col_offset``, ``barcode_length``, ``pitch``."""
    return slide_range(mask).select(
        F.col("row_start").cast("int").alias("row_offset"), F.col("col_start").cast("int").alias("col_offset"), F.lit(length).alias("barcode_length"), F.lit(pitch).alias("pitch")
    )


def from_cells(table: DataFrame, row_offset: int = 0, col_offset: int = 0) -> DataFrame:
    """Mask rows ``bc``, ``x``, ``y`` of the cells that aren't empty."""
    return table.filter("bc <> 0").select("bc", (F.col("col") + col_offset).cast("long").alias("x"), (F.col("row") + row_offset).cast("long").alias("y"))


def from_matrix(matrix: DataFrame, column: str) -> DataFrame:
    """Cells of an array [row][col][segment]."""
    rows = matrix.select(F.posexplode(column).alias("row", "r"))
    cols = rows.select("row", F.posexplode("r").alias("col", "c"))
    return cols.select("row", "col", F.posexplode("c").alias("seg", "bc"))


def merge_counts(lists: DataFrame) -> DataFrame:
    """Count lists summed by position."""
    return lists.groupBy("x", "y").agg(F.sum("n").alias("n"))
