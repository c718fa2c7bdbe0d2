"""Barcode resolution: exact, then unique nearest match, or one wildcard base.

All of it works on distinct barcodes, so a barcode that many reads share is one row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.config import BarcodeSpec
from spotweave.functions import sequence
from spotweave.operators import filters
from spotweave.storage import intermediates, stored


def last_wins(mask: DataFrame, spec: BarcodeSpec) -> DataFrame:
    """A mask as a dictionary ``bc``, ``x``, ``y``: of a barcode's records the last (``rec_no``) counts."""
    part = F.substring("barcode", spec.start + 1, spec.length)
    coded = mask.withColumn("bc", sequence.encode(part)) if "bc" not in mask.columns else mask
    order = [c for c in ("src", "rec_no") if c in mask.columns]
    if not order:
        return coded.groupBy("bc").agg(F.max(F.struct("x", "y")).alias("p")).select("bc", "p.*")
    last = F.max_by(F.struct("x", "y"), F.struct(*order))
    return coded.groupBy("bc").agg(last.alias("p")).select("bc", "p.*")


def distinct_barcodes(reads: DataFrame) -> DataFrame:
    """The distinct values of ``barcode``."""
    return reads.select("barcode").distinct()


def _unique(hits: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """From (barcode, bc, x, y): barcodes with one hit, and those with any."""
    counted = hits.groupBy("barcode").agg(F.count("*").alias("n"), F.min(F.struct("bc", "x", "y")).alias("hit"))
    one = counted.filter("n = 1").select("barcode", F.lit(kind).alias("match_kind"), "hit.bc", "hit.x", "hit.y")
    return one, counted.select("barcode", "n")


def exact(codes: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Barcodes (``barcode``, ``code``) that the dictionary has."""
    hits = codes.join(dictionary, codes.code == dictionary.bc)
    return hits.select("barcode", F.lit("exact").alias("match_kind"), "bc", "x", "y")


#: Comparisons of two codes that take as long as one row of a shuffle.
ROW_WORK = 20
#: Mask rows with one piece that are met in a task.
CROWD = 20_000


def block_masks(length: int, distance: int, scheme: str, blocks: int) -> list[int]:
    """Bit masks of all sets of ``blocks`` - ``distance`` blocks of a code; within the distance one of the sets agrees.

    Blocks are runs of bases or every so manieth base. More blocks make more sets, each of more bases.
    """
    place = {"runs": lambda i: i * blocks // length, "strides": lambda i: i % blocks}[scheme]
    single = [sum(3 << 2 * i for i in range(length) if place(i) == k) for k in range(blocks)]
    return [sum(kept) for kept in combinations(single, blocks - distance)]


def piece_masks(length: int, distance: int, scheme: str) -> list[int]:
    """Bit masks that cut a code into ``distance`` + 1 pieces, one of which agrees within the distance."""
    return block_masks(length, distance, scheme, distance + 1)


def _pieces(code: str, masks: list[int]) -> Column:
    return F.posexplode(F.array(*[F.col(code).bitwiseAND(F.lit(m)) for m in masks]))


@dataclass(frozen=True)
class Cut:
    """How codes are cut into pieces: the masks, and the pieces that many mask rows have (``part``, ``value``, ``deals``)."""

    masks: list[int]
    crowds: DataFrame


def measured(spark: SparkSession, dictionary: DataFrame, length: int, distance: int, blocks: int | None = None) -> Cut:
    """The cut that takes the least work in this dictionary: the rows to shuffle, and the codes that share a piece.

    It begins with ``distance`` + 1 pieces (or ``blocks``), in the scheme whose pieces are shared least. While a code would meet more others than
    the rows of one more block are worth, there is one more block, so in a mask of any size few codes meet.
    Pieces of more than CROWD rows are to be dealt to several tasks. Frequencies are counted by Spark, over the whole dictionary.
    """
    schemes, blocks, rows = ["runs", "strides"], blocks or distance + 1, dictionary.count()
    while True:
        cuts = [block_masks(length, distance, x, blocks) for x in schemes]
        parts = [dictionary.select(F.lit(k).alias("scheme"), _pieces("bc", x).alias("part", "value")) for k, x in enumerate(cuts)]
        counts = reduce(DataFrame.union, parts).groupBy("scheme", "part", "value").agg(F.count("*").cast("double").alias("n"))
        counts = stored(spark, counts.filter("n > 1"), "piece-counts")
        met = {r["scheme"]: r["w"] / rows for r in counts.groupBy("scheme").agg(F.sum(F.col("n") * (F.col("n") - 1)).alias("w")).collect()}
        best = min(range(len(schemes)), key=lambda k: met.get(k, 0))
        if blocks == length or met.get(best, 0) <= ROW_WORK * (comb(blocks + 1, distance) - comb(blocks, distance)):
            break
        schemes, blocks = [schemes[best]], blocks + 1
    crowds = counts.filter((F.col("scheme") == best) & (F.col("n") > CROWD)).select("part", "value", F.ceil(F.col("n") / CROWD).cast("int").alias("deals"))
    return Cut(cuts[best], stored(spark, crowds, "piece-crowds"))


def nearest(spark: SparkSession, codes: DataFrame, dictionary: DataFrame, length: int, mismatch: int, cut: Callable[[int], Cut] | None = None) -> tuple[DataFrame, DataFrame]:
    """Of barcodes without an exact match: the unique nearest, and the ambiguous ones.

    Distances rise one at a time; a distance with several hits ends the search as ambiguous. The hits of a distance are stored.
    Codes and dictionary are cut into pieces one of which must agree, and those that share a piece are
    compared; no neighbour is spelt out. ``cut`` gives the cut for a distance, where it is known already.
    """
    left, levels = stored(spark, codes.select("code").distinct(), "resolve-codes"), []
    for d in range(1, mismatch + 1):
        hits = pigeonhole(left, dictionary, d, cut(d) if cut else measured(spark, dictionary, length, d))
        counted = stored(spark, hits.groupBy("code").agg(F.count("*").alias("n"), F.min("bc").alias("bc")), "resolve-hits")
        levels.append(counted.withColumn("match_kind", F.lit(f"mis{d}")))
        left = left.join(counted, "code", "left_anti")
    every = codes.join(reduce(DataFrame.unionByName, levels), "code")
    found = every.filter("n = 1").join(dictionary, "bc").select("barcode", "match_kind", "bc", "x", "y")
    return found, every.filter("n > 1").select("barcode", F.col("match_kind").alias("at"))


def pigeonhole(codes: DataFrame, dictionary: DataFrame, distance: int, cut: Cut, least: int | None = None) -> DataFrame:
    """Pairs (``code``, ``bc``) at exactly ``distance``, or at ``least`` to ``distance``, by equal pieces; each pair is kept at its first equal piece.

    Mask rows of a crowded piece are dealt by their code; a code with it goes to each deal.
    """
    a = codes.select("code", _pieces("code", cut.masks).alias("part", "value"))
    b = dictionary.select("bc", _pieces("bc", cut.masks).alias("part", "value"))
    key = ["part", "value", "deal"]
    deals = F.coalesce("deals", F.lit(1))
    a = a.join(cut.crowds, key[:2], "left").withColumn("deal", F.explode(F.sequence(F.lit(0), deals - 1))).drop("deals")
    b = b.join(cut.crowds, key[:2], "left").withColumn("deal", F.pmod(F.xxhash64("bc"), deals).cast("int")).drop("deals")
    pairs = a.join(b, key).filter(sequence.hamming("code", "bc").between(distance if least is None else least, distance))
    other = F.col("code").bitwiseXOR(F.col("bc"))
    first = F.lit(len(cut.masks))
    for k in range(len(cut.masks) - 1, -1, -1):
        first = F.when(other.bitwiseAND(F.lit(cut.masks[k])) == 0, k).otherwise(first)
    return pairs.filter(F.col("part") == first).select("code", "bc")


def wildcard(codes: DataFrame, dictionary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Barcodes with one N: those for which one base gives a match, and those for which several do."""
    tries = codes.select("barcode", F.explode(sequence.wildcard("barcode")).alias("t")).withColumn("near", sequence.encode("t"))
    one, any_ = _unique(tries.join(dictionary, tries.near == dictionary.bc).select("barcode", "bc", "x", "y"), "n")
    return one, any_.filter("n > 1").select("barcode", F.lit("n").alias("at"))


def resolve(barcodes: DataFrame, dictionary: DataFrame, spec: BarcodeSpec, cut: Callable[[int], Cut] | None = None) -> DataFrame:
    """A row for each of the distinct barcodes that has a match or is ambiguous.

    ``cut``: how codes are cut for a distance (``nearest``), of a dictionary that is stored already; by default it is measured. All cuts give the
    same rows. With a tolerance the barcodes, the dictionary, each level's hits and the
    result are stored, so that none of it is planned or computed again.

    ``barcode``, ``match_kind`` (exact, mis1, mis2, mis3, n, ambiguous), ``bc``, ``x``, ``y``; the
    last three are null for the ambiguous.
    """
    spark = barcodes.sparkSession
    usable = barcodes.filter(filters.unmappable(F.col("barcode"), spec).isNull())
    if not spec.mismatch:
        plain = usable.filter(sequence.n_count("barcode") == 0).withColumn("code", sequence.encode("barcode"))
        return exact(plain, dictionary)
    with intermediates(spark, keep=1):
        dictionary = dictionary if cut else stored(spark, dictionary, "resolve-dictionary", "lz4")
        coded = usable.withColumn("wild", sequence.n_count("barcode")).withColumn("code", F.when(F.col("wild") == 0, sequence.encode("barcode")))
        met = coded.join(dictionary, coded.code == dictionary.bc, "left").select("barcode", "wild", "code", "bc", "x", "y")
        met = stored(spark, met, "resolve-exact", "lz4")
        hit = met.filter("bc is not null").select("barcode", F.lit("exact").alias("match_kind"), "bc", "x", "y")
        rest = met.filter("bc is null and wild = 0").select("barcode", "code")
        near, unclear = nearest(spark, rest, dictionary, spec.length, spec.mismatch, cut)
        wild, several = wildcard(met.filter("wild = 1").select("barcode"), dictionary)
        no = F.lit(None).cast("long")
        lost = unclear.unionByName(several).select("barcode", F.lit("ambiguous").alias("match_kind"), no.alias("bc"), no.alias("x"), no.alias("y"))
        return stored(spark, hit.unionByName(near).unionByName(wild).unionByName(lost), "resolve-result", "lz4")
