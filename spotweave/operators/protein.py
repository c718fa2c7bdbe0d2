"""Protein-by-position matrices: tolerant protein barcodes, identifier collapse, counts."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spotweave.config import FixedSpec, ProteinSpec, RunSpec
from spotweave.functions import reads as R
from spotweave.functions import sequence
from spotweave.operators import mapping, resolve
from spotweave.storage import intermediates, stored

#: Fixed value: groups with fewer distinct identifiers aren't collapsed.
LEAST_UMIS = 5


def expand(proteins: DataFrame, spec: ProteinSpec) -> DataFrame:
    """Every sequence within the tolerance of a protein's barcode: ``variant`` (code), ``protein_index``."""
    base = proteins.select("protein_index", sequence.encode(F.substring("barcode", 1, spec.length)).alias("code"))
    out = base.select(F.col("code").alias("variant"), "protein_index")
    for k in range(1, spec.mismatch + 1):
        out = out.union(base.select(F.explode(sequence.neighbours("code", spec.length, k)).alias("variant"), "protein_index"))
    return out


def collisions(proteins: DataFrame, spec: ProteinSpec) -> DataFrame:
    """Variants reached from several proteins: a list with any can't be used.

    Two barcodes share a variant only if they differ in no more than twice the tolerance. Such pairs are found by
    equal pieces, and only variants that both of a pair reach are spelt out.
    """
    spark, k = proteins.sparkSession, spec.mismatch
    base = proteins.select("protein_index", sequence.encode(F.substring("barcode", 1, spec.length)).alias("bc"))
    base = stored(spark, base.groupBy("bc").agg(F.min("protein_index").alias("low"), F.max("protein_index").alias("high")), "protein-codes")
    own = base.filter("low <> high")  # one code of several proteins: all of its variants
    around = lambda c: F.concat(F.array(F.col(c)), *[sequence.neighbours(c, spec.length, j) for j in range(1, k + 1)])
    reached = own.select(F.explode(around("bc")).alias("variant"), F.col("low").alias("a"), F.col("high").alias("b"))
    codes = base.filter("bc is not null").select("bc")
    if k:
        pairs = resolve.pigeonhole(codes.withColumnRenamed("bc", "code"), codes, 2 * k, resolve.measured(spark, codes, spec.length, 2 * k), least=1)
        # each pair comes in both orders, so the variants of one side are enough
        shared = F.filter(around("code"), lambda v: sequence.hamming(v, F.col("bc")) <= k)
        met = pairs.withColumn("variant", F.explode(shared)).join(base.select(F.col("bc").alias("code"), "low", "high"), "code")
        reached = reached.unionByName(met.select("variant", F.col("low").alias("a"), F.col("high").alias("b")))
    found = reached.groupBy("variant").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    return found.filter("a <> b").select("variant", "a", "b")


def checked(proteins: DataFrame, spec: ProteinSpec) -> DataFrame:
    """``expand``, or an error if proteins are too close to each other."""
    clash = collisions(proteins, spec).limit(1).collect()
    if clash:
        raise ValueError(f"proteins {clash[0]['a']} and {clash[0]['b']} share a sequence within {spec.mismatch} mismatches")
    return expand(proteins, spec)


def without_fixed(spec: RunSpec) -> RunSpec:
    """The run of protein mode, where fixed sequences drop no pairs unless ``fixed_in_protein`` asks for it."""
    return spec if spec.fixed_in_protein else replace(spec, fixed=FixedSpec())


def protein_reads(pairs: DataFrame, mask: DataFrame, proteins: DataFrame, spec: RunSpec) -> DataFrame:
    """Mapped pairs whose identifier passes and whose second read names a protein: ``read_id``, ``x``, ``y``, ``protein_index``, ``umi``."""
    spark, p = pairs.sparkSession, spec.protein
    # stored, so that Spark knows how few a list and its variants are, whatever they come from, and broadcasts them if they are below its limit
    proteins = stored(spark, proteins.select("protein_index", "barcode"), "proteins")
    variants = checked(proteins, p).withColumn("variant", sequence.decode("variant", p.length))
    variants = stored(spark, variants, "protein-variants")
    second = R.cut_second(F.col("seq2"), spec.umi)
    # before the mapping, which then carries no more of the read
    cut = pairs.withColumn("variant", sequence.canonical(R.piece(second, p.start, p.length), p.length))
    found = mapping.map_pairs(cut, mask, without_fixed(spec)).filter("passed").join(variants, "variant")
    return found.select(*[c for c in ("read_id",) if c in found.columns], "x", "y", "protein_index", "umi")


def umi_counts(hits: DataFrame) -> DataFrame:
    """Reads of each identifier: ``x``, ``y``, ``protein_index``, ``umi``, ``n``."""
    return hits.groupBy("x", "y", "protein_index", "umi").agg(F.count("*").alias("n"))


GROUP = ["x", "y", "protein_index"]


def umi_rank(counts: DataFrame) -> DataFrame:
    """Identifiers of a group by count, then code, both falling: ``rank`` from 1; ``umi_code``."""
    coded = counts.withColumn("umi_code", sequence.encode("umi"))
    order = Window.partitionBy(*GROUP).orderBy(F.col("n").desc(), F.col("umi_code").desc())
    return coded.withColumn("rank", F.row_number().over(order))


def umi_parents(ranked: DataFrame, length: int) -> DataFrame:
    """``ranked`` with ``parent``: the best rank above the own one within one substitution; null for survivors.

    Only groups with LEAST_UMIS identifiers or more are collapsed. Neighbours meet by an equal
    join on group and code, so a group's pairs are never all formed.
    """
    big = ranked.withColumn("size", F.count("*").over(Window.partitionBy(*GROUP)))
    tries = big.filter(F.col("size") >= LEAST_UMIS).select(*GROUP, "umi_code", "rank", F.explode(sequence.neighbours("umi_code", length, 1)).alias("near"))
    above = ranked.select(*GROUP, F.col("umi_code").alias("near"), F.col("rank").alias("above"))
    met = tries.join(above, [*GROUP, "near"]).filter("above < rank").groupBy(*GROUP, "umi_code").agg(F.min("above").alias("parent"))
    return ranked.join(met, [*GROUP, "umi_code"], "left")


def umi_collapse(spark: SparkSession, ranked: DataFrame, length: int) -> DataFrame:
    """Survivors with the reads of all identifiers that merge into them: ``x``, ``y``, ``protein_index``, ``umi``, ``umi_code``, ``n``.

    Roots are found by pointer jumping over the identifiers that have a parent: the depth of a tree
    is halved in each round, and identifiers that have reached their root leave the loop.
    """
    with intermediates(spark, keep=1):
        # the ranks are read three times, and what they come from is a whole run
        ranked = stored(spark, ranked, "umi")
        ranked = stored(spark, umi_parents(ranked, length), "umi")
        edges = ranked.filter("parent is not null").select(*GROUP, "rank", F.col("parent").alias("root"))
        moving, settled = stored(spark, edges, "umi"), []
        while moving.limit(1).count():  # ends, for a parent's rank is below its child's
            step = moving.join(moving.select(*GROUP, F.col("rank").alias("root"), F.col("root").alias("next")), [*GROUP, "root"], "left")
            final = F.when(F.col("next").isNull(), F.col("root"))
            if settled:
                done = reduce(DataFrame.unionByName, settled).select(*GROUP, F.col("rank").alias("root"), F.col("root").alias("known"))
                step, final = step.join(done, [*GROUP, "root"], "left"), F.coalesce(F.col("known"), final)
            step = stored(spark, step.select(*GROUP, "rank", "next", final.alias("final")), "umi")
            settled.append(step.filter("final is not null").select(*GROUP, "rank", F.col("final").alias("root")))
            moving = step.filter("final is null").select(*GROUP, "rank", F.col("next").alias("root"))
        roots = reduce(DataFrame.unionByName, settled) if settled else edges
        placed = ranked.join(roots, [*GROUP, "rank"], "left").withColumn("root", F.coalesce("root", "rank"))
        own = F.col("rank") == F.col("root")
        found = placed.groupBy(*GROUP, "root").agg(F.max(F.when(own, F.col("umi"))).alias("umi"), F.max(F.when(own, F.col("umi_code"))).alias("umi_code"), F.sum("n").alias("n")).drop("root")
        return stored(spark, found, "umi")


def gem(collapsed: DataFrame, proteins: DataFrame) -> DataFrame:
    """Identifiers of each protein and position: ``geneID``, ``x``, ``y``, ``MIDCount``."""
    names = proteins.select("protein_index", F.col("protein_name").alias("geneID"))
    counted = collapsed.groupBy(*GROUP).agg(F.count("*").alias("MIDCount"))
    return counted.join(names, "protein_index").select("geneID", "x", "y", "MIDCount")


def gem_raw(collapsed: DataFrame) -> DataFrame:
    """A row for each surviving identifier, in the order of the raw file: y before x."""
    return collapsed.select("y", "x", "protein_index", "umi_code", "n")


def duplication(collapsed: DataFrame) -> DataFrame:
    """One row: ``unique_reads``, ``total_reads``, ``duplication_pct``."""
    row = collapsed.agg(F.count("*").alias("unique_reads"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_reads"))
    rate: Column = F.round((1 - F.try_divide(F.col("unique_reads").cast("double"), F.col("total_reads"))) * 100, 4)
    return row.withColumn("duplication_pct", rate)


def protein_metrics(hits: DataFrame, mapped: DataFrame) -> DataFrame:
    """One row: ``mapped``, ``umi_failed``, ``protein`` (pairs with a protein) and its percent of mapped pairs whose identifier passes."""
    row = mapped.agg(F.count_if(F.col("x").isNotNull()).alias("mapped"), F.count_if(F.col("umi_fail").isNotNull()).alias("umi_failed"))
    row = row.crossJoin(hits.agg(F.count("*").alias("protein")))  # one row each
    return row.withColumn("protein_pct", mapping.share(F.col("protein"), F.col("mapped") - F.col("umi_failed")))


def protein_quality(hits: DataFrame, mapped: DataFrame, spec: ProteinSpec) -> DataFrame:
    """One row: quality percentages of protein barcodes of passing pairs, over the bases of mapped pairs."""
    row = mapped.agg(F.count_if(F.col("x").isNotNull()).alias("mapped"), *_quality_sums(spec))
    return row.select("*", *[mapping.share(F.col(f"protein_{k}"), F.col("mapped") * spec.length).alias(f"protein_{k}_pct") for k in R.QUALITY])


def _quality_sums(spec: ProteinSpec) -> list[Column]:
    cut = F.substring("qual2", spec.start + 1, spec.length)
    return [F.coalesce(F.sum(F.when(F.col("passed"), R.at_least(cut, q))), F.lit(0)).alias(f"protein_{k}") for k, q in R.QUALITY.items()]


def run_report(pairs: DataFrame, mapped: DataFrame, hits: DataFrame, spec: RunSpec) -> DataFrame:
    """``mapping.run_report`` of protein mode, with the pairs that have a protein and the bases of protein barcodes."""
    row = mapping.run_report(pairs, mapped, spec, *_quality_sums(spec.protein))
    row = row.crossJoin(hits.agg(F.count("*").alias("protein")))  # one row each
    return row.withColumns({"protein_bases": F.col("mapped") * spec.protein.length, "protein_of": F.col("mapped") - F.col("umi_filtered")})
