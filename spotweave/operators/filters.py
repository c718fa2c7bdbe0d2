"""Read filters: fixed sequences, barcodes that can't match, identifiers of low quality."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotweave.config import BarcodeSpec, FixedSpec, UmiSpec
from spotweave.functions import reads, sequence


def has_fixed(spec: FixedSpec, seq: Column) -> Column:
    """Whether a read holds a fixed sequence: anywhere on either strand, or first at exactly its start."""
    tests = []
    for text, start in spec.sequences:
        if start < 0:
            tests += [seq.contains(text), seq.contains(sequence.reverse_complement_text(text))]
        else:
            tests.append(F.instr(seq, text) == start + 1)
    return F.coalesce(reduce(or_, tests), F.lit(False)) if tests else F.lit(False)


def fixed_spec(rows: DataFrame, length: int) -> FixedSpec:
    """A spec from a table (``seq``, ``start``); rows that don't fit in ``length`` bases are left out.

    The table is a short list of settings and becomes part of the plan.
    """
    kept = rows.filter(F.col("start") + F.length("seq") <= length)
    return FixedSpec(tuple((r["seq"], r["start"]) for r in kept.select("seq", "start").collect()))


def umi_fail(mid: Column, quality: Column, spec: UmiSpec) -> Column:
    """Why an identifier fails: ``n``, ``poly_a``, ``low_quality``; null if it passes or there is none."""
    if not spec.enabled:
        return F.lit(None).cast("string")
    weak = F.length(quality) - reads.at_least(quality, reads.QUALITY["q10"])
    return (
        F.when(mid.contains("N"), "n").when(mid == F.lit("A" * spec.length), "poly_a").when(weak > 1, "low_quality")
    )


def unmappable(code: Column, spec: BarcodeSpec) -> Column:
    """Why a barcode isn't looked up: ``short_read``, ``poly_t``, ``many_n``, ``one_n`` (without tolerance); null if it is."""
    n = sequence.n_count(code)
    return (
        F.when(code.isNull(), "short_read")
        .when(code == F.lit("T" * spec.length), "poly_t")
        .when(n > 1, "many_n")
        .when((n == 1) & F.lit(spec.mismatch == 0), "one_n")
    )
