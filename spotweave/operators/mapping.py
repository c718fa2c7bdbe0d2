"""Mapping read pairs to positions, and what is counted and written of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import ArrowUDFType

from spotweave.config import RunSpec
from spotweave.functions import packing, sequence
from spotweave.functions import reads as R
from spotweave.operators import filters, resolve
from spotweave.operators.mask_index import MaskIndex


def sliced(pairs: DataFrame, spec: RunSpec) -> DataFrame:
    """Read pairs with ``barcode``, ``bar_qual``, ``umi``, ``umi_qual``, ``fixed_hit`` and ``reason`` (why the barcode isn't looked up)."""
    out = pairs.withColumns(
        {
            "barcode": R.barcode(spec.barcode),
            "bar_qual": R.barcode_quality(spec.barcode),
            "umi": R.umi(spec.umi),
            "umi_qual": R.umi_quality(spec.umi),
            "fixed_hit": filters.has_fixed(spec.fixed, F.col("seq1")),
        }
    )
    return out.withColumns({"reason": filters.unmappable(F.col("barcode"), spec.barcode), "seq2": R.cut_second(F.col("seq2"), spec.umi), "qual2": R.cut_second(F.col("qual2"), spec.umi)})


#: Reads as they are written for mapped pairs.
_WRITTEN = ("out_seq1", "out_qual1", "out_seq2", "out_qual2")


def map_pairs(pairs: DataFrame, mask: DataFrame | MaskIndex, spec: RunSpec, trimmed: bool = False, packed: bool = False) -> DataFrame:
    """Read pairs past the fixed filter, with ``x``, ``y``, ``match_kind``, ``umi_fail`` and ``passed``.

    A stored index in the place of a mask isn't shuffled, and keeps what has been resolved for later calls. Without either
    an index or a tolerance, reads meet the mask's dictionary itself.
    Unmapped pairs have a null position. ``passed`` pairs go to the mapped output: those with
    a position whose identifier doesn't fail.

    Reads move to what is resolved, with the columns that are read later. With ``trimmed`` they are cut before, into the
    columns of ``tagged_pairs``, so that of a read that is cut away nothing moves. With ``packed`` they move in
    fewer bytes (``packing``), which takes some microseconds a pair; for those who read whole pairs.
    """
    cut = sliced(pairs, spec).filter(~F.col("fixed_hit"))
    if trimmed:
        cut = _trimmed(cut, spec)
    usable = F.col("reason").isNull()
    # what can't match is dealt over many keys, so it can't crowd into one task, and reads are computed once for all
    spread = F.concat(F.lit("!"), F.pmod(F.monotonically_increasing_id(), F.lit(1 << 16)).cast("string"))
    if spec.barcode.mismatch or isinstance(mask, MaskIndex):
        barcodes = resolve.distinct_barcodes(cut.filter(usable))
        if isinstance(mask, MaskIndex):
            found = mask.resolved(barcodes, spec.barcode)
        else:
            found = resolve.resolve(barcodes, resolve.last_wins(mask, spec.barcode), spec.barcode)
        found = found.withColumnRenamed("barcode", "_found")
        key = F.col("barcode")
    else:
        # an exact match is one join of the reads with the dictionary, so they aren't computed for their distinct barcodes first;
        # it is by text, for few reads need a code then
        # (a code of a longer barcode has no text of this length)
        n = spec.barcode.length
        text = F.when(F.col("bc").between(0, 4**n - 1), sequence.decode("bc", n))
        found = resolve.last_wins(mask, spec.barcode).select(text.alias("_found"), F.lit("exact").alias("match_kind"), "bc", "x", "y")
        key = sequence.canonical("barcode", n)
    keyed = cut.withColumn("_key", F.when(usable, key).otherwise(spread))
    fail, texts = filters.umi_fail(F.col("umi"), F.col("umi_qual"), spec.umi), []
    if packed:
        texts = [c for c in ("name", "seq1", "qual1", "seq2", "qual2", *_WRITTEN) if c in keyed.columns]
        same = lambda c: packing.packed(F.col(c), "ACGT")  # noqa: E731  (equal keys are equal bytes)
        # why an identifier fails is a short text or none, so it moves in the place of the identifier
        keyed = keyed.withColumns({"_key": same("_key"), "_fail": fail, **{c: packing.packed(F.col(c)) for c in texts}})
        found, fail = found.withColumn("_found", same("_found")), F.col("_fail")
    both = keyed.join(found, (F.col("_key") == F.col("_found")) & usable, "left").drop("_key", "_found")
    mapped = F.col("x").isNotNull()
    both = both.withColumns({"umi_fail": F.when(mapped, fail), **{c: packing.unpacked(F.col(c)) for c in texts}}).drop("_fail")
    return both.withColumn("passed", mapped & F.col("umi_fail").isNull())


def tagged_single(mapped: DataFrame, spec: RunSpec) -> DataFrame:
    """The second read of pairs with a position, tagged."""
    hit = mapped.filter(F.col("x").isNotNull())
    name = R.tagged(F.col("name"), F.col("x"), F.col("y"), F.col("umi"), F.col("umi_qual"), spec.umi.enabled)
    return hit.withColumn("tagged_name", name)


def tagged_pairs(mapped: DataFrame, spec: RunSpec) -> DataFrame:
    """Both reads of pairs with a position, tagged and trimmed: ``out_seq1``, ``out_qual1``, ``out_seq2``, ``out_qual2``."""
    hit = tagged_single(mapped, spec)
    return hit if set(_WRITTEN) <= set(hit.columns) else _trimmed(hit, spec)


def _trimmed(pairs: DataFrame, spec: RunSpec) -> DataFrame:
    s1, s2 = R.pair_trims(spec.barcode, spec.umi, F.col("seq1"), F.col("seq2"))
    q1, q2 = R.pair_trims(spec.barcode, spec.umi, F.col("qual1"), F.col("qual2"))
    return pairs.withColumns(dict(zip(_WRITTEN, (s1, q1, s2, q2), strict=True)))


def position_counts(mapped: DataFrame) -> DataFrame:
    """Reads of each position, those with a failing identifier included: ``x``, ``y``, ``n``."""
    return mapped.filter(F.col("x").isNotNull()).groupBy("x", "y").agg(F.count("*").alias("n"))


def mapped_spots(mapped: DataFrame) -> DataFrame:
    """Number of distinct positions."""
    return position_counts(mapped).agg(F.count("*").alias("mapped_dnbs"))


def barcode_histogram(counts: DataFrame) -> DataFrame:
    """For each number of reads of a position: reads at such positions."""
    return counts.groupBy("n").agg((F.col("n") * F.count("*")).alias("reads"))


def share(part: Column, whole: Column) -> Column:
    """Percent with four decimals, null of nothing."""
    return F.round(F.try_divide(part.cast("double") * 100, whole.cast("double")), 4)


def run_counters(pairs: DataFrame, mapped: DataFrame) -> DataFrame:
    """One row of counters. ``pairs`` are all pairs, ``mapped`` those past the fixed filter."""
    total = pairs.agg(F.count("*").alias("total_reads"))
    return total.crossJoin(mapped.agg(*_counters()))  # one row each


def _counters() -> list[Column]:
    kind = lambda *k: F.count_if(F.col("match_kind").isin(*k) & F.col("x").isNotNull())
    return [
        F.count("*").alias("pass_filter"),
        F.count_if(F.col("x").isNotNull()).alias("mapped"),
        kind("exact").alias("exact"),
        kind("mis1", "mis2", "mis3").alias("mismatched"),
        kind("n").alias("with_n"),
        F.count_if(F.col("umi_fail") == "n").alias("umi_n"),
        F.count_if(F.col("umi_fail") == "poly_a").alias("umi_poly_a"),
        F.count_if(F.col("umi_fail") == "low_quality").alias("umi_low_quality"),
    ]


def with_percentages(counters: DataFrame) -> DataFrame:
    """Counters with ``fixed_filtered``, ``umi_filtered`` (all failing identifiers) and their percentages, of all reads or of those past the filter."""
    row = _summed(counters)
    passed = ("mapped", "exact", "mismatched", "with_n", "umi_filtered", "umi_n", "umi_poly_a", "umi_low_quality")
    shares = {f"{c}_pct": share(F.col(c), F.col("pass_filter")) for c in passed}
    return row.withColumns({"fixed_pct": share(F.col("fixed_filtered"), F.col("total_reads")), **shares})


def _summed(counters: DataFrame) -> DataFrame:
    failed = F.col("umi_n") + F.col("umi_poly_a") + F.col("umi_low_quality")
    return counters.withColumns({"fixed_filtered": F.col("total_reads") - F.col("pass_filter"), "umi_filtered": failed})


def run_metrics(pairs: DataFrame, mapped: DataFrame) -> DataFrame:
    """One row of counters and percentages. ``pairs`` are all pairs, ``mapped`` those past the fixed filter."""
    return with_percentages(run_counters(pairs, mapped))


def quality_metrics(mapped: DataFrame, spec: RunSpec) -> DataFrame:
    """One row: percent of bases of quality 10, 20, 30 in barcodes (of pairs past the filter) and identifiers (of mapped pairs)."""
    sums = _quality_sums()
    row = mapped.agg(F.count("*").alias("reads"), F.count_if(F.col("x").isNotNull()).alias("mapped"), *[v.alias(k) for k, v in sums.items()])
    bases = {"barcode": F.col("reads") * spec.barcode.length, "umi": F.col("mapped") * max(spec.umi.length, 0)}
    return row.select("reads", "mapped", *[x for k in sums for x in (k, share(F.col(k), bases[k.split("_")[0]]).alias(f"{k}_pct"))])


def _quality_sums() -> dict[str, Column]:
    sums = {}
    for q, first in R.QUALITY.items():
        sums[f"barcode_{q}"] = F.coalesce(F.sum(R.at_least(F.col("bar_qual"), first)), F.lit(0))
        sums[f"umi_{q}"] = F.coalesce(F.sum(F.when(F.col("x").isNotNull(), R.at_least(F.col("umi_qual"), first))), F.lit(0))
    return sums


def run_report(pairs: DataFrame, mapped: DataFrame, spec: RunSpec, *more: Column) -> DataFrame:
    """One row of all that the text of a run's metrics needs: counters and the bases of each quality.

    ``mapped`` is read once, ``more`` are further aggregates of it. ``barcode_bases`` and ``umi_bases`` are what
    percentages of qualities refer to.
    """
    counted = mapped.agg(*_counters(), *[v.alias(k) for k, v in _quality_sums().items()], *more)
    row = _summed(pairs.agg(F.count("*").alias("total_reads")).crossJoin(counted))  # one row each
    bases = {"barcode_bases": F.col("pass_filter") * spec.barcode.length, "umi_bases": F.col("mapped") * max(spec.umi.length, 0)}
    return row.withColumns(bases)


#: Complement of bases as bytes; what isn't a base becomes N.
_COMPLEMENT = bytes(ord(dict(zip("ACGT", "TGCA", strict=True)).get(chr(k).upper(), "N")) for k in range(256))


def _overlaps(least: int):
    """Function of Arrow columns seq1, seq2, qual1, qual2: structs of a pair's merged read, null where ends don't overlap."""
    complement = _COMPLEMENT

    def merged(seq1, seq2, qual1, qual2):
        import numpy as np
        import pyarrow as pa

        sides = [[(x or "").encode("latin-1", "replace") for x in c.to_pylist()] for c in (seq1, seq2, qual1, qual2)]
        sizes = [np.array([len(x) for x in c], np.int64) for c in sides]
        rows, width = len(seq1), int(max(sizes[0].max(initial=0), sizes[1].max(initial=0), 1))

        def placed(k: int, first, step: int = 1):
            """Characters of a side in a matrix: the first of a row in column ``first``, others ``step`` further on."""
            if (sizes[k] == width).all():  # reads of one length fill it
                return np.frombuffer(b"".join(sides[k]), np.uint8).reshape(rows, width)[:, ::step]
            row = np.repeat(np.arange(rows), sizes[k])
            place = np.arange(len(row)) - np.repeat(np.cumsum(sizes[k]) - sizes[k], sizes[k])
            column = first[row] + step * place
            kept = (column >= 0) & (column < width)
            out = np.zeros((rows, width), np.uint8)
            out[row[kept], column[kept]] = np.frombuffer(b"".join(sides[k]), np.uint8)[kept]
            return out

        # first reads end in the last column, second ones, reversed and complemented, begin in the first
        a, p = placed(0, width - sizes[0]), placed(2, width - sizes[0])
        b, q = np.frombuffer(complement, np.uint8)[placed(1, sizes[1] - 1, -1)], placed(3, sizes[3] - 1, -1)
        high, low = ord("?"), ord("0")
        valid = [c.is_valid().to_numpy(zero_copy_only=False) for c in (seq1, seq2, qual1, qual2)]
        open_, most = valid[0] & valid[1] & valid[2] & valid[3], np.minimum(sizes[0], sizes[1])
        out: list[list] = [[None] * rows for _ in range(4)]
        for o in range(least, int(most.max(initial=0)) + 1):
            head = min(o, 16)
            begin = a[:, width - o : width - o + head] != b[:, :head]
            tried = np.flatnonzero(open_ & (most >= o) & (np.count_nonzero(begin, axis=1) < 3))
            apart = a[tried, width - o :] != b[tried, :o]
            few = np.count_nonzero(apart, axis=1) < 3
            tried, apart = tried[few], apart[few]
            if not len(tried):
                continue
            x, y, u, v = a[tried, width - o :], b[tried, :o], p[tried, width - o :], q[tried, :o]
            left = (u >= high) & (v <= low)
            good = (~apart | left | ((u <= low) & (v >= high))).all(1)
            if not good.any():
                continue
            tried, apart, x, y, u, v, left = (z[good] for z in (tried, apart, x, y, u, v, left))
            base = np.where(apart & left, x, y)
            quality = np.where(apart, np.where(left, u, v), np.maximum(u.astype(np.int16) + v - 33, 0)).astype(np.uint8)
            differ = np.count_nonzero(apart, axis=1).tolist()
            for k, r in enumerate(tried.tolist()):
                cut = len(sides[0][r]) - o
                back = sides[1][r][::-1].translate(complement)[o:]
                out[0][r], out[1][r] = o, differ[k]
                out[2][r] = (sides[0][r][:cut] + base[k].tobytes() + back).decode("latin-1")
                out[3][r] = (sides[2][r][:cut] + quality[k].tobytes() + sides[3][r][::-1][o:]).decode("latin-1")
            open_[tried] = False
        kinds = {"overlap": pa.int32(), "diff": pa.int32(), "merged_seq": pa.string(), "merged_qual": pa.string()}
        missing = pa.array([x is None for x in out[0]], pa.bool_())
        return pa.StructArray.from_arrays([pa.array(x, k) for x, k in zip(out, kinds.values(), strict=True)], names=list(kinds), mask=missing)

    return F.arrow_udf(merged, "overlap int, diff int, merged_seq string, merged_qual string", ArrowUDFType.SCALAR).asNondeterministic()


def overlap_merge(pairs: DataFrame, least: int = 30) -> DataFrame:
    """Pairs whose ends overlap, merged: ``merged_seq``, ``merged_qual``, ``overlap``, ``diff``.

    The second read is reversed and complemented. The smallest overlap of at least ``least``
    bases counts in which fewer than three bases differ, each of them high quality (``?`` or more)
    against low (``0`` or less). Such a base follows the high quality; equal bases add qualities.
    An overlap is tried for all reads of an Arrow batch at once, and only for those without a smaller one.
    """
    # not deterministic to Spark, so that a filter on the outcome doesn't compute it again
    found = pairs.withColumn("_merged", _overlaps(least)("seq1", "seq2", "qual1", "qual2")).filter("_merged is not null")
    return found.select(*pairs.columns, "_merged.*")
