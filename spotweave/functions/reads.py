"""Column functions on reads: slices, tags, trims, qualities, names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spotweave.config import BarcodeSpec, UmiSpec

#: First characters of quality 10, 20 and 30 (Phred + 33).
QUALITY = {"q10": "+", "q20": "5", "q30": "?"}


def piece(text: Column, start: int, length: int) -> Column:
    """``length`` characters from ``start`` (from 0); null if the text is too short."""
    return F.when(F.length(text) >= start + length, F.substring(text, start + 1, length))


def barcode(spec: BarcodeSpec) -> Column:
    """Position barcode of a read pair."""
    return piece(F.col(f"seq{spec.read}"), spec.start, spec.length)


def barcode_quality(spec: BarcodeSpec) -> Column:
    """Qualities of the barcode."""
    return piece(F.col(f"qual{spec.read}"), spec.start, spec.length)


def umi(spec: UmiSpec) -> Column:
    """Molecular identifier of a read pair, null if there is none."""
    return piece(F.col(f"seq{spec.read}"), spec.start, spec.length) if spec.enabled else F.lit(None).cast("string")


def umi_quality(spec: UmiSpec) -> Column:
    """Qualities of the identifier."""
    return piece(F.col(f"qual{spec.read}"), spec.start, spec.length) if spec.enabled else F.lit(None).cast("string")


def cut_second(text: Column, spec: UmiSpec) -> Column:
    """The second read before an identifier that stands on it."""
    return F.substring(text, 1, spec.start) if spec.enabled and spec.read == 2 else text


def trim_front(text: Column, n: int) -> Column:
    """Without the first ``n`` characters; empty if there are no more."""
    return F.substring(text, n + 1, 1 << 30)


def trim_back(text: Column, start: int) -> Column:
    """The characters before ``start``."""
    return F.substring(text, 1, start)


def resize(text: Column, n: int) -> Column:
    """The first ``n`` characters."""
    return F.substring(text, 1, n)


def pair_trims(bar: BarcodeSpec, mid: UmiSpec, first: Column, second: Column) -> tuple[Column, Column]:
    """Both reads of a pair as they are written."""
    if not mid.enabled:
        out = [first, second]
        out[bar.read - 1] = trim_front(out[bar.read - 1], bar.start + bar.length)
        return out[0], out[1]
    if bar.read == 1 and mid.read == 1:
        return trim_back(first, min(bar.start, mid.start)), second
    return first, trim_back(second, bar.start)


def base_name(name: Column) -> Column:
    """A read's name before its first slash."""
    return F.substring_index(name, "/", 1)


def tagged(name: Column, x: Column, y: Column, mid: Column, mid_quality: Column, has_umi: bool) -> Column:
    """A read's name with its position and identifier."""
    parts = [base_name(name), F.lit("|||CB:Z:"), F.concat_ws("_", x.cast("string"), y.cast("string"))]
    if has_umi:
        parts += [F.lit("|||UR:Z:"), mid, F.lit("|||UY:Z:"), mid_quality]
    return F.concat(*parts)


def at_least(quality: Column, first: str) -> Column:
    """Number of characters that are ``first`` or greater."""
    low = f"[\\x{{{ord(first):x}}}-~]+"  # a run is one match
    return F.length(quality) - F.length(F.regexp_replace(quality, low, ""))


def below(quality: Column, phred: int = 20) -> Column:
    """Number of bases below a quality."""
    return F.length(quality) - at_least(quality, chr(33 + phred))


def phred64_to_33(quality: Column) -> Column:
    """Qualities moved from an offset of 64 to 33, none below ``!``."""
    source = "".join(map(chr, range(33, 127)))
    return F.translate(quality, source, "".join(chr(max(33, ord(c) - 31)) for c in source))


def last_index(name: Column) -> Column:
    """What follows the last ``:`` or ``+`` that has two characters or more after it; empty for names below 5."""
    return F.when(F.length(name) < 5, "").otherwise(F.regexp_extract(name, r"(?s)^.*[:+](.{2,})$", 1))


def first_index(name: Column) -> Column:
    """What follows the last such ``:``, up to a ``+`` that has two characters or more after it; empty for names below 5.

    One pass of one expression, for a text in several conditions is computed for each of them.
    """
    found = F.regexp_replace(name, r"(?s)^(?:.*:(?:([^+]*)\+.{2,}|(.{2,}))|.*)$", "$1$2")
    return F.when(F.length(name) < 5, "").otherwise(found)


def name_barcode(name: Column, length: int) -> tuple[Column, Column]:
    """The characters after the first of a name, and whether an ``@`` among them shows a short one."""
    text = F.substring(name, 2, length)
    return text, F.instr(text, "@") > 0


def name_position(name: Column, underscore: bool = False, suffix: int = 0, length: int = 8) -> tuple[Column, Column, Column]:
    """Spot number, field column and field row at a name's end.

    Either three digits of column, one character, three of row and ``length`` of the spot, before
    ``suffix`` characters; or, with ``underscore``, the fields before the first underscore and
    the spot after it.
    """
    at = lambda text, back, n: F.try_to_number(F.substr(text, F.length(text) - back + 1, F.lit(n)), F.lit("99999999")).cast("int")
    if underscore:
        head, tail = F.substring_index(name, "_", 1), F.regexp_extract(name, r"_(\d+)", 1)
        return tail.try_cast("int"), at(head, 7, 3), at(head, 3, 3)
    end = F.substr(name, F.lit(1), F.length(name) - suffix)
    return at(end, length, length), at(end, length + 7, 3), at(end, length + 3, 3)


def record(name: Column, seq: Column, strand: Column, quality: Column) -> Column:
    """The four lines of a FASTQ record."""
    return F.concat_ws("\n", name, seq, strand, quality)
