"""Column functions on base sequences and their 2-bit codes.

Base i takes bits 2i and 2i+1: A 0, C 1, T 2, G 3, and N as G; small letters as capitals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The alphabet in the order of the codes.
BASES = "ACTG"
#: One bit of each base.
_ODD_BITS = 0x5555555555555555


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def encode(seq: Column | str) -> Column:
    """2-bit code of at most 31 bases, as a long."""
    digits = F.translate(F.upper(_c(seq)), "ACTGN", "01233")
    return F.conv(F.reverse(digits), 4, 10).cast("long")


def decode(code: Column | str, length: int) -> Column:
    """The ``length`` bases of a code."""
    digits = F.lpad(F.conv(_c(code).cast("string"), 10, 4), length, "0")
    return F.reverse(F.translate(digits, "0123", BASES))


def canonical(seq: Column | str, length: int) -> Column:
    """The ``length`` bases of a text's code, so that equal codes are equal texts; no code is made where all are bases, which is far cheaper."""
    s = F.upper(_c(seq))
    return F.when(s.rlike("[^ACGT]"), decode(encode(seq), length)).otherwise(s)


def complement(seq: Column | str) -> Column:
    """Complement; what isn't a base becomes N."""
    return F.translate(F.regexp_replace(F.upper(_c(seq)), "[^ACGT]", "N"), "ACGT", "TGCA")


def reverse_complement(seq: Column | str) -> Column:
    """Reversed complement."""
    return F.reverse(complement(seq))


def reverse_complement_text(seq: str) -> str:
    """Reversed complement of a literal."""
    pairs = dict(zip("ACGT", "TGCA", strict=True))
    return "".join(pairs.get(b, "N") for b in reversed(seq.upper()))


def encode_reverse_complement(seq: Column | str) -> Column:
    """Code of the reversed complement."""
    return encode(reverse_complement(seq))


def hamming(a: Column | str, b: Column | str) -> Column:
    """Number of bases in which two codes differ."""
    x = _c(a).bitwiseXOR(_c(b))
    return F.bit_count(x.bitwiseOR(F.shiftright(x, 1)).bitwiseAND(F.lit(_ODD_BITS)))


def n_count(seq: Column | str) -> Column:
    """Number of N (capital only)."""
    s = _c(seq)
    return F.length(s) - F.length(F.replace(s, F.lit("N"), F.lit("")))


def n_index(seq: Column | str) -> Column:
    """-1 without an N, its place from 0 if there is one, -2 with more."""
    s, n = _c(seq), n_count(seq)
    return F.when(n == 0, -1).when(n == 1, F.instr(s, "N") - 1).otherwise(-2)


def position_text(x: Column | str, y: Column | str) -> Column:
    """``x_y``."""
    return F.concat_ws("_", _c(x).cast("string"), _c(y).cast("string"))


def pack_position(x: Column | str, y: Column | str) -> Column:
    """Two unsigned 32-bit numbers in one long."""
    return F.shiftleft(_c(x).cast("long"), 32).bitwiseOR(_c(y).cast("long"))


def unpack_position(code: Column | str) -> tuple[Column, Column]:
    """x and y of a packed position."""
    return F.shiftrightunsigned(_c(code), 32), _c(code).bitwiseAND(F.lit(0xFFFFFFFF))


def pack_fields(x: Column | str, y: Column | str) -> Column:
    """Two unsigned 16-bit numbers in one."""
    return F.shiftleft(_c(x).cast("long"), 16).bitwiseOR(_c(y).cast("long"))


def unpack_fields(code: Column | str) -> tuple[Column, Column]:
    """Both numbers of ``pack_fields``."""
    return F.shiftright(_c(code), 16).bitwiseAND(F.lit(0xFFFF)), _c(code).bitwiseAND(F.lit(0xFFFF))


def pack_cell(x: Column | str, y: Column | str, gene: Column | str) -> Column:
    """x and y of 24 bits and a gene of 16 in one long."""
    high = F.shiftleft(_c(x).cast("long"), 40).bitwiseOR(F.shiftleft(_c(y).cast("long"), 16))
    return high.bitwiseOR(_c(gene).cast("long"))


def unpack_cell(code: Column | str) -> tuple[Column, Column, Column]:
    """x, y and gene of ``pack_cell``."""
    c = _c(code)
    return F.shiftrightunsigned(c, 40), F.shiftright(c, 16).bitwiseAND(F.lit(0xFFFFFF)), c.bitwiseAND(F.lit(0xFFFF))


def neighbour_count(length: int, mismatch: int) -> int:
    """Sequences within 1 to ``mismatch`` substitutions of one of ``length`` bases."""
    total, choose = 0, 1
    for k in range(1, mismatch + 1):
        choose = choose * (length - k + 1) // k
        total += choose * 3**k
    return total


def neighbours(code: Column | str, length: int, mismatch: int) -> Column:
    """Array of the codes at exactly ``mismatch`` substitutions (1 to 3)."""
    # masks are literals: which places change, and how, is fixed by the length
    steps = [(0, -1)]
    for _ in range(mismatch):
        steps = [(m | s << 2 * i, i) for m, last in steps for i in range(last + 1, length) for s in (1, 2, 3)]
    literal = F.from_json(F.lit(str([m for m, _ in steps])), "array<bigint>")
    return F.transform(literal, lambda m: _c(code).bitwiseXOR(m))


def poly_t(length: int) -> int:
    """Code of ``length`` T."""
    return int("2" * length, 4)


def wildcard(seq: Column | str) -> Column:
    """Array of the four sequences with the (single) N replaced."""
    s = _c(seq)
    return F.array(*[F.replace(s, F.lit("N"), F.lit(b)) for b in BASES])
