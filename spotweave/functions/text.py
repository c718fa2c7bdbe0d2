"""Column functions on text and numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import ArrowUDFType


def mapped(col: Column, source: str, target: str) -> Column:
    """``translate`` of ASCII texts to as many ASCII characters, over the bytes of Arrow columns."""
    table = bytes(dict(zip(source.encode(), target.encode(), strict=True)).get(k, k) for k in range(256))

    def replaced(texts):
        import pyarrow as pa

        valid, bounds, data = texts.buffers()
        return pa.Array.from_buffers(texts.type, len(texts), [valid, bounds, data and pa.py_buffer(data.to_pybytes().translate(table))], texts.null_count, texts.offset)

    return F.arrow_udf(replaced, "string", ArrowUDFType.SCALAR)(col)


def tokens(col: Column | str, separator: str = ",") -> Column:
    """Parts of a text between separators; leading separators are skipped."""
    c = F.col(col) if isinstance(col, str) else col
    quoted = "".join(f"\\x{{{ord(x):x}}}" for x in separator)
    return F.split(F.regexp_replace(c, f"^(?:{quoted})+", ""), quoted)


def trimmed(col: Column | str) -> Column:
    """Without spaces at either end."""
    return F.trim(F.col(col) if isinstance(col, str) else col)


def starts_with(col: Column | str, prefix: str) -> Column:
    """Whether a text begins with a prefix."""
    return (F.col(col) if isinstance(col, str) else col).startswith(prefix)


def ends_with(col: Column | str, suffix: str) -> Column:
    """Whether a text ends with a suffix."""
    return (F.col(col) if isinstance(col, str) else col).endswith(suffix)


def thousands(col: Column) -> Column:
    """A whole number with commas."""
    return F.format_number(col, 0)


def percent(part: Column, whole: Column) -> Column:
    """Percent with two decimals; 0.0 of nothing."""
    share = F.try_divide(part.cast("double") * 100, whole.cast("double"))
    return F.when(share.isNull(), "0.0").otherwise(F.format_string("%.2f", F.round(share, 2)))


def si_number(col: Column) -> Column:
    """A number in thousands steps with its unit, six decimals."""
    out = F.format_string("%.6f", col.cast("double"))
    for power, unit in ((1, "K"), (2, "M"), (3, "G"), (4, "T")):
        out = F.when(col > 1000**power, F.format_string(f"%.6f {unit}", col / float(1000**power))).otherwise(out)
    return out
