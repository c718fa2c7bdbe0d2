"""What the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.storage import intermediates, stored  # noqa: F401  (used from here by the operators)
from spotweave.storage import scratch as scratch_path  # noqa: F401

#: The whitespace that separates words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = r"[\x20\x09-\x0D]+"


def free_prefix(df: DataFrame, prefix: str) -> str:
    """``prefix``, with underscores appended until no column of ``df`` begins with it: for columns that an operator adds for itself."""
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table ``documents``."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(col: str = "text") -> Column:
    """The text, with null as the empty string."""
    return F.coalesce(F.col(col), F.lit(""))


def unit_hash(*parts: Column | str) -> Column:
    """A number in [0, 1) from the md5 of the parts, the same in every engine that has md5.

    The first 13 hex digits (52 bits) are exact in a double.
    """
    key = F.concat_ws("\x1f", *[F.lit(p) if isinstance(p, str) else p for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
