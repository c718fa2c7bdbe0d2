"""A mask stored once for many runs and micro-batches: its dictionary in buckets, its pieces measured, barcodes resolved before.

The dictionary is a bucketed table by code, so a join with it moves only the other side. Resolved barcodes
(also those without a match) are kept beside it for each setting, and only unseen ones are resolved.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.config import BarcodeSpec
from spotweave.operators import resolve
from spotweave.storage import intermediates, shuffles_dropped, stored

_DICTIONARY = "bc BIGINT, x BIGINT, y BIGINT"


class MaskIndex:
    """An index at a path; ``build`` makes one, ``open_index`` opens it, in any session."""

    def __init__(self, spark: SparkSession, path: str, length: int, start: int, buckets: int) -> None:
        self.spark, self.path, self.length, self.start, self.buckets = spark, path.rstrip("/"), length, start, buckets
        self.table = f"spotweave_{hashlib.md5(self.path.encode()).hexdigest()}"
        self._cuts: dict[int, resolve.Cut] = {}

    def dictionary(self) -> DataFrame:
        """``bc``, ``x``, ``y``, bucketed by ``bc``."""
        place = f"{self.path}/dictionary".replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({_DICTIONARY}) USING parquet CLUSTERED BY (bc) SORTED BY (bc) INTO {self.buckets} BUCKETS LOCATION '{place}'"
        )
        return self.spark.table(self.table)

    def cut(self, distance: int) -> resolve.Cut:
        """The cut into pieces for a distance, measured once for the mask and kept with it."""
        if distance not in self._cuts:
            place = f"{self.path}/cut-{distance}"
            try:
                rows = self.spark.read.parquet(place)
            except AnalysisException as e:
                if "PATH_NOT_FOUND" not in str(e):
                    raise
                with intermediates(self.spark):
                    found = resolve.measured(self.spark, self.dictionary(), self.length, distance)
                    masks = self.spark.createDataFrame([(k, m, None) for k, m in enumerate(found.masks)], "part int, value long, deals int")
                    masks.unionByName(found.crowds).write.parquet(place)
                rows = self.spark.read.parquet(place)
            masks = [r["value"] for r in rows.filter("deals is null").orderBy("part").collect()]
            self._cuts[distance] = resolve.Cut(masks, rows.filter("deals is not null"))
        return self._cuts[distance]

    def resolved(self, barcodes: DataFrame, spec: BarcodeSpec) -> DataFrame:
        """``resolve.resolve`` of distinct barcodes; those resolved before are looked up."""
        if (spec.length, spec.start) != (self.length, self.start):
            raise ValueError("the index was built for barcodes of another place")
        if not spec.mismatch:
            return resolve.resolve(barcodes, self.dictionary(), spec)
        with shuffles_dropped(self.spark):
            return self._kept(barcodes, spec)

    def _kept(self, barcodes: DataFrame, spec: BarcodeSpec) -> DataFrame:
        """``resolved`` with a tolerance: what is resolved is kept beside the dictionary."""
        place = f"{self.path}/resolved-{spec.mismatch}"
        schema = "barcode string, match_kind string, bc long, x long, y long"
        # read again below: whoever called may read the result later
        barcodes = stored(self.spark, barcodes.select("barcode").filter("barcode is not null"), "resolve-barcodes", "lz4")
        try:
            known = self.spark.read.schema(schema).parquet(place)
            unseen = barcodes.join(known, "barcode", "left_anti")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            unseen = barcodes
        with intermediates(self.spark):
            if unseen is not barcodes:
                unseen = stored(self.spark, unseen, "resolve-unseen", "lz4")
            if unseen.limit(1).count():
                found = resolve.resolve(unseen, self.dictionary(), spec, cut=self.cut)
                unseen.join(found, "barcode", "left").select("barcode", "match_kind", "bc", "x", "y").write.mode("append").parquet(place)
        known = self.spark.read.schema(schema).parquet(place).filter("match_kind is not null")
        # two runs at once may have stored a barcode twice
        return known.join(barcodes, "barcode", "left_semi").dropDuplicates(["barcode"])


def build(spark: SparkSession, mask: DataFrame, spec: BarcodeSpec, path: str, buckets: int | None = None) -> MaskIndex:
    """Store the index of a mask at ``path``; by default with a bucket for each shuffle partition."""
    made = MaskIndex(spark, path, spec.length, spec.start, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = resolve.last_wins(mask, spec).repartition(made.buckets, "bc")
    spark.sql(f"DROP TABLE IF EXISTS {made.table}")
    with shuffles_dropped(spark):
        rows.write.bucketBy(made.buckets, "bc").sortBy("bc").option("path", f"{made.path}/dictionary").saveAsTable(made.table)
    meta = json.dumps({"length": made.length, "start": made.start, "buckets": made.buckets})
    spark.createDataFrame([(meta,)], "value string").coalesce(1).write.text(f"{made.path}/meta")
    return made


def open_index(spark: SparkSession, path: str) -> MaskIndex:
    """The index stored at ``path``."""
    return MaskIndex(spark, path, **json.loads(spark.read.text(f"{path.rstrip('/')}/meta").first()["value"]))
