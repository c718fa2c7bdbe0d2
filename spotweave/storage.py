"""The folder that driver and executors share."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Paths stored in the open ``intermediates`` blocks, innermost last.
_OPEN: ContextVar[tuple[list[str], ...]] = ContextVar("open", default=())


#: Folders made so far, by application and setting.
_MADE: dict[tuple[str, str], str] = {}


def shared_dir(spark: SparkSession) -> str:
    """This application's folder in ``spark.checkpoint.dir``; in a temporary folder where a local session (as in tests) names none.

    On a cluster the setting must be there, for executors don't see the driver's folders. What is still in
    the folder when the application ends is deleted then.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = os.path.join(tempfile.gettempdir(), "checkpoints", f"spotweave-{os.getpid()}")
    key = (spark.sparkContext.applicationId, found)
    if key not in _MADE:
        _MADE[key] = f"{found.rstrip('/')}/spotweave-{key[0]}"
        at = spark._jvm.org.apache.hadoop.fs.Path(_MADE[key])
        store = at.getFileSystem(spark._jsc.hadoopConfiguration())
        store.mkdirs(at)
        store.deleteOnExit(at)
    return _MADE[key]


def scratch(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(spark: SparkSession, df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    It cuts the lineage, so what follows neither recomputes ``df`` nor depends on the
    executors that made it.
    """
    path = scratch(spark, label)
    if _OPEN.get():
        _OPEN.get()[-1].append(path)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside the block what an execution shuffled is deleted when it ends, not when the driver's garbage is collected."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a path in whatever store it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def intermediates(spark: SparkSession, keep: int = 0) -> Iterator[None]:
    """Delete what is ``stored`` inside the block when it ends, but for the last ``keep`` tables.

    So a block must store what its caller reads last. Kept tables belong to the block around, if
    there is one.
    """
    paths: list[str] = []
    token = _OPEN.set((*_OPEN.get(), paths))
    try:
        yield
    finally:
        _OPEN.reset(token)
        last = len(paths) - keep
        for path in paths[:last]:
            delete(spark, path)
        if _OPEN.get():
            _OPEN.get()[-1].extend(paths[last:])
