"""Masks of 16-byte records (code of 64 bits, x and y of 32, little-endian) as the data source ``chip_mask``.

Reading cuts files into ranges of whole records and decodes a range at once; ``rec_no`` is the place of a
record in all files of the path, by name. Writing is atomic: tasks write files that don't count yet,
which get their names when all tasks have succeeded and are deleted when one has failed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from spotweave.sources.store import listed, opened

RECORD = [("bc", "<u8"), ("x", "<u4"), ("y", "<u4")]
_BYTES = 16
#: Bytes of a range, and decoded at once.
SPLIT, CHUNK = 64 << 20, 4 << 20


class MaskSource(DataSource):
    """The format ``chip_mask``."""

    @classmethod
    def name(cls) -> str:
        return "chip_mask"

    def schema(self) -> str:
        return "bc bigint, x bigint, y bigint, src int, rec_no bigint"

    def reader(self, schema) -> DataSourceReader:
        return MaskReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return MaskWriter(self.options["path"], overwrite)


class MaskReader(DataSourceReader):
    """A task for each range of whole records; bytes after the last whole record of a file are an error."""

    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.src = options["path"], int(options.get("src", 0))
        self.split = max(_BYTES, int(options.get("split_bytes", SPLIT)) // _BYTES * _BYTES)

    def partitions(self) -> list[InputPartition]:
        out, number = [], 0
        for name, size in listed(self.path):
            if size % _BYTES:
                raise ValueError(f"{name} doesn't end with a whole record of {_BYTES} bytes")
            out += [InputPartition((name, at, min(at + self.split, size), number + at // _BYTES)) for at in range(0, size, self.split)]
            number += size // _BYTES
        return out

    def read(self, partition: InputPartition) -> Iterator:
        import pyarrow as pa

        if partition is None:  # no ranges: Spark asks for one partition all the same
            return
        name, start, stop, number = partition.value
        store, at = opened(name)
        with store.open_input_file(at) as f:
            f.seek(start)
            while start < stop:
                rows = np.frombuffer(f.read(min(CHUNK, stop - start)), RECORD)
                n = len(rows)
                columns = [pa.array(rows[c].astype(np.int64)) for c, _ in RECORD]
                columns += [pa.array(np.full(n, self.src, np.int32)), pa.array(np.arange(number, number + n))]
                yield pa.RecordBatch.from_arrays(columns, names=["bc", "x", "y", "src", "rec_no"])
                start, number = start + n * _BYTES, number + n


@dataclass
class Written(WriterCommitMessage):
    """A task's file, which doesn't count yet, and its name when it does."""

    held: str | None
    final: str


class MaskWriter(DataSourceArrowWriter):
    """A file for each task, named when all tasks have succeeded."""

    def __init__(self, path: str, overwrite: bool) -> None:
        self.path, self.overwrite, self.run = path.rstrip("/"), overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator) -> Written:
        from pyspark import TaskContext

        context = TaskContext.get()
        store, at = opened(self.path)
        held = f"{at}/_{self.run}-{context.taskAttemptId()}"
        store.create_dir(at, recursive=True)
        try:
            with store.open_output_stream(held) as out:
                for batch in iterator:
                    rows = np.empty(batch.num_rows, RECORD)
                    for c, kind in RECORD:
                        rows[c] = batch.column(c).to_numpy(zero_copy_only=False).astype(kind)
                    out.write(rows.tobytes())
        except BaseException:
            store.delete_file(held)
            raise
        return Written(held, f"{at}/part-{context.partitionId():05d}-{self.run}.bin")

    def commit(self, messages: list[Written | None]) -> None:
        store, at = opened(self.path)
        store.create_dir(at, recursive=True)
        old = [opened(name)[1] for name, _ in listed(self.path)] if self.overwrite else []
        for m in messages:
            if m is not None:
                store.move(m.held, m.final)
        for name in old:
            store.delete_file(name)

    def abort(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        store, at = opened(self.path)  # also what tasks left that were killed
        for x in store.get_file_info(fs.FileSelector(at, allow_not_found=True)):
            if x.base_name.startswith(f"_{self.run}-"):
                store.delete_file(x.path)


def register(spark: SparkSession) -> None:
    """Make the format known to a session."""
    try:
        spark.dataSource.register(MaskSource)
    except AnalysisException as e:  # known already
        if "ALREADY_EXISTS" not in str(e):
            raise


def read_mask_binary(spark: SparkSession, path: str, src: int = 0) -> DataFrame:
    """The records of a file, a folder or a pattern: ``bc``, ``x``, ``y``, ``src``, ``rec_no``."""
    register(spark)
    return spark.read.format("chip_mask").option("src", src).load(path)


def write_mask_binary(mask: DataFrame, folder: str, overwrite: bool = False) -> None:
    """``bc``, ``x`` and ``y`` of a mask as 16-byte records, a file for each partition; nothing if a task fails."""
    register(mask.sparkSession)
    mask.select("bc", "x", "y").write.format("chip_mask").mode("overwrite" if overwrite else "append").save(folder)
