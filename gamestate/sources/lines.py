"""Data source "landed": the lines of landed documents, in batches and as a stream with offsets.

register(spark); then spark.read.format("landed").load(folder) or spark.readStream. A row is a line
with its file and number. The stream's offset is the time and name of the last file it has handed on, so a restarted
stream begins there and a file is read once; files must be complete when they appear, and newer ones have later times.
Any store that pyarrow's file systems reach will do.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

LINES = "file string, line long, value string"
BATCH = 8192


class File(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def _files(uri: str) -> list[tuple[int, str]]:
    """(time in nanoseconds, path) of the data files of a folder, oldest first."""
    from pyarrow import fs

    store, at = _store(uri)
    found = store.get_file_info(fs.FileSelector(at, recursive=True))
    return sorted((f.mtime_ns or 0, f.path) for f in found if f.is_file and not f.base_name.startswith(("_", ".")))


def _lines(uri: str, path: str) -> Iterator[pa.RecordBatch]:
    store, _ = _store(uri)
    with store.open_input_stream(path) as f:
        held, number, rest = [], 0, b""

        def batch() -> pa.RecordBatch:
            n = len(held)
            return pa.RecordBatch.from_arrays([pa.array([path] * n, pa.string()), pa.array(range(number, number + n), pa.int64()), pa.array(held, pa.string())], names=["file", "line", "value"])

        while True:
            data = f.read(1 << 20)
            *whole, rest = (rest + data).split(b"\n")
            if not data and rest:
                whole.append(rest)
            held += [x.decode("utf-8", "replace").rstrip("\r") for x in whole]
            if held and (not data or len(held) >= BATCH):
                yield batch()
                number, held = number + len(held), []
            if not data:
                return


class _Reader(DataSourceReader):
    def __init__(self, uri: str) -> None:
        self.uri = uri

    def partitions(self) -> list[InputPartition]:
        return [File(p) for _, p in _files(self.uri)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        yield from _lines(self.uri, partition.path)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, uri: str) -> None:
        self.uri = uri

    def initialOffset(self) -> dict:
        return {"time": -1, "path": ""}

    def latestOffset(self) -> dict:
        files = _files(self.uri)
        return {"time": files[-1][0], "path": files[-1][1]} if files else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        after, upto = ((o["time"], o["path"]) for o in (start, end))
        return [File(f[1]) for f in _files(self.uri) if after < f <= upto]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        yield from _lines(self.uri, partition.path)

    def commit(self, end: dict) -> None:
        pass


class LandedLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "landed"

    def schema(self) -> str:
        return LINES

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options["path"])

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _StreamReader(self.options["path"])


def register(spark: SparkSession) -> None:
    """Make the source known; its code travels with it, as the processes that plan reads may not have this package."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    try:
        spark.dataSource.register(LandedLines)
    finally:
        cloudpickle.unregister_pickle_by_value(sys.modules[__name__])
