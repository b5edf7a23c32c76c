"""Growing raw log files ``uid<N>-<kind>.log`` as a stream, by byte offset.

A Spark data source whose offsets are bytes per file, always behind a line feed:
a batch takes what every file has gained, a restart goes on where the checkpoint
stands, and a half-written last line waits until its end is there. Large gains
are cut into byte ranges, each task reading the lines that begin in its range;
small ones of many files are read together. A file that has shrunk was rotated
and is read anew. Files lie on any storage that pyarrow opens.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = "raw_log_tail"
FILE = re.compile(r"uid(\d+)-([A-Za-z0-9_]+)\.log")
SCHEMA = "uid long, kind string, at long, line string"
# Bytes of one task, and of one read.
TASK_BYTES, BLOCK = 64 << 20, 1 << 20


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def whole_lines(file: pa.NativeFile, size: int) -> int:
    """Bytes up to the last line feed."""
    end = size
    while end > 0:
        begin = max(0, end - BLOCK)
        at = file.read_at(end - begin, begin).rfind(b"\n")
        if at >= 0:
            return begin + at + 1
        end = begin
    return 0


def lines_from(file: pa.NativeFile, start: int, stop: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(byte offset, line) of the lines that begin in [start, stop); ``end`` lies behind a line feed."""
    if start and file.read_at(1, start - 1) != b"\n":  # the line that runs into this range belongs to the one before
        while start < end:
            block = file.read_at(min(BLOCK, end - start), start)
            at = block.find(b"\n")
            start += len(block) if at < 0 else at + 1
            if at >= 0:
                break
    rest, base, read = b"", start, start
    while base < stop:
        if read >= end:
            break
        block = file.read_at(min(BLOCK, end - read), read)
        read += len(block)
        *full, rest = (rest + block).split(b"\n")
        for x in full:
            if base >= stop:
                return
            yield base, x
            base += len(x) + 1


class _Ranges(InputPartition):
    def __init__(self, ranges: list[tuple[str, int, int, int]]):
        super().__init__(ranges)
        self.ranges = ranges


class _TailReader(DataSourceStreamReader):
    def __init__(self, path: str):
        self.path = path

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        store, root = _opened(self.path)
        out = {}
        for info in store.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
            if info.is_file and FILE.fullmatch(info.base_name):
                with store.open_input_file(info.path) as f:
                    n = whole_lines(f, info.size)
                if n:
                    out[info.base_name] = n
        return out

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        out, held, size = [], [], 0
        for name, stop in sorted(end.items()):
            begin = start.get(name, 0)
            begin = 0 if begin > stop else begin
            while begin < stop:
                to = min(stop, begin + TASK_BYTES - size)
                held.append((name, begin, to, stop))
                size += to - begin
                begin = to
                if size >= TASK_BYTES:
                    out.append(_Ranges(held))
                    held, size = [], 0
        return [*out, _Ranges(held)] if held else out

    def read(self, partition: _Ranges) -> Iterator[pa.RecordBatch]:
        store, root = _opened(self.path)
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.int64(), pa.string()), strict=True)],
                                              names=["uid", "kind", "at", "line"])

        for name, start, stop, end in partition.ranges:
            uid, kind = FILE.fullmatch(name).groups()
            with store.open_input_file(f"{root}/{name}") as f:
                for at, line in lines_from(f, start, stop, end):
                    rows.append((int(uid), kind, at, line.decode("utf-8", "ignore")))
                    if len(rows) >= 10_000:
                        yield batch()
                        rows = []
        if rows:
            yield batch()

    def commit(self, end: dict) -> None:
        pass


class RawLogTail(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _TailReader(self.options["path"])


def tail_raw_logs(spark: SparkSession, path: str) -> DataFrame:
    """Stream of (uid, kind, at, line): every line of the files under ``path`` once, with the byte it begins at."""
    spark.dataSource.register(RawLogTail)
    return spark.readStream.format(NAME).option("path", path).load()


def write_raw_logs(lines: DataFrame, path: str) -> None:
    """Write (uid, kind, pos, line) as one file per uid and kind, in line order, each put in place when it is whole.

    Writing a longer series again makes the files grow: what was there stays a prefix.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _opened(path)
        store.create_dir(root)
        name, out = None, None

        def close() -> None:
            if out is not None:
                out.close()
                store.move(f"{root}/.{name}", f"{root}/{name}")

        for b in batches:
            for uid, kind, line in zip(*(b.column(c).to_pylist() for c in ("uid", "kind", "line")), strict=True):
                if name != f"uid{uid}-{kind}.log":
                    close()
                    name = f"uid{uid}-{kind}.log"
                    out = store.open_output_stream(f"{root}/.{name}")
                out.write(line.encode("utf-8") + b"\n")
        close()
        yield pa.RecordBatch.from_arrays([pa.array([], pa.int64())], names=["n"])

    laid = lines.filter(F.col("line").isNotNull()).repartition("uid", "kind").sortWithinPartitions("uid", "kind", "pos")
    laid.select("uid", "kind", "pos", "line").mapInArrow(write, "n long").write.format("noop").mode("overwrite").save()
