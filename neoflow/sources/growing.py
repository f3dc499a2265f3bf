"""Lines appended to growing text files, as a stream: a Python data source.

A position is the number of bytes read of each file. A micro-batch reads, file by
file, what was appended since the last one, up to the last line end: a line that is
still being written waits for its end. Ranges of a file are cut into parts of
PART bytes, so that a large file is read by many tasks; a part owns the lines that begin
in it. The folder must be mounted on the driver and the executors.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "growing_lines"
#: Bytes of a task's part of a file, and of one read.
PART, READ = 32 << 20, 1 << 20
_SCHEMA = "file string, position long, value string"


@dataclass
class Part(InputPartition):
    file: str
    first: int
    end: int
    stop: int


def local(path: str) -> str:
    return path[len("file://"):] if path.startswith("file://") else path.removeprefix("file:")


def last_line_end(path: str, first: int) -> int:
    """The position after the last line feed from ``first`` on; ``first`` if there is none."""
    at = os.path.getsize(path)
    with open(path, "rb") as f:
        while at > first:
            size = min(READ, at - first)
            f.seek(at - size)
            found = f.read(size).rfind(b"\n")
            if found >= 0:
                return at - size + found + 1
            at -= size
    return first


def lines_of(part: Part) -> Iterator[pa.RecordBatch]:
    """The lines that begin in a part, read up to ``stop`` at most."""
    with open(part.file, "rb") as f:
        at = part.first
        if at:
            f.seek(at - 1)
            if f.read(1) != b"\n":  # the line begins in an earlier part
                at += len(f.readline())
        f.seek(at)
        positions, values, held = [], [], 0
        while at < min(part.end, part.stop):
            line = f.readline()
            positions.append(at)
            values.append(line.rstrip(b"\r\n").decode("utf-8", "replace"))
            at += len(line)
            held += len(line)
            if held >= READ:
                yield _batch(part.file, positions, values)
                positions, values, held = [], [], 0
        if positions:
            yield _batch(part.file, positions, values)


def _batch(file: str, positions: list[int], values: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([file] * len(values), pa.string()), pa.array(positions, pa.int64()),
                                       pa.array(values, pa.string())], names=["file", "position", "value"])


class GrowingLinesReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.folder = local(options["path"])

    def initialOffset(self) -> dict:
        return {"files": "{}"}

    def latestOffset(self) -> dict:
        ends = {}
        for name in sorted(os.listdir(self.folder)):
            path = os.path.join(self.folder, name)
            if os.path.isfile(path) and not name.startswith((".", "_")):
                ends[name] = last_line_end(path, 0)
        return {"files": json.dumps(ends, sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> list[Part]:
        was, now = json.loads(start["files"]), json.loads(end["files"])
        parts = []
        for name, stop in now.items():
            first = was.get(name, 0)
            if stop < first:
                raise RuntimeError(f"{name} is shorter than what was read of it ({stop} < {first} bytes)")
            path = os.path.join(self.folder, name)
            parts += [Part(path, at, min(at + PART, stop), stop) for at in range(first, stop, PART)]
        return parts

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        return lines_of(partition)


class GrowingLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return _SCHEMA

    def streamReader(self, schema) -> GrowingLinesReader:
        return GrowingLinesReader(self.options)


def read_growing_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Stream of (file, position, value): each line of the folder's files once, also
    those appended later to a file that was read before, and over restarts."""
    spark.dataSource.register(GrowingLines)
    return spark.readStream.format(FORMAT).load(folder)
