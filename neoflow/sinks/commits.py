"""Numbered commits in a shared folder: what a job must remember between micro-batches.

A commit is a small JSON text ``<version>.json``, made whole by one rename that
fails where the version is taken, and ``<version>.done`` once its data is written.
Only the last few are kept. One writer works on a log at a time; a second one
that begins the same version gets FileExistsError.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Commits kept behind the last one.
KEPT = 2


@dataclass
class Commit:
    version: int
    payload: dict
    done: bool


class CommitLog:
    def __init__(self, spark: SparkSession, base: str):
        self._jvm = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.base = base.rstrip("/")
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}" if name else self.base)

    def _names(self) -> list[str]:
        if not self._fs.exists(self._path("")):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(""))]

    def _read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _write(self, name: str, text: str) -> None:
        temp = f"_{uuid.uuid4().hex}"
        out = self._fs.create(self._path(temp), True)
        out.write(bytearray(text.encode()))
        out.close()
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path("").toUri(), self._conf)
        none = self._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            files.rename(self._fs.makeQualified(self._path(temp)), self._fs.makeQualified(self._path(name)), none)
        except Py4JJavaError as e:
            self._fs.delete(self._path(temp), False)
            if "AlreadyExists" in e.java_exception.getClass().getName():
                raise FileExistsError(name) from None
            raise

    def last(self) -> Commit | None:
        """The last commit begun, done or not."""
        names = set(self._names())
        versions = sorted(int(n[:-5]) for n in names if n.endswith(".json"))
        if not versions:
            return None
        v = versions[-1]
        return Commit(v, json.loads(self._read(f"{v:012d}.json")), f"{v:012d}.done" in names)

    def begin(self, version: int, payload: dict) -> Commit:
        self._write(f"{version:012d}.json", json.dumps(payload))
        return Commit(version, payload, False)

    def finish(self, version: int) -> None:
        """Mark a commit done; commits long before it go."""
        if f"{version:012d}.done" not in self._names():
            self._write(f"{version:012d}.done", "")
        for name in self._names():
            number = name.partition(".")[0]
            if number.isdigit() and int(number) < version - KEPT:
                self._fs.delete(self._path(name), False)
