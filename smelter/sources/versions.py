"""Numbered JSON documents in a folder, each written once: what a reader finds there is whole."""

from __future__ import annotations

import json
import os
import uuid
from pathlib import Path

from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer has taken the same number."""


class Folder:
    """Files of a folder on any file system Spark can reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._place = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self.system = self._place(self.path).getFileSystem(self._conf)

    def place(self, name: str = ""):
        return self._place(f"{self.path}/{name}" if name else self.path)

    def names(self) -> list[str]:
        if not self.system.exists(self.place()):
            return []
        return sorted(s.getPath().getName() for s in self.system.listStatus(self.place()))

    def exists(self, name: str) -> bool:
        return self.system.exists(self.place(name))

    def text(self, name: str) -> str:
        stream = self.system.open(self.place(name))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """Write a file that does not exist yet; it appears whole or not at all, and for one writer only."""
        if self.system.getUri().getScheme() == "file":
            return self._put_local(name, text)
        fresh = self.place(f".{uuid.uuid4().hex}")
        out = self.system.create(fresh, False)
        out.write(bytearray(text.encode()))
        out.close()
        options = self.spark.sparkContext._gateway.new_array(getattr(self.spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), self._conf)
        try:
            context.rename(fresh, self.place(name), options)
        except Exception:
            self.system.delete(fresh, False)
            if self.exists(name):
                raise Conflict(f"{self.path}/{name} exists") from None
            raise

    def _put_local(self, name: str, text: str) -> None:
        """On a mounted folder, where a rename replaces: a link does not."""
        folder = Path(self.place().toUri().getPath())
        folder.mkdir(parents=True, exist_ok=True)
        fresh = folder / f".{uuid.uuid4().hex}"
        fresh.write_text(text, encoding="utf-8")
        try:
            os.link(fresh, folder / name)
        except FileExistsError:
            raise Conflict(f"{self.path}/{name} exists") from None
        finally:
            fresh.unlink()

    def remove(self, name: str) -> bool:
        return self.system.delete(self.place(name), True)


class Versions:
    """A document that is replaced by its next version, one writer at a time.

    Of two writers that build on the same version the second fails with ``Conflict``. File systems need a rename that
    does not replace, as HDFS has; on an object store use one writer.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.folder = Folder(spark, path)

    def numbers(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self.folder.names() if n.endswith(".json") and n[0].isdigit())

    def read(self, number: int) -> dict:
        return json.loads(self.folder.text(f"{number:012d}.json"))

    def latest(self) -> tuple[int, dict]:
        """(number, document); (0, {}) before the first."""
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else (0, {})

    def last(self, keep: int) -> list[dict]:
        """The last ``keep`` documents."""
        return [self.read(n) for n in self.numbers()[-keep:]]

    def follow(self, number: int, document: dict) -> int:
        """Publish the version after ``number``."""
        self.folder.put(f"{number + 1:012d}.json", json.dumps(document, sort_keys=True))
        return number + 1
