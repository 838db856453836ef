"""Small state files that are replaced as a whole: the switch between two states of stored tables."""

from __future__ import annotations

import json
import uuid
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Somebody else has written the state after the one this change was based on."""


class StateLog:
    """Numbered JSON states in a folder, the highest number being the current one.

    A state is written aside and then moved to its number, which fails if that number is taken. So a
    reader sees the old or the new state, never a part of one, and of two writers with the
    same base one gets a ``Conflict``. Folders are reached through Hadoop's file systems.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.folder = folder.rstrip("/")

    def path(self, *names: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *names]))

    def _files(self):
        return self.path().getFileSystem(self._conf)

    def list(self, *names: str) -> list[str]:
        """Names in a folder; none if there is no such folder."""
        files, path = self._files(), self.path(*names)
        return sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []

    def numbers(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self.list() if n.removesuffix(".json").isdigit()]

    def load(self, number: int | None = None) -> tuple[int, dict[str, Any]]:
        """The current state, or an earlier one; ``(0, {})`` before the first."""
        if number is None:
            number = max(self.numbers(), default=0)
        if not number:
            return 0, {}
        stream = self._files().open(self.path(f"{number:012d}.json"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return number, json.loads(text)

    def store(self, base: int, state: dict[str, Any]) -> int:
        """Write ``state`` as the one after ``base``."""
        files, aside = self._files(), self.path(f".{uuid.uuid4().hex}")
        stream = files.create(aside, False)
        try:
            stream.write(json.dumps(state).encode())
        finally:
            stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), self._conf)
        options = self._jvm.java.lang.reflect.Array.newInstance(self._rename_option(), 0)
        try:
            context.rename(context.makeQualified(aside), context.makeQualified(self.path(f"{base + 1:012d}.json")), options)
        except Py4JJavaError as e:
            files.delete(aside, False)
            if "FileAlreadyExists" in str(e.java_exception):
                raise Conflict(f"state {base + 1} of {self.folder} is written already") from None
            raise
        return base + 1

    def _rename_option(self):
        return self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")

    def delete(self, *names: str) -> None:
        self._files().delete(self.path(*names), True)
