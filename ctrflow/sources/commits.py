"""States of a table as numbered files, each claimed by creating a file that must not exist yet."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import SparkSession

#: Seconds to wait for a writer that has claimed a number and not written yet.
PATIENCE = 10.0


class Commits:
    """The folder of states; the newest counts. Two writers never take one number, the later one starts again from the new state.

    This rests on the file system's create being exclusive, as that of HDFS and of local folders is.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm = spark.sparkContext._jvm
        self._folder = self._jvm.org.apache.hadoop.fs.Path(folder)
        self._files = self._folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        if not self._files.exists(self._folder):
            return []
        names = (f.getPath().getName() for f in self._files.listStatus(self._folder))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _path(self, number: int):
        return self._jvm.org.apache.hadoop.fs.Path(self._folder, f"{number:012d}.json")

    def _read(self, number: int) -> dict | None:
        stream = self._files.open(self._path(number))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            return None

    def last(self) -> tuple[int, dict | None]:
        """The highest number, 0 if there is none, and the newest state that can be read."""
        numbers, until = self._numbers(), time.monotonic() + PATIENCE
        for n in reversed(numbers):
            while (state := self._read(n)) is None and time.monotonic() < until:
                time.sleep(0.2)
            if state is not None:
                return numbers[-1], state
        return (numbers[-1] if numbers else 0), None

    def claim(self, number: int, state: dict) -> bool:
        """Whether ``state`` is now the one of this number; false if another writer has it."""
        try:
            out = self._files.create(self._path(number), False)
        except Exception as error:
            if self._files.exists(self._path(number)):
                return False
            raise error
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        return True

    def update(self, change: Callable[[dict | None], dict]) -> int:
        """Adds ``change`` of the newest state; returns its number."""
        while True:
            number, state = self.last()
            if self.claim(number + 1, change(state)):
                return number + 1
