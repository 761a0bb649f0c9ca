"""Ids for rows of a table, handed out in ranges that no two writers share.

The ledger is a folder next to the table. An entry is named after the first id of its range and
created only if it does not exist, which the store does atomically: of two writers that want the
same range one gets it, and the other asks again for the next. The entry's text is the last id.
"""

from __future__ import annotations

import os
import re
import time
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession

#: Seconds that an entry may stay without its text before it counts as left behind.
WRITE_SECONDS = 60


class Store:
    """A folder of small files in any store that Spark reaches."""

    def __init__(self, spark: SparkSession, folder: str):
        self.path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        self.files = self.path.getFileSystem(spark._jsc.hadoopConfiguration())
        self.spark, self.folder = spark, self.files.makeQualified(self.path).toString()

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(self.path, name)

    def names(self) -> list[str]:
        if not self.files.exists(self.path):
            return []
        return [s.getPath().getName() for s in self.files.listStatus(self.path)]

    def read(self, name: str) -> str:
        stream = self.files.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def age(self, name: str) -> float:
        return time.time() - self.files.getFileStatus(self._at(name)).getModificationTime() / 1000

    def create(self, name: str, text: str) -> bool:
        """Write a new file; False if there is one of this name already."""
        self.files.mkdirs(self.path)
        local = urlparse(self.folder)
        if local.scheme == "file":
            # The local store of Hadoop looks first and creates afterwards; the system call does both at once.
            try:
                handle = os.open(os.path.join(unquote(local.path), name), os.O_CREAT | os.O_EXCL | os.O_WRONLY)
            except FileExistsError:
                return False
            with os.fdopen(handle, "w") as out:
                out.write(text)
            return True
        try:
            stream = self.files.create(self._at(name), False)
        except Exception as error:
            if self.files.exists(self._at(name)):
                return False
            raise error
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return True


def _last(store: Store) -> int:
    """The last id of the newest range; waits for a writer that is about to tell it."""
    starts = sorted(int(m[1]) for m in (re.fullmatch(r"from-(\d+)", n) for n in store.names()) if m)
    if not starts:
        return 0
    name = f"from-{starts[-1]:020d}"
    while not (text := store.read(name)).endswith("\n"):
        if store.age(name) > WRITE_SECONDS:
            raise RuntimeError(f"{store.folder}/{name} was begun and never written; remove it if its writer is gone")
        time.sleep(0.05)
    return int(text)


def reserve(spark: SparkSession, folder: str, count: int, beyond: int = 0) -> int:
    """The first of ``count`` ids above ``beyond`` and above every range given out before."""
    store = Store(spark, folder)
    while True:
        start = max(beyond, _last(store)) + 1
        if count < 1 or store.create(f"from-{start:020d}", f"{start + count - 1}\n"):
            return start
