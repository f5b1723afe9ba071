"""The few file-system calls that Spark's writers do not cover, through Hadoop's own client so that any scheme works."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession


SUCCESS_FILE = "_SUCCESS"


class Folder:
    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.path = path.rstrip("/")
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def touch(self, name: str) -> None:
        self._fs.create(self._at(name), True).close()

    def write_text(self, name: str, text: str) -> None:
        """A small file, there in full or not at all."""
        draft = f"{name}.draft"
        out = self._fs.create(self._at(draft), True)
        out.write(text.encode())
        out.close()
        self.remove(name)
        self.rename(draft, name)

    def read_text(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def rename(self, name: str, to: str) -> None:
        """Move a file or folder; its new parent is made if need be."""
        target = self._at(to)
        self._fs.mkdirs(target.getParent())
        if not self._fs.rename(self._at(name), target):
            raise OSError(f"cannot move {name} to {to} in {self.path}")

    def is_folder(self, name: str = "") -> bool:
        return self.exists(name) and self._fs.getFileStatus(self._at(name)).isDirectory()

    def children(self, name: str = "") -> list[str]:
        """Names directly inside a subfolder."""
        return [s.getPath().getName() for s in self._fs.listStatus(self._at(name))] if self.exists(name) else []

    def age_seconds(self, name: str) -> float:
        return time.time() - self._fs.getFileStatus(self._at(name)).getModificationTime() / 1000

    def files_below(self, name: str) -> list[str]:
        """Files under a subfolder, relative to it."""
        if not self.exists(name):
            return []
        base = self._fs.makeQualified(self._at(name)).toString()
        found, listing = [], self._fs.listFiles(self._at(name), True)
        while listing.hasNext():
            found.append(listing.next().getPath().toString()[len(base) + 1 :])
        return found


def partition_folder(columns: list[str], values) -> str:
    """``a=1/b=x`` for one combination of partition values, escaped as Spark's writer escapes it."""
    return "/".join(f"{c}={_escape(v)}" for c, v in zip(columns, values))


# Characters that partition folder names escape, and the folder of a null or empty value.
ESCAPED = set("\"#%'*/:=?\\\x7f{[]^") | {chr(i) for i in range(1, 32)}
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _escape(value) -> str:
    if value is None or value == "":
        return NULL_FOLDER
    return "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in str(value))
