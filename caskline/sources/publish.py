"""Full reload of a table without a moment in which readers see it empty or half written.

Every reload writes a version folder of its own under the table's root, numbered and with a random
part, so that two writers never share one. When it is complete, its writer claims the next number by
creating a file that must not exist yet, and writes a small pointer of that number naming the version;
readers take the version of the highest pointer. Nothing is renamed, so this works on object
stores as well. Old versions stay until ``prune`` removes them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_VERSION, _POINTER, _CLAIM = "version=", "_current=", "_claim="


class _Folder:
    """A folder on whatever file system Spark reaches it, by the session's Hadoop client."""

    def __init__(self, spark: SparkSession, root: str):
        self._new = spark._jvm.org.apache.hadoop.fs.Path
        self.root = root
        self._fs = self._new(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, prefix: str) -> list[str]:
        folder = self._new(self.root)
        if not self._fs.exists(folder):
            return []
        found = [status.getPath().getName() for status in self._fs.listStatus(folder)]
        return sorted(name.removeprefix(prefix) for name in found if name.startswith(prefix))

    def touch(self, name: str) -> None:
        self._fs.create(self._new(f"{self.root}/{name}"), False).close()

    def claim(self, name: str) -> bool:
        """Create a file unless it is there already."""
        path = self._new(f"{self.root}/{name}")
        try:
            self._fs.create(path, False).close()
        except Py4JJavaError:
            if self._fs.exists(path):
                return False
            raise
        return True

    def remove(self, name: str) -> None:
        self._fs.delete(self._new(f"{self.root}/{name}"), True)


def _next_number(folder: _Folder) -> int:
    names = folder.names(_VERSION) + folder.names(_POINTER) + folder.names(_CLAIM)
    return max((int(name.split("-")[0]) for name in names), default=0) + 1


def _claimed_number(folder: _Folder) -> int:
    """A number that no other writer has, higher than those of all complete versions."""
    number = _next_number(folder)
    while not folder.claim(f"{_CLAIM}{number:08d}"):
        number += 1
    return number


def publish(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` as a new version of the table at ``root`` and return the version's path.

    Of two reloads at a time, the one that claims its number last is current: numbers are claimed when the
    version is complete, each by one writer.
    """
    folder = _Folder(df.sparkSession, root)
    version = f"{_next_number(folder):08d}-{uuid.uuid4().hex[:12]}"
    path = f"{root}/{_VERSION}{version}"
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    folder.touch(f"{_POINTER}{_claimed_number(folder):08d}-{version}")
    return path


def _complete(folder: _Folder) -> list[str]:
    """Complete versions, the current one last."""
    pointers = folder.names(_POINTER)
    return list(dict.fromkeys(name.split("-", 1)[1] for name in pointers))


def has_version(spark: SparkSession, root: str) -> bool:
    return bool(_complete(_Folder(spark, root)))


def current_path(spark: SparkSession, root: str) -> str:
    """Path of the current version."""
    complete = _complete(_Folder(spark, root))
    if not complete:
        raise FileNotFoundError(f"no complete version of a table under {root}")
    return f"{root}/{_VERSION}{complete[-1]}"


def read_published(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(current_path(spark, root))


def prune(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove all but the last ``keep`` complete versions; returns the names of those removed.

    Versions without a pointer stay: a reload may be writing them. Readers of a removed version fail,
    so ``keep`` has to cover the longest query.
    """
    if keep < 1:
        raise ValueError("the current version has to stay")
    folder = _Folder(spark, root)
    old = _complete(folder)[:-keep]
    for version in old:
        for name in folder.names(_POINTER):
            if name.split("-", 1)[1] == version:
                folder.remove(f"{_POINTER}{name}")
                folder.remove(f"{_CLAIM}{name.split('-')[0]}")
        folder.remove(f"{_VERSION}{version}")
    return old
