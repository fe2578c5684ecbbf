"""A table published in versions: readers keep the version they opened, writers add the next one.

A version is claimed by creating a file of its number, which only one writer can; its rows are
written to a folder of their own; creating the version's marker, an empty file, makes it the
latest in one step.  Nothing is renamed or overwritten, so a publish that fails
leaves the version before it, also on object stores.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class VersionedTable:
    """Versions of a table below one folder: ``claims/n``, ``data/n`` and, once complete, ``versions/n``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _numbers(self, kind: str) -> list[int]:
        folder = self._path(f"{self.root}/{kind}")
        if not self._files.exists(folder):
            return []
        return sorted(int(f.getPath().getName()) for f in self._files.listStatus(folder) if f.getPath().getName().isdigit())

    def _name(self, kind: str, number: int) -> str:
        return f"{self.root}/{kind}/{number:012d}"

    def _remove(self, kind: str, number: int) -> None:
        self._files.delete(self._path(self._name(kind, number)), True)

    def versions(self) -> list[int]:
        """Numbers of the complete versions, the latest last."""
        return self._numbers("versions")

    def _claim(self) -> int:
        number = max([0, *self._numbers("claims"), *self.versions()]) + 1
        self._files.mkdirs(self._path(f"{self.root}/claims"))
        while not self._files.createNewFile(self._path(self._name("claims", number))):  # another writer was first
            number += 1
        return number

    def publish(self, df: DataFrame, finish: Callable[[DataFrame], DataFrame] = lambda staged: staged, keep: int = 2) -> int:
        """Stage the rows, build the final table from them and make it the latest version; its number.

        The staged rows go when the final ones are written.  ``keep`` versions stay, for readers of the one before.
        """
        if keep < 1:
            raise ValueError("at least one version stays")
        number = self._claim()
        try:
            df.write.parquet(self._name("staging", number))
            finish(self.spark.read.schema(df.schema).parquet(self._name("staging", number))).write.parquet(self._name("data", number))
        except BaseException:
            self._remove("data", number)
            raise
        finally:
            self._remove("staging", number)
        self._files.mkdirs(self._path(f"{self.root}/versions"))
        self._files.createNewFile(self._path(self._name("versions", number)))
        self._retain(keep)
        return number

    def _retain(self, keep: int) -> None:
        """Remove versions before the last few: first their markers, then rows and claims."""
        kept = self.versions()[-keep:]
        for kind in ("versions", "data", "claims"):
            for number in self._numbers(kind):
                if number < kept[0]:  # claims of running writers are later than the first version that stays, or its rows are unread
                    self._remove(kind, number)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the latest by default; what is read later is still that version."""
        known = self.versions()
        if not known or (version is not None and version not in known):
            raise ValueError(f"{self.root} has no version{'' if version is None else f' {version}'}")
        return self.spark.read.parquet(self._name("data", known[-1] if version is None else version))
