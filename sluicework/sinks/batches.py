"""Several tables as one unit of work.

Every table is written under its batch id. What is visible is a numbered version: a small file with the
ids of the visible batches, written after their rows. A version is made once, by one publisher; another
one that wanted the same number starts again from it, so nobody's batch is lost. A reader sees all tables
of a batch or none, and can stay at a version or go back to one. A batch written again replaces its
files: a repeated attempt leaves no copies.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.session import shuffles_freed
from sluicework.sinks import files

BATCH = "batch_id"


class BatchStore:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _versions(self, kind: str = "_versions") -> list[int]:
        return [int(n) for n in files.names(self.spark, f"{self.root}/{kind}") if n.isdigit()]

    def write(self, batch_id: int, tables: Mapping[str, DataFrame]) -> None:
        """Writes the rows of one batch of every table; they stay invisible.

        What a table was shuffled for goes before the next table is written.
        """
        for name, df in tables.items():
            with shuffles_freed(df.sparkSession):
                df.drop(BATCH).write.mode("overwrite").parquet(f"{self._path(name)}/{BATCH}={batch_id}", compression="zstd")

    def discard(self, batch_id: int, tables: Iterable[str]) -> None:
        """Deletes the rows of one batch in tables that are no part of what readers see."""
        for name in tables:
            files.delete(self.spark, f"{self._path(name)}/{BATCH}={batch_id}")

    def write_all(self, tables: Mapping[str, DataFrame]) -> None:
        """Writes rows that carry their batch id. Only the batches that occur are replaced.

        The rebalance hint gathers a batch into few files and still splits a large one.
        """
        for name, df in tables.items():
            (
                df.hint("rebalance", BATCH).write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(BATCH)
                .parquet(self._path(name))
            )

    def publish(self, batch_ids: Iterable[int], without: Iterable[int] = ()) -> int:
        """Makes batches visible, and those of ``without`` invisible, all at once; gives the version.

        What others published meanwhile stays. A change that is there already makes no new version.
        """
        added, removed = set(batch_ids), set(without)
        return self._change(lambda seen: (seen - removed) | added)

    def publish_only(self, batch_ids: Iterable[int]) -> int:
        """Makes exactly these batches visible, whatever others published."""
        only = set(batch_ids)
        return self._change(lambda seen: only)

    def _change(self, change: Callable[[set[int]], set[int]]) -> int:
        while True:
            version = self.version()
            seen = set(self.published(version))
            ids = change(seen)
            if ids == seen:
                return version
            path = f"{self.root}/_versions/{version + 1:020d}"
            if files.create_once(self.spark, path, "\n".join(map(str, sorted(ids)))):
                return version + 1

    def version(self) -> int:
        """The number of the last version; 0 before the first."""
        return max(self._versions(), default=0)

    def published(self, version: int | None = None) -> list[int]:
        """The batch ids visible at a version (the last one): one number per batch, never rows."""
        version = self.version() if version is None else version
        if version == 0:
            return []
        if version < max(self._versions("_kept_from"), default=0):
            raise ValueError(f"the batches of version {version} were removed")
        return [int(line) for line in files.text_of(self.spark, f"{self.root}/_versions/{version:020d}").split()]

    def read(self, table: str, batch_ids: Sequence[int] | None = None, version: int | None = None) -> DataFrame:
        """The published rows of a table at a version; other batches are pruned, not read.

        Give one version, or the ids of one ``published()`` call, to read several tables of the same state.
        """
        ids = self.published(version) if batch_ids is None else list(batch_ids)
        return self.spark.read.parquet(self._path(table)).filter(F.col(BATCH).isin(ids))

    def remove_unused(self, tables: Iterable[str], keep: int = 1) -> list[int]:
        """Deletes the batches that none of the last ``keep`` versions shows, and gives their ids.

        Older versions can't be read afterwards. Batches never published are left: they may be in the
        making. The version files stay (some bytes each), so no number is ever given twice.
        """
        versions = sorted(self._versions())
        floor = max(self._versions("_kept_from"), default=0)
        old, kept = versions[:-keep], versions[-keep:]
        if not old or kept[0] <= floor:
            return []
        used = {i for v in kept for i in self.published(v)}
        unused = sorted({i for v in old if v >= floor for i in self.published(v)} - used)
        files.create_once(self.spark, f"{self.root}/_kept_from/{kept[0]:020d}", "")
        for i in unused:
            for name in tables:
                files.delete(self.spark, f"{self._path(name)}/{BATCH}={i}")
        return unused
