"""Append to two data sets as one batch: after a crash anywhere, the next append brings both to the same batches."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift.sources.publish import Folder

#: Hidden folder in the first data set: what batches wait to be moved, and a mark for each that is in both.
BATCHES = "_batches"


def content_id(df: DataFrame) -> str:
    """A name for the rows of a table, whatever their order: equal rows give an equal name."""
    row = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    found = df.select(F.xxhash64(row).alias("a"), F.hash(row).cast("long").alias("b"))
    sums = found.agg(F.count("*").alias("n"), F.bit_xor("a").alias("x"), F.sum(F.pmod("a", F.lit(1 << 31))).alias("s"), F.sum("b").alias("t")).first()
    return f"{sums['n']}-{(sums['x'] or 0) & (1 << 64) - 1:016x}-{(sums['s'] or 0) & (1 << 64) - 1:016x}-{(sums['t'] or 0) & (1 << 64) - 1:016x}"


class PairedSink:
    """Two folders of part files that get each batch both or, until the next append, in part.

    A batch is first written whole into hidden folders of both; a mark says that it is complete. Then its files are
    renamed into the data sets, under names that hold the batch, and a second mark says that it is done. Renames can be
    repeated, so a batch that was left in between is finished by the next append, and one that is done is not taken again.
    """

    def __init__(self, spark: SparkSession, first: str, second: str):
        self.folders = Folder(spark, first), Folder(spark, second)

    def _waiting(self, folder: Folder, batch: str):
        return folder.new_path(folder.path, f"{BATCHES}/{batch}")

    def _mark(self, batch: str, state: str):
        return self.folders[0].new_path(self.folders[0].path, f"{BATCHES}/{batch}.{state}")

    def _set(self, batch: str, state: str) -> None:
        self.folders[0].files.create(self._mark(batch, state), True).close()

    def _is(self, batch: str, state: str) -> bool:
        return self.folders[0].files.exists(self._mark(batch, state))

    def finish(self, batch: str) -> None:
        """Move what still waits of a complete batch into the data sets."""
        for folder in self.folders:
            waiting = self._waiting(folder, batch)
            if folder.files.exists(waiting):
                for status in folder.files.listStatus(waiting):
                    name = status.getPath().getName()
                    if name.startswith("part-"):
                        folder.move(status.getPath(), folder.new_path(folder.path, f"part-{batch}-{name.removeprefix('part-')}"))
        self._set(batch, "done")
        for folder in self.folders:
            folder.files.delete(self._waiting(folder, batch), True)
        self.folders[0].files.delete(self._mark(batch, "complete"), False)

    def recover(self) -> None:
        """Finish the batches that a run had completed before it died."""
        folder = self.folders[0]
        marks = folder.new_path(folder.path, BATCHES)
        names = [s.getPath().getName() for s in folder.files.listStatus(marks)] if folder.files.exists(marks) else []
        for name in sorted(names):
            if name.endswith(".complete"):
                self.finish(name.removesuffix(".complete"))

    def append(self, first: DataFrame, second: DataFrame, batch: str) -> bool:
        """Append a batch to both data sets; False, and nothing is written, if it is there already."""
        if not re.fullmatch(r"[\w.-]+", batch):
            raise ValueError(f"{batch!r} is no name for a batch")
        self.recover()
        if self._is(batch, "done"):
            return False
        for folder, rows in zip(self.folders, (first, second)):
            rows.write.mode("overwrite").option("ignoreNullFields", "false").json(self._waiting(folder, batch).toString())
        self._set(batch, "complete")
        self.finish(batch)
        return True
