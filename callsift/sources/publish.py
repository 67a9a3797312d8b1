"""Publish a folder as a whole: readers see the old data set or the new one, never a part of either.

A run writes beside the target, in a hidden folder. When all is written and checked, that folder gets the name of a
complete one; from there on the publication goes forward, by this run or by the next one that finds it: the old data set
steps aside, the new one takes its name, the old one is deleted. A run that dies before leaves the target as it was.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import SparkSession

Result = TypeVar("Result")

#: Seconds without a change after which an unfinished folder is taken for that of a dead run.
DEAD_AFTER = 24 * 3600


class Folder:
    """The target of a publication and the hidden folders beside it, on whatever file system holds them."""

    def __init__(self, spark: SparkSession, target: str):
        jvm = spark._jvm
        self.new_path = jvm.org.apache.hadoop.fs.Path
        self.path = self.new_path(target)
        self.files = self.path.getFileSystem(spark._jsc.hadoopConfiguration())
        self.path = self.files.makeQualified(self.path)
        self.parent, self.name = self.path.getParent(), self.path.getName()

    def beside(self, stage: str, run: str):
        return self.new_path(self.parent, f".{self.name}.{stage}-{run}")

    def found(self, stage: str) -> dict[str, object]:
        """run -> path of the hidden folders of a stage."""
        if not self.files.exists(self.parent):
            return {}
        head = f".{self.name}.{stage}-"
        names = [status.getPath() for status in self.files.listStatus(self.parent)]
        return {p.getName().removeprefix(head): p for p in names if p.getName().startswith(head)}

    def move(self, old, new) -> None:
        """Rename to a name that is free; Hadoop would move into an existing folder."""
        if self.files.exists(new) or not self.files.rename(old, new):
            raise OSError(f"{old} could not be renamed to {new}")

    def changed(self, path) -> float:
        """Seconds since the newest change at or right under a path."""
        times = [s.getModificationTime() for s in [self.files.getFileStatus(path), *self.files.listStatus(path)]]
        return time.time() - max(times) / 1000


def _forward(folder: Folder, run: str) -> None:
    """Put a complete folder in the target's place; may be repeated after a crash at any point."""
    ready, old = folder.beside("ready", run), folder.beside("old", run)
    if folder.files.exists(ready):
        if folder.files.exists(folder.path):
            folder.move(folder.path, old)
        folder.move(ready, folder.path)
    folder.files.delete(old, True)


def recover(spark: SparkSession, target: str, dead_after: float = DEAD_AFTER) -> None:
    """Finish what a run had completed before it died, and delete what others left unfinished."""
    folder = Folder(spark, target)
    ready = folder.found("ready")
    for run in sorted(ready, key=lambda r: folder.files.getFileStatus(ready[r]).getModificationTime()):
        _forward(folder, run)
    for path in folder.found("old").values():  # the target is in place, or it stepped aside and its successor is lost
        if folder.files.exists(folder.path):
            folder.files.delete(path, True)
        else:
            folder.move(path, folder.path)
    for path in folder.found("next").values():
        if folder.changed(path) > dead_after:
            folder.files.delete(path, True)


def publish(spark: SparkSession, target: str, write: Callable[[str], Result], dead_after: float = DEAD_AFTER) -> Result:
    """Run `write(path)`, which writes and checks a data set at `path`, and publish that as `target`.

    Returns what `write` returns. If it fails, its folder goes and the target stays as it was, also where there was none.
    The old data set may be an input of the new one. One run at a time may publish a target; the last one wins.
    """
    recover(spark, target, dead_after)
    folder, run = Folder(spark, target), uuid.uuid4().hex
    beside = folder.beside("next", run)
    try:
        result = write(beside.toString())
        if not folder.files.exists(beside):
            raise FileNotFoundError(f"nothing was written for {target}")
        folder.move(beside, folder.beside("ready", run))
    except BaseException:
        folder.files.delete(beside, True)
        raise
    _forward(folder, run)
    return result
