"""New contents prepared beside what they replace, and put in its place when complete."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import SparkSession

from ledgerline.scratch import discard


class Replacement:
    """Folders, tables and files written under other names until :meth:`commit`.

    A load that fails before, or while its contents are put in place, leaves every target as it was. The new
    folder lies in the same parent, under a name Spark's listings pass over, so putting it in place is a
    rename on file systems that have one; an object store copies it.
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._paths: list[tuple[str, str]] = []
        self._tables: list[tuple[str, str]] = []
        self._files: list[tuple[str, str, list[str]]] = []
        self._partitions: list[tuple[str, str, int]] = []

    def __enter__(self) -> Replacement:
        return self

    def __exit__(self, failure, *_) -> None:
        if failure is None:
            self.commit()
        else:
            self.discard()

    def path(self, target: str) -> str:
        """Where to write what is to replace the folder ``target``."""
        parent, _, name = target.rstrip("/").rpartition("/")
        beside = f"{parent}/_new_{uuid.uuid4().hex}" if parent or name != target else f"_new_{uuid.uuid4().hex}"
        self._paths.append((beside, target.rstrip("/")))
        return beside

    def table(self, target: str) -> str:
        """The table to fill in place of ``target``, in the same database."""
        beside = _renamed(target, f"_new_{uuid.uuid4().hex}")
        self._tables.append((beside, target))
        return beside

    def files(self, folder: str, old: Sequence[str]) -> str:
        """Where to write the files that are to replace some files of a folder."""
        beside = f"{folder.rstrip('/')}/_new_{uuid.uuid4().hex}"
        self._files.append((beside, folder.rstrip("/"), list(old)))
        return beside

    def partitions(self, folder: str, depth: int) -> str:
        """Where to write partitions, ``depth`` folders deep, that are to replace those of the same names."""
        beside = f"{folder.rstrip('/')}/_new_{uuid.uuid4().hex}"
        self._partitions.append((beside, folder.rstrip("/"), depth))
        return beside

    def commit(self) -> None:
        """Put everything in place; the old contents go last.

        Each exchange first renames the old contents aside. If one fails, all are taken back, in
        reverse order, and the failure is raised.
        """
        undo: list[Callable[[], None]] = []
        aside: list[Callable[[], None]] = []
        try:
            for beside, target in self._paths:
                self._exchange_path(beside, target, undo, aside)
            for beside, folder, old in self._files:
                self._exchange_files(beside, folder, old, undo, aside)
            for beside, folder, depth in self._partitions:
                self._exchange_partitions(beside, folder, depth, undo, aside)
            for beside, target in self._tables:
                self._exchange_table(beside, target, undo, aside)
        except BaseException:
            for back in reversed(undo):
                back()
            self.discard()
            raise
        for drop in aside:
            drop()

    def discard(self) -> None:
        """Remove what was prepared."""
        discard(self._spark, *[beside for beside, *_ in self._paths + self._files + self._partitions])
        for beside, _ in self._tables:
            self._spark.sql(f"DROP TABLE IF EXISTS {beside}")

    def _place(self, path: str):
        place = self._spark._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration())

    def _move(self, source: str, target: str, undo: list | None = None) -> None:
        place, system = self._place(source)
        if not system.rename(place, self._place(target)[0]):
            raise RuntimeError(f"cannot move {source} to {target}")
        if undo is not None:
            undo.append(lambda: self._move(target, source))

    def _exchange_path(self, beside: str, target: str, undo: list, aside: list) -> None:
        old = beside.replace("_new_", "_old_")
        place, system = self._place(target)
        if system.exists(place):
            self._move(target, old, undo)
            aside.append(lambda: discard(self._spark, old))
        self._move(beside, target, undo)
        aside.append(lambda: self._spark.catalog.refreshByPath(target))

    def _exchange_files(self, beside: str, folder: str, files: list[str], undo: list, aside: list) -> None:
        old = beside.replace("_new_", "_old_")
        place, system = self._place(old)
        system.mkdirs(place)
        undo.append(lambda: discard(self._spark, old))
        for i, file in enumerate(files):
            # Names in a listing's metadata are encoded, those of the file system are not.
            self._move(unquote(file), f"{old}/{i}", undo)
        found = self._place(f"{beside}/*/part-*")[1].globStatus(self._place(f"{beside}/*/part-*")[0]) or ()
        for i, status in enumerate(found):
            name = status.getPath().getName()
            self._move(status.getPath().toString(), f"{folder}/{name.replace('part-', f'part-{i:05d}-', 1)}", undo)
        aside.append(lambda: discard(self._spark, old, beside))

    def _exchange_partitions(self, beside: str, folder: str, depth: int, undo: list, aside: list) -> None:
        old = beside.replace("_new_", "_old_")
        undo.append(lambda: discard(self._spark, old))
        pattern, system = self._place(beside + "/*=*" * depth)
        for status in system.globStatus(pattern) or ():
            new = status.getPath().toString()
            name = "/".join(new.split("/")[-depth:])
            for parent in (f"{folder}/{name}", f"{old}/{name}"):
                system.mkdirs(self._place(parent)[0].getParent())
            if system.exists(self._place(f"{folder}/{name}")[0]):
                self._move(f"{folder}/{name}", f"{old}/{name}", undo)
            self._move(new, f"{folder}/{name}", undo)
        aside.append(lambda: discard(self._spark, old, beside))
        aside.append(lambda: self._spark.catalog.refreshByPath(folder))

    def _exchange_table(self, beside: str, target: str, undo: list, aside: list) -> None:
        old = _renamed(target, f"_old_{uuid.uuid4().hex}")
        rename = lambda a, b: self._spark.sql(f"ALTER TABLE {a} RENAME TO {b}")
        if self._spark.catalog.tableExists(target):
            rename(target, old)
            undo.append(lambda: rename(old, target))
            aside.append(lambda: self._spark.sql(f"DROP TABLE IF EXISTS {old}"))
        rename(beside, target)
        undo.append(lambda: rename(target, beside))


def _renamed(table: str, suffix: str) -> str:
    """A name beside a table's, in the same database."""
    return f"{table[:-1]}{suffix}`" if table.endswith("`") else table + suffix
