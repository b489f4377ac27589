"""Published tables as snapshots: immutable folders, and a manifest that is written last.

Every write of a table goes into a folder of its own, `<table>/version=<id>`, which nothing
changes afterwards. A snapshot is a manifest, `_snapshots/<number>.json`, that names the folders
of each table. It gets its name in one step, a rename that does not overwrite, and only after all
its folders are complete, so readers see the old snapshot or the new one and never a mixture. A
publish that dies leaves folders no manifest names.

A snapshot may take over folders of the one before it, so replacing some partitions costs only
those. Manifests are numbered, and creating one fails if the number exists: of two publishers
that start from the same snapshot one wins, and the other has to start again.

Manifests hold folder names, at most one for each table and partition; rows stay out of the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import cached_property
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from stockflow import contract

MANIFESTS = "_snapshots"
VERSION = "version"

Partition = dict[str, str]


class SnapshotConflict(RuntimeError):
    """Another publisher was faster; what was to be replaced may have changed."""


@dataclass(frozen=True)
class Snapshot:
    """One manifest: the folders of each table, and facts noted by its publisher."""

    number: int
    as_of: str | None = None
    tables: dict[str, list[str]] = field(default_factory=dict)
    facts: dict[str, object] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"as_of": self.as_of, "tables": self.tables, "facts": self.facts}, sort_keys=True)


NONE = Snapshot(0)


def partition_of(folder: str) -> Partition:
    """Partition values from a folder's name, without the version and the verdict."""
    pairs = (part.split("=", 1) for part in folder.split("/") if "=" in part)
    return {name: unquote(value) for name, value in pairs if name not in (VERSION, contract.VERDICT)}


class Store:
    """The snapshots under one folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    # --- files -----------------------------------------------------------------------

    def _path(self, name: str):
        return self._hadoop.Path(f"{self.folder}/{name}")

    @cached_property
    def _hadoop(self):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs

    @cached_property
    def _files(self):
        return self._path("").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, name: str) -> list[str]:
        path = self._path(name)
        return sorted(s.getPath().getName() for s in self._files.listStatus(path)) if self._files.exists(path) else []

    def _text(self, name: str) -> str:
        stream = self._files.open(self._path(name))
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _create(self, name: str, text: str) -> bool:
        """A new file that is complete as soon as it has its name; False if there is one already."""
        context = self.spark.sparkContext
        hadoop = self._hadoop
        target, draft = self._path(name), self._path(f"{MANIFESTS}/.{uuid.uuid4().hex}")
        stream = self._files.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        here = hadoop.FileContext.getFileContext(target.toUri(), context._jsc.hadoopConfiguration())
        no_options = context._gateway.new_array(hadoop.Options.Rename, 0)
        try:
            here.rename(draft, target, no_options)
        except Py4JJavaError as error:
            self._files.delete(draft, False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    # --- reading -----------------------------------------------------------------------

    def history(self) -> list[Snapshot]:
        """All snapshots, oldest first."""
        names = [n for n in self._names(MANIFESTS) if not n.startswith(".")]
        found = [Snapshot(int(n.removesuffix(".json")), **json.loads(self._text(f"{MANIFESTS}/{n}"))) for n in names]
        return sorted(found, key=lambda s: s.number)

    def latest(self, as_of: str | None = None) -> Snapshot:
        """The last snapshot, or the last one of an as-of date."""
        found = [s for s in self.history() if as_of is None or s.as_of == str(as_of)]
        if not found:
            raise LookupError(f"no snapshot {'' if as_of is None else f'as of {as_of} '}in {self.folder}")
        return found[-1]

    def current(self) -> Snapshot:
        """The last snapshot, or an empty one before the first."""
        return max(self.history(), key=lambda s: s.number, default=NONE)

    def read(
        self,
        table: str,
        schema: str,
        partitions: Iterable[str] = (),
        snapshot: Snapshot | None = None,
        where: Callable[[Partition], bool] | None = None,
    ) -> DataFrame:
        """A table of a snapshot under its declared schema; `where` leaves out whole folders.

        Partition columns that the schema does not have come last, as text.
        """
        folders = (snapshot or self.latest()).tables[table]
        if where is not None:
            folders = [f for f in self.leaves(folders) if partition_of(f) and where(partition_of(f))]
        names = contract.column_names(schema)
        more = [p for p in partitions if p not in names]
        if not folders:
            declared = ", ".join([schema, *[f"{p} string" for p in more]])
            return self.spark.createDataFrame([], declared).select(*names, *more)
        declared = ", ".join([schema, *[f"{p} string" for p in more], f"{VERSION} string"])
        reader = self.spark.read.schema(declared).option("basePath", f"{self.folder}/{table}")
        return reader.parquet(*[f"{self.folder}/{f}" for f in folders]).select(*names, *more)

    def leaves(self, folders: list[str]) -> list[str]:
        """The folders of single partitions below `folders`; a folder without any stands for itself.

        All partitions of a table lie at one depth, so one of them shows where they end.
        """
        found = []
        for folder in folders:
            level, deeper = [folder], not partition_of(folder)
            while deeper and (below := self.parts(level[0])):
                level = [*below, *(leaf for other in level[1:] for leaf in self.parts(other))]
            found += level
        return found

    def parts(self, folder: str) -> list[str]:
        """The partition folders right below a folder."""
        return [f"{folder}/{name}" for name in self._names(folder) if "=" in name]

    # --- writing -----------------------------------------------------------------------

    def draft(self, parent: Snapshot | None = None) -> Draft:
        """A snapshot to be: empty, or with the tables of `parent`."""
        return Draft(self, parent)

    def expire(self, keep: int) -> list[str]:
        """Remove all but the last `keep` snapshots, and the folders that only those had."""
        if keep < 1:
            raise ValueError("the last snapshot stays")
        history = self.history()
        old, kept = history[:-keep], history[-keep:]
        needed = [f for s in kept for own in s.tables.values() for f in own]
        unused = {f for s in old for own in s.tables.values() for f in own}
        # a folder taken over in part is still needed: its partitions go one by one
        unused = {leaf for f in unused for leaf in ([f] if not any(n.startswith(f"{f}/") for n in needed) else self.leaves([f]))}
        gone = sorted(f for f in unused if not any(f == n or f.startswith(f"{n}/") for n in needed))
        files = self._files
        for snapshot in old:
            files.delete(self._path(f"{MANIFESTS}/{snapshot.number:08d}.json"), False)
        for folder in gone:
            files.delete(self._path(folder), True)
        return gone


class Draft:
    """Folders written for a snapshot that nobody sees before `commit`."""

    def __init__(self, store: Store, parent: Snapshot | None) -> None:
        self.store = store
        self.parent = parent
        self.tables: dict[str, list[str]] = {name: list(own) for name, own in parent.tables.items()} if parent else {}

    def new_folder(self, table: str) -> str:
        """Where the next version of a table goes, relative to the store."""
        return f"{table}/{VERSION}={uuid.uuid4().hex}"

    def path(self, folder: str) -> str:
        return f"{self.store.folder}/{folder}"

    def replace(self, table: str, write: Callable[[str], None]) -> str:
        """A new version of the whole table; `write` gets its path."""
        folder = self.new_folder(table)
        write(self.path(folder))
        self.tables[table] = [folder]
        return folder

    def append(self, table: str, write: Callable[[str], None]) -> None:
        """More rows beside the table's own."""
        before = self.tables.get(table, [])
        self.tables[table] = [*before, self.replace(table, write)]

    def replace_where(self, table: str, write: Callable[[str], None], scope: Callable[[Partition], bool] | None = None) -> None:
        """New rows for some partitions, the others taken over.

        `scope` names the partitions that go, whether or not there are new rows for them;
        without it those go that get new rows.
        """
        before = self.store.leaves(self.tables.get(table, []))
        written = self.store.leaves([self.replace(table, write)])
        new = [partition_of(f) for f in written]
        goes = scope or (lambda p: p in new)
        stays = [f for f in before if partition_of(f) and not goes(partition_of(f))]
        outside = [p for p in new if scope and p and not scope(p)]
        if outside:
            raise ValueError(f"rows outside the partitions to be replaced: {outside[:3]}")
        # a folder without partitions holds no rows and is needed only where nothing else is left
        self.tables[table] = [*stays, *(f for f in written if partition_of(f) or not stays)]

    def commit(self, as_of: object = None, facts: dict[str, object] | None = None) -> Snapshot:
        """Make the snapshot visible.

        One that took over folders must follow its parent; one of new folders only takes the
        next free number.
        """
        number = (self.parent or self.store.current()).number + 1
        while True:
            snapshot = Snapshot(number, None if as_of is None else str(as_of), self.tables, facts or {})
            if self.store._create(f"{MANIFESTS}/{number:08d}.json", snapshot.text()):
                return snapshot
            if self.parent:
                raise SnapshotConflict(f"snapshot {number} exists; read it and start again")
            number += 1
