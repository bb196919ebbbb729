"""Which folders hold a table: a log of small pointer files, of which the newest whole one counts.

Rows are written to a fresh folder, and a new pointer file, written last, makes them the table's.
Nothing is renamed or overwritten, so the scheme holds where a rename is a copy: a reader finds
the old rows or the new ones, and a failure at any step leaves the old ones. A pointer file that
was cut short is not JSON and is passed over. Replaced folders stay readable for a while.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

POINTERS = "_pointer"
PLAIN = "*.parquet"  # files of a table that was there before its first pointer
KEPT = 8  # pointer files, the newest
TRIES = 20  # of writers that meet

Folders = dict[str, str]


@dataclass
class State:
    """``folders`` by day (or '' for a table without days), below the table's path; ``retired``
    ones with the second of their replacement; the table's ``schema`` as JSON."""

    folders: Folders = field(default_factory=dict)
    retired: dict[str, float] = field(default_factory=dict)
    schema: str | None = None


class Files:
    """The file system that holds a path."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._io = spark._jvm.org.apache.commons.io.IOUtils
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.store = self._path(path).getFileSystem(conf)

    def exists(self, path: str) -> bool:
        return self.store.exists(self._path(path))

    def children(self, path: str) -> list[tuple[str, bool]]:
        """Name of each entry of a folder, and whether it is a folder."""
        if not self.exists(path):
            return []
        found = self.store.listStatus(self._path(path))
        return sorted((s.getPath().getName(), s.isDirectory()) for s in found)

    def older(self, path: str, seconds: float) -> list[str]:
        """Names of a folder's entries last changed more than ``seconds`` ago."""
        if not self.exists(path):
            return []
        limit = (time.time() - seconds) * 1000
        found = self.store.listStatus(self._path(path))
        return [s.getPath().getName() for s in found if s.getModificationTime() < limit]

    def remove(self, path: str) -> None:
        """Delete a folder, or the plain files of one that has other entries too."""
        folder, name = path.rsplit("/", 1)
        names = [name]
        if name == PLAIN:
            names = [n for n, inner in self.children(folder) if n.endswith(".parquet") and not inner]
        for each in names:
            self.store.delete(self._path(f"{folder}/{each}"), True)

    def text(self, path: str) -> str:
        stream = self.store.open(self._path(path))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Write a file that must not exist yet; False if it does."""
        try:
            stream = self.store.create(self._path(path), False)
        except Py4JJavaError:
            if self.exists(path):
                return False
            raise
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return True


class Pointer:
    """The pointer log of the table at ``path``; replaced folders are deleted after ``retain``
    seconds, by a later change."""

    def __init__(self, spark: SparkSession, path: str, retain: float):
        self.spark, self.path, self.retain = spark, path, retain
        self.files = Files(spark, path)

    def _numbers(self) -> list[int]:
        names = [name for name, _ in self.files.children(f"{self.path}/{POINTERS}")]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _file(self, number: int) -> str:
        return f"{self.path}/{POINTERS}/{number:012d}.json"

    def _read(self, number: int) -> State | None:
        try:
            return State(**json.loads(self.files.text(self._file(number))))
        except ValueError:
            return None
        except Py4JJavaError as error:
            # Cut short, or removed by a writer that has written newer ones.
            kind = error.java_exception.getClass().getSimpleName()
            if kind in ("ChecksumException", "FileNotFoundException", "EOFException"):
                return None
            raise

    def newest(self) -> tuple[int, State | None]:
        """The highest number in use, and the state of the newest whole file."""
        numbers = self._numbers()
        for number in reversed(numbers):
            state = self._read(number)
            if state is not None:
                return numbers[-1], state
        return (numbers[-1] if numbers else 0), None

    def current(self) -> State | None:
        return self.newest()[1]

    def change(
        self,
        update: Callable[[Folders], Folders],
        schema: str | None = None,
        replaced: frozenset[str] = frozenset(),
    ) -> None:
        """Make ``update`` of the folders the table's. It is applied anew if another writer was
        first, so changes of different days do not undo each other. ``replaced`` names further
        folders that are no longer in use."""
        for _ in range(TRIES):
            number, state = self.newest()
            state = state or State()
            folders, now = update(dict(state.folders)), time.time()
            left = (set(state.folders.values()) | replaced) - set(folders.values())
            retired = state.retired | {folder: now for folder in left}
            gone = [f for f, at in retired.items() if now - at >= self.retain]
            kept = {f: at for f, at in retired.items() if f not in gone}
            new = State(folders, kept, schema or state.schema)
            if self.files.create(self._file(number + 1), json.dumps(vars(new))):
                self._forget(gone, number + 1)
                return
        raise OSError(f"{self.path} is changed by others all the time")

    def _forget(self, folders: list[str], number: int) -> None:
        for folder in folders:
            self.files.remove(f"{self.path}/{folder}")
            above = folder.rpartition("/")[0]
            if above and not self.files.children(f"{self.path}/{above}"):
                self.files.remove(f"{self.path}/{above}")
        for old in self._numbers():
            if old <= number - KEPT:
                self.files.remove(self._file(old))
