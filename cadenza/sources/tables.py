"""Day-partitioned tables, kept as Parquet folders or catalog tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from cadenza.functions.dates import DAY_FORMAT, shift_day
from cadenza.session import remove_path
from cadenza.sources.versions import PLAIN, Files, Pointer

DAY = "data_dt"
RETAIN = 86_400.0  # seconds for which replaced rows stay readable
VERSION = "version"
_VERSIONS = "_versions"  # of catalog tables; Spark does not read folders with an underscore
_ROWS = "rows"


def on_day(df: DataFrame, day: str) -> DataFrame:
    """Rows of one day. A text literal, so the partition filter needs no cast."""
    return df.where(F.col(DAY) == F.lit(day))


def between_days(df: DataFrame, first: str, last: str) -> DataFrame:
    """Rows of ``first``..``last``, both ends included."""
    return df.where(F.col(DAY).between(F.lit(first), F.lit(last)))


def _fresh() -> str:
    return f"v{uuid.uuid4().hex}"


class Warehouse:
    """Tables below a folder, or in a database of the session's catalog.

    Every write goes to a fresh folder that becomes the table's, or the day's, in one last
    step: a new pointer file (folders), or the location in the catalog. A failed write leaves the
    old rows, and readers see old or new ones. Replaced rows are deleted after ``retain``
    seconds by a later write. A folder without pointers, written by others, is read as it is.
    With ``external`` new catalog tables are external ones below that folder.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str | None = None,
        database: str | None = None,
        external: str | None = None,
        retain: float = RETAIN,
    ):
        if (root is None) == (database is None):
            raise ValueError("give either root or database")
        self.spark = spark
        self.root = root.rstrip("/") if root else None
        self.database = database
        self.external = external.rstrip("/") if external else None
        self.retain = retain

    def _path(self, table: str) -> str:
        return f"{self.root}/{table.lower()}"

    def _name(self, table: str) -> str:
        return f"{self.database}.{table.lower()}"

    def _pointer(self, table: str) -> Pointer:
        return Pointer(self.spark, self._path(table), self.retain)

    def _save(self, writer: DataFrameWriter, table: str) -> None:
        """Write a catalog table that is absent."""
        if self.external:
            writer = writer.option("path", f"{self.external}/{table.lower()}")
        writer.format("parquet").saveAsTable(self._name(table))

    def read(self, table: str) -> DataFrame:
        """The whole table; the day stays text whatever its digits look like."""
        if self.database:
            return self.spark.table(self._name(table))
        path, state = self._path(table), self._pointer(table).current()
        if state is None:
            return self._read_files([path], path)
        return self._read_folders(list(state.folders.items()), path, state.schema)

    def read_days(self, table: str, first: str, last: str | None = None) -> DataFrame:
        """Rows of ``first``..``last``, or of one day. A folder's other days are not even
        listed, so the cost does not grow with the table's history."""
        last = last or first
        if self.root:
            path, state = self._path(table), self._pointer(table).current()
            span = datetime.strptime(last, DAY_FORMAT) - datetime.strptime(first, DAY_FORMAT)
            days = [shift_day(first, n) for n in range(span.days + 1)]
            if state is None:
                known = {day: f"{DAY}={day}" for day in days if self._has(f"{path}/{DAY}={day}")}
            else:
                known = state.folders
            folders = [(day, known[day]) for day in days if day in known]
            if folders:
                return self._read_folders(folders, path, state.schema if state else None)
        return between_days(self.read(table), first, last)

    def days(self, table: str) -> set[str]:
        """The days that have been written, empty ones of folder tables too."""
        if not self.exists(table):
            return set()
        if self.database:
            found = self.spark.sql(f"SHOW PARTITIONS {self._name(table)}").collect()
            return {row[0].split("=", 1)[1] for row in found}
        state = self._pointer(table).current()
        return set(state.folders if state else self._plain_folders(table)) - {""}

    def _read_folders(
        self, folders: list[tuple[str, str]], path: str, schema: str | None
    ) -> DataFrame:
        places = [f"{path}/{folder}" for _, folder in folders]
        if not places:
            return self.spark.createDataFrame([], StructType.fromJson(json.loads(schema)))
        if folders[0][0] == "":
            return self.spark.read.parquet(*places)
        # Days from before the first pointer have no version in their path.
        plain = [p for p, (_, f) in zip(places, folders, strict=True) if not f.startswith(VERSION)]
        versions = [p for p in places if p not in plain]
        parts = [self._read_files(p, path) for p in (plain, versions) if p]
        rows = parts[0].drop(VERSION)
        return rows.unionByName(parts[1].drop(VERSION)) if len(parts) > 1 else rows

    def _read_files(self, paths: list[str], base: str) -> DataFrame:
        reader = self.spark.read.option("basePath", base)
        rows = reader.parquet(*paths)
        schema = rows.schema
        if DAY not in schema.names or schema[DAY].dataType == StringType():
            return rows
        schema[DAY].dataType = StringType()
        return reader.schema(schema).parquet(*paths)

    def _has(self, path: str) -> bool:
        return Files(self.spark, path).exists(path)

    def _plain_folders(self, table: str) -> dict[str, str]:
        """What a folder without pointers holds."""
        path = self._path(table)
        found = Files(self.spark, path).children(path)
        days = [name for name, folder in found if folder and name.startswith(f"{DAY}=")]
        if days:
            return {name.split("=", 1)[1]: name for name in days}
        return {"": PLAIN} if any(name.endswith(".parquet") for name, _ in found) else {}

    def exists(self, table: str) -> bool:
        if self.database:
            return self.spark.catalog.tableExists(self._name(table))
        return self._pointer(table).current() is not None or bool(self._plain_folders(table))

    @contextmanager
    def _staged(self, fresh: str, used: Callable[[], bool], inner: str = "") -> Iterator[str]:
        """A ``fresh`` folder, or one inside it, for rows that nothing points to yet. After a
        failure it is deleted, unless the failure came when it was ``used`` already."""
        try:
            yield fresh + inner
        except BaseException:
            if not used():
                remove_path(self.spark, fresh)
            raise

    @contextmanager
    def _version(self, pointer: Pointer, folder: str) -> Iterator[str]:
        def used() -> bool:
            state = pointer.current()
            return state is not None and any(
                f == folder or f.startswith(f"{folder}/") for f in state.folders.values()
            )

        fresh, inner, day = folder.partition("/")
        with self._staged(f"{pointer.path}/{fresh}", used, inner + day) as place:
            yield place

    def _adopted(self, table: str) -> Pointer:
        """The table's pointer; a folder without one gets it before anything is staged in it."""
        pointer = self._pointer(table)
        if pointer.current() is None:
            plain = self._plain_folders(table)
            if plain:
                pointer.change(lambda folders: folders or plain)
        return pointer

    def replace(self, df: DataFrame, table: str) -> None:
        """Overwrite a table that has no day partition."""
        if self.database:
            self._replace_catalog(df, table)
            return
        pointer, version = self._adopted(table), f"{VERSION}={_fresh()}"
        with self._version(pointer, version) as place:
            df.write.parquet(place)
            pointer.change(lambda _: {"": version}, df.schema.json())

    def load_days(self, df: DataFrame, table: str) -> None:
        """First load of many days. Rebalancing gathers each day into few files and
        splits a day that is too large for one."""
        if self.exists(table):
            raise ValueError(f"{table} is there already")
        writer = df.hint("rebalance", DAY).write.partitionBy(DAY)
        if self.database:
            self._save(writer, table)
            return
        pointer, version = self._pointer(table), f"{VERSION}={_fresh()}"
        with self._version(pointer, version) as place:
            writer.parquet(place)
            names = [name for name, folder in pointer.files.children(place) if folder]
            days = {n.split("=", 1)[1]: f"{version}/{n}" for n in names if n.startswith(f"{DAY}=")}
            pointer.change(lambda folders: folders | days, df.schema.json())

    def replace_day(self, df: DataFrame, table: str, day: str) -> None:
        """Overwrite one day and leave the others. A rerun gives the same table, and an
        empty result empties the day."""
        if self.database:
            self._replace_catalog_day(df, table, day)
            return
        pointer = self._adopted(table)
        folder = f"{VERSION}={_fresh()}/{DAY}={day}"
        rows = df.drop(DAY)
        schema = rows.withColumn(DAY, F.lit(day)).schema.json()
        with self._version(pointer, folder) as place:
            rows.write.parquet(place)
            pointer.change(lambda f: {d: x for d, x in f.items() if d} | {day: folder}, schema)

    def replace_days(self, df: DataFrame, table: str, days: set[str]) -> None:
        """Overwrite several days at once; those without rows become empty. Readers of a folder
        see the old days or all the new ones."""
        if self.database:
            for day in sorted(days):
                self.replace_day(on_day(df, day), table, day)
            return
        pointer, version = self._adopted(table), f"{VERSION}={_fresh()}"
        schema = df.drop(DAY).withColumn(DAY, F.lit("")).schema.json()
        with self._version(pointer, version) as place:
            wanted = df.where(F.col(DAY).isin(*days))
            wanted.hint("rebalance", DAY).write.partitionBy(DAY).parquet(place)
            written = {name for name, _ in pointer.files.children(place)}
            none = self.spark.createDataFrame([], df.drop(DAY).schema)
            for day in sorted(days):
                if f"{DAY}={day}" not in written:
                    none.write.parquet(f"{place}/{DAY}={day}")
            new = {day: f"{version}/{DAY}={day}" for day in days}
            pointer.change(lambda f: {d: x for d, x in f.items() if d} | new, schema)

    def drop_days(self, table: str, days: set[str]) -> None:
        """Forget days; their rows go like replaced ones."""
        if not days:
            return
        if self.database:
            parts = ", ".join(f"PARTITION ({DAY}='{day}')" for day in sorted(days))
            self.spark.sql(f"ALTER TABLE {self._name(table)} DROP IF EXISTS {parts}")
            return
        self._adopted(table).change(lambda f: {d: x for d, x in f.items() if d not in days})

    def sweep(self, table: str, older: float = 7 * 86_400.0) -> list[str]:
        """Delete staged folders that a killed writer left more than ``older`` seconds ago."""
        pointer = self._pointer(table)
        state = pointer.current()
        if state is None:
            return []
        used = {f.split("/", 1)[0] for f in [*state.folders.values(), *state.retired]}
        left = pointer.files.older(pointer.path, older)
        left = [n for n in left if n.startswith(f"{VERSION}=") and n not in used]
        for name in left:
            remove_path(self.spark, f"{pointer.path}/{name}")
        return left

    def _location(self, name: str, part: str = "") -> str:
        """The folder of a catalog table, or of one of its days."""
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name} {part}").collect()
        return next(r["data_type"] for r in rows if r["col_name"] == "Location")

    def _base(self, name: str) -> str:
        """The folder in which a catalog table was made, whichever it has now."""
        return self._location(name).split(f"/{_VERSIONS}/")[0]

    def _retire(self, base: str, old: str | None) -> None:
        """Put a replaced folder on the list of those to delete, and delete those due."""
        if old is not None:
            name = PLAIN if old == base else old.removeprefix(f"{base}/")
            pointer = Pointer(self.spark, base, self.retain)
            pointer.change(lambda folders: folders, replaced=frozenset({name}))

    def _replace_catalog(self, df: DataFrame, table: str) -> None:
        name = self._name(table)
        if not self.spark.catalog.tableExists(name):
            self._save(df.write, table)
            return
        known = self.spark.table(name).schema
        added = [f for f in df.schema if f.name.lower() not in {k.name.lower() for k in known}]
        missing = {k.name.lower() for k in known} - {f.name.lower() for f in df.schema}
        if missing:
            raise ValueError(f"{name} has columns that the new rows lack: {sorted(missing)}")
        base, old = self._base(name), self._location(name)
        place = f"{base}/{_VERSIONS}/{_fresh()}"
        with self._staged(place, lambda: self._location(name) == place):
            same = [F.col(k.name).cast(k.dataType).alias(k.name) for k in known]
            df.select(*same, *[f.name for f in added]).write.parquet(place)
            if added:
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
                self.spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
        self.spark.catalog.refreshTable(name)
        self._retire(base, old)

    def _replace_catalog_day(self, df: DataFrame, table: str, day: str) -> None:
        name, part = self._name(table), f"PARTITION ({DAY}='{day}')"
        written = Observation()
        if not self.spark.catalog.tableExists(name):
            self._save(df.drop(DAY).withColumn(DAY, F.lit(day)).write.partitionBy(DAY), table)
            return
        base, there = self._base(name), day in self.days(table)
        old = self._location(name, part) if there else None
        fresh, inner = f"{base}/{_VERSIONS}/{_fresh()}", f"/{DAY}={day}"

        def used() -> bool:
            return day in self.days(table) and self._location(name, part) == fresh + inner

        with self._staged(fresh, used, inner) as place:
            known = [f for f in self.spark.table(name).schema if f.name != DAY]
            rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in known])
            rows.observe(written, F.count("*").alias(_ROWS)).write.parquet(place)
            if written.get[_ROWS] == 0:
                remove_path(self.spark, place)
                self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {part}")
            elif there:
                self.spark.sql(f"ALTER TABLE {name} {part} SET LOCATION '{place}'")
            else:
                self.spark.sql(f"ALTER TABLE {name} ADD {part} LOCATION '{place}'")
        self.spark.catalog.refreshTable(name)
        self._retire(base, old)
