"""Versioned layers: all tables of a load become visible together."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import CODEC
from .append import write_partitioned

_MANIFEST = "manifest.json"
_LOAD, PART = "_load", "_part"


class VersionedLayer:
    """A folder of tables and one of versions; readers see the last published version.

    Parquet has no transaction across tables. A load writes its rows into folders
    of its own and publishes a manifest last: it is written under another name and
    renamed, so readers see it whole or not at all, and a failed load leaves the
    former version in place. The manifest holds each table's schema and the loads
    it consists of, so a version can add rows without rewriting what earlier ones
    wrote, a load without rows needs no file, and a table is read in one scan.
    Notes on a table (what an aggregate covers, the key ranges of its parts) and the
    identifiers of applied loads are published with it.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _fs(self, path: str):
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path

    def _list(self, path: str) -> list:
        fs, root = self._fs(path)
        return list(fs.listStatus(root)) if fs.exists(root) else []

    def _numbers(self) -> list[int]:
        """Versions with a manifest, readable or not."""
        names = [s.getPath().getName() for s in self._list(self.path)]
        numbers = sorted(int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit())
        return [n for n in numbers if self._exists(f"{self.folder(n)}/{_MANIFEST}")]

    def _exists(self, path: str) -> bool:
        fs, hadoop_path = self._fs(path)
        return fs.exists(hadoop_path)

    def folder(self, version: int) -> str:
        return f"{self.path}/v{version:06d}"

    def _manifest(self, version: int) -> dict | None:
        """``tables`` and ``ids`` of the version, or None when it is not published or its manifest cannot be read."""
        path = f"{self.folder(version)}/{_MANIFEST}"
        if not self._exists(path):
            return None
        try:
            return json.loads("".join(r.value for r in self.spark.read.text(path, wholetext=True).collect()))
        except json.JSONDecodeError:
            return None

    def current(self) -> int | None:
        """Number of the last published version; unfinished ones do not count."""
        for number in reversed(self._numbers()):
            if self._manifest(number) is not None:
                return number
        return None

    def tables(self, version: int | None = None) -> dict[str, dict]:
        version = self.current() if version is None else version
        manifest = self._manifest(version) if version is not None else None
        return manifest["tables"] if manifest else {}

    def note(self, table: str, version: int | None = None) -> dict:
        """What the version says about a table beside its schema and loads."""
        return self.tables(version).get(table, {}).get("note", {})

    def read(self, table: str, version: int | None = None) -> DataFrame:
        tables = self.tables(version)
        if table not in tables:
            raise FileNotFoundError(f"{table} is not in a published version of {self.path}")
        return self._rows(table, tables[table])

    def _rows(self, table: str, entry: dict, loads: Sequence[str] | None = None) -> DataFrame:
        schema, base = T.StructType.fromJson(entry["schema"]), f"{self.path}/tables/{entry.get('at', table)}"
        stored = T.StructType.fromJson(entry.get("stored", entry["schema"]))
        loads = entry["loads"] if loads is None else loads
        if not loads:
            return self.spark.createDataFrame([], schema)
        own = [T.StructField(_LOAD, T.StringType())] + [T.StructField(PART, T.IntegerType())] * ("/" in loads[0])
        reader = self.spark.read.schema(T.StructType([*stored.fields, *own])).option("basePath", base)
        rows = reader.parquet(*[f"{base}/{_LOAD}={load}" for load in loads]).select(*stored.names)
        for step in entry.get("steps", ()):
            rows = rows.selectExpr(*step)
        return rows.select(*schema.names)

    def load(self, load_id: str | None = None) -> Load:
        """Begin a load on the current version. One whose ``load_id`` is in it already is ``applied`` and has nothing to do."""
        return Load(self, load_id)

    def publish(
        self,
        tables: Mapping[str, DataFrame] | None = None,
        append: Mapping[str, DataFrame] | None = None,
        partition_by: Mapping[str, Sequence[str]] | None = None,
        load_id: str | None = None,
    ) -> int:
        """Write the next version and make it current.

        ``tables`` are replaced, ``append`` adds rows to tables of the current
        version, all others are carried over. Publishing a table anew compacts it.
        A ``load_id`` that is applied already changes nothing.
        """
        load = self.load(load_id)
        if load.applied:
            return load.base
        for name, df in (tables or {}).items():
            load.replace(name, df, (partition_by or {}).get(name, ()))
        for name, df in (append or {}).items():
            load.append(name, df, (partition_by or {}).get(name, ()))
        return load.commit()

    def retain(self, versions: int, grace_seconds: float = 86_400) -> list[str]:
        """Keep the last ``versions`` and drop the others, with the loads that none of the kept ones refers to.

        Folders changed within the grace period stay, as a load may be writing them.
        Manifests go first: a version that can still be found can be read. Gives the
        folders dropped.
        """
        if versions < 1:
            raise ValueError("at least one version has to stay")
        published = [n for n in self._numbers() if self._manifest(n) is not None]
        kept, dropped = published[-versions:], []
        held: dict[str, set[str]] = {}
        for number in kept:
            for table, entry in self.tables(number).items():
                held.setdefault(entry.get("at", table), set()).update(entry["loads"])
        oldest = time.time() - grace_seconds

        def drop(status) -> None:
            if status.getModificationTime() / 1000 <= oldest:
                fs, path = self._fs(status.getPath().toString())
                fs.delete(path, True)
                dropped.append(path.toString())

        for status in self._list(self.path):
            name = status.getPath().getName()
            if name.startswith("v") and name[1:].isdigit() and kept and int(name[1:]) < kept[0]:
                drop(status)
        for table in self._list(f"{self.path}/tables"):
            of_table = held.get(table.getPath().getName(), set())
            whole = {load.partition("/")[0] for load in of_table}
            for status in self._list(table.getPath().toString()):
                load = status.getPath().getName().removeprefix(f"{_LOAD}=")
                if load not in whole:
                    drop(status)
                elif load not in of_table:  # of the parts of a load only some are in use
                    for part in self._list(status.getPath().toString()):
                        if part.getPath().getName().startswith(PART) and f"{load}/{part.getPath().getName()}" not in of_table:
                            drop(part)
        return dropped


class Load:
    """One load: what it writes can be read through it at once, and by others after :meth:`commit`."""

    def __init__(self, layer: VersionedLayer, load_id: str | None):
        self.layer, self.load_id, self.base = layer, load_id, layer.current()
        manifest = layer._manifest(self.base) if self.base is not None else {"tables": {}, "ids": []}
        self._tables, self._ids = manifest["tables"], manifest["ids"]
        self._version = max(layer._numbers(), default=0) + 1

    @property
    def applied(self) -> bool:
        return self.load_id is not None and self.load_id in self._ids

    def __contains__(self, table: str) -> bool:
        return table in self._tables

    def names(self) -> list[str]:
        return list(self._tables)

    def read(self, table: str, loads: Sequence[str] | None = None) -> DataFrame:
        """The table as this load leaves it so far, or just some of its loads."""
        if table not in self._tables:
            raise FileNotFoundError(f"{table} is not in {self.layer.path}")
        return self.layer._rows(table, self._tables[table], loads)

    def loads(self, table: str) -> list[str]:
        return list(self._tables[table]["loads"])

    def note(self, table: str) -> dict:
        return self._tables.get(table, {}).get("note", {})

    def set_note(self, table: str, note: Mapping) -> None:
        self._tables[table] = {**self._tables[table], "note": dict(note)}

    def append(
        self, table: str, df: DataFrame, partition_by: Sequence[str] = (), note: Mapping | None = None, gather: bool = True,
        beside: Sequence[str] = (),
    ) -> DataFrame:
        """Add rows to a table (a new one is made); gives the rows added, read back. A ``note`` takes the place of the former.

        ``gather`` as for :func:`starfold.sinks.append.write_partitioned`. The columns ``beside`` are stored with the rows,
        but are not the table's: only tables that :meth:`share` its files read them.
        """
        entry = self._tables.get(table)
        columns = list(entry["by"] if entry else partition_by)
        if entry and {*entry["parts"]}:
            raise ValueError(f"{table} is kept in parts, merge into it")
        if self.shares(table):
            raise ValueError(f"{table} shares the files of {entry['at']}")
        load = self._write(table, df, columns, gather)
        self._tables[table] = self._entry(
            df.drop(*beside), columns, [*(entry["loads"] if entry else []), *load], self.note(table) if note is None else note)
        return self.read(table, load)

    def shares(self, table: str) -> bool:
        return "at" in self._tables.get(table, {})

    def share(self, table: str, of: str, stored: T.StructType, steps: Sequence[Sequence[str]], loads: Sequence[str]) -> DataFrame:
        """Put ``loads`` of the table ``of``, read through ``steps`` (lists of SQL expressions), in the place of ``table``; gives its rows.

        ``stored`` are the columns read, those beside the rows of ``of`` included. Nothing is written, and the
        rows stay when ``of`` is replaced.
        """
        stored = T.StructType([T.StructField(f.name, f.dataType, True) for f in stored.fields])
        rows = self.layer.spark.createDataFrame([], stored)
        for step in steps:
            rows = rows.selectExpr(*step)
        at = {"at": of, "stored": stored.jsonValue(), "steps": [list(step) for step in steps]}
        self._tables[table] = {**self._entry(rows, [], loads, self.note(table)), **at}
        return self.read(table)

    def replace(
        self, table: str, df: DataFrame, partition_by: Sequence[str] = (), note: Mapping | None = None, gather: bool = True,
        beside: Sequence[str] = (),
    ) -> DataFrame:
        """Put ``df`` in the place of a table; gives its rows, read back. ``beside`` as for :meth:`append`."""
        load = self._write(table, df, list(partition_by), gather)
        self._tables[table] = self._entry(df.drop(*beside), list(partition_by), load, note or {})
        return self.read(table)

    def set_parts(self, table: str, df: DataFrame, kept: Mapping[str, Mapping], describe: Sequence, note: Mapping | None = None) -> None:
        """Write ``df`` by its column ``_part``, beside the ``kept`` parts, and publish what the aggregates ``describe`` say of each part.

        Parts are a table's loads by name, so those kept are carried over as they are.
        """
        rows = df.drop(PART)
        load = uuid.uuid4().hex
        path = f"{self.layer.path}/tables/{table}/{_LOAD}={load}"
        df.write.partitionBy(PART).parquet(path)
        whole = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in rows.schema.fields], T.StructField(PART, T.IntegerType())])
        found = self.layer.spark.read.schema(whole).parquet(path).groupBy(PART).agg(*describe).collect()
        parts = {f"{load}/{PART}={r[PART]}": {k: v for k, v in r.asDict().items() if k != PART} for r in found}
        entry = self._entry(rows, [], [*kept, *parts], note or {})
        self._tables[table] = {**entry, "parts": {**kept, **parts}}

    def parts(self, table: str) -> dict[str, dict]:
        return dict(self._tables[table]["parts"]) if table in self._tables else {}

    @staticmethod
    def _entry(df: DataFrame, columns: list[str], loads: Iterable[str], note: Mapping) -> dict:
        # data read back from files is nullable
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
        return {"schema": schema.jsonValue(), "by": columns, "loads": list(loads), "note": dict(note), "parts": {}}

    def _write(self, table: str, df: DataFrame, columns: Sequence[str], gather: bool = True) -> list[str]:
        """Write one load of a table; its name, or nothing when it has no rows."""
        load = uuid.uuid4().hex
        path = f"{self.layer.path}/tables/{table}/{_LOAD}={load}"
        if columns:
            write_partitioned(df, path, columns, gather=gather)
        else:
            df.write.option("compression", CODEC).parquet(path)
        names = [s.getPath().getName() for s in self.layer._list(path)]
        return [load] if any(not n.startswith(("_", ".")) for n in names) else []

    def commit(self) -> int:
        """Publish the load as the next version; an error when another load was published meanwhile."""
        ids = [*self._ids, *([self.load_id] if self.load_id is not None else [])]
        folder = self.layer.folder(self._version)
        fs, temporary = self.layer._fs(f"{folder}/{_MANIFEST}.{uuid.uuid4().hex}")
        stream = fs.create(temporary, False)
        stream.write(json.dumps({"tables": self._tables, "ids": ids}).encode())
        stream.close()
        target = self.layer._fs(f"{folder}/{_MANIFEST}")[1]
        if fs.exists(target) or not fs.rename(temporary, target):
            raise FileExistsError(f"version {self._version} of {self.layer.path} was published by another load")
        return self._version
