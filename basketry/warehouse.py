"""Tables that are replaced together: immutable folders, and one manifest that says which of them count.

A run writes its tables to folders of its own. Nothing a reader may be looking at is touched, until a
manifest with the next version number is created as the last step: it names every table's folders. So a
reader sees all tables of one version, or all of the one before. A run that fails leaves folders nobody
names; ``vacuum`` removes these and what only old versions name.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry import marks
from basketry.scratch import delete_folder

RUN = "basketry_run"
# Tables stay, so they are written small.
CODEC = "zstd"
WHOLE = ""
VERSION = "{:012d}.json"


@dataclass(frozen=True)
class Stored:
    """Where a table's rows are, below the warehouse's root: a folder for each value of the column ``by``, or one for all."""

    home: str
    schema: T.StructType
    folders: dict[str, str] = field(default_factory=dict)
    by: str | None = None

    def to_json(self) -> dict:
        return {"home": self.home, "schema": self.schema.jsonValue(), "folders": self.folders, "by": self.by}

    @staticmethod
    def from_json(found: dict) -> Stored:
        return Stored(found["home"], T.StructType.fromJson(found["schema"]), found["folders"], found["by"])


class Warehouse:
    """Tables below ``root`` by name, in versions."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _manifest(self, version: int) -> str:
        return f"{self.root}/manifests/{VERSION.format(version)}"

    def versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in marks.names(self.spark, f"{self.root}/manifests"))

    def version(self) -> int:
        """The newest one; 0 before the first."""
        return max(self.versions(), default=0)

    def _found(self, version: int | None) -> dict:
        version = self.version() if version is None else version
        text = marks.get(self.spark, self._manifest(version)) if version else None
        if version and text is None:
            raise LookupError(f"{self.root} has no version {version}")
        return json.loads(text) if text else {"tables": {}}

    def tables(self, version: int | None = None) -> dict[str, Stored]:
        return {name: Stored.from_json(t) for name, t in self._found(version)["tables"].items()}

    def notes(self, version: int | None = None) -> dict[str, str]:
        """What a version's run has said about it, such as what it was built from."""
        return self._found(version).get("notes", {})

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A table as it is in a version. It stays readable while newer versions come."""
        tables = self.tables(version)
        if name not in tables:
            raise LookupError(f"{self.root} has no table {name}")
        return self.open(tables[name])

    def open(self, stored: Stored) -> DataFrame:
        paths = [f"{self.root}/{f}" for f in stored.folders.values()]
        if not paths:
            return self.spark.createDataFrame([], stored.schema)
        if stored.by is None:
            return self.spark.read.schema(stored.schema).parquet(*paths)
        fields = [f for f in stored.schema if f.name != stored.by]
        found = T.StructType([*fields, T.StructField(RUN, T.StringType()), stored.schema[stored.by]])
        files = self.spark.read.schema(found).option("basePath", f"{self.root}/{stored.home}")
        return files.parquet(*paths).select(*stored.schema.names)

    def change(self) -> Change:
        """What is to become the next version, starting from the newest one."""
        version = self.version()
        return Change(self, version, self.tables(version), self.notes(version))

    def vacuum(self, keep: int = 2) -> None:
        """Delete what the newest ``keep`` versions do not name. Not while another run writes or waits to be retried."""
        versions = self.versions()
        used = {f for v in versions[-keep:] for t in self.tables(v).values() for f in t.folders.values()}
        homes = {t.home for v in versions for t in self.tables(v).values()}
        for home in sorted(homes):
            for run in marks.names(self.spark, f"{self.root}/{home}"):
                folder = f"{home}/{run}"
                if any(f == folder or f.startswith(f"{folder}/") for f in used):
                    for part in marks.names(self.spark, f"{self.root}/{folder}"):
                        if folder not in used and "=" in part and f"{folder}/{part}" not in used:
                            delete_folder(self.spark, f"{self.root}/{folder}/{part}")
                else:
                    delete_folder(self.spark, f"{self.root}/{folder}")
        for v in versions[:-keep]:
            delete_folder(self.spark, self._manifest(v))


@dataclass
class Change:
    """Tables of the next version: those of ``version`` unless written anew."""

    warehouse: Warehouse
    version: int
    tables: dict[str, Stored]
    notes: dict[str, str] = field(default_factory=dict)
    run: str = field(default_factory=lambda: uuid.uuid4().hex)

    def write(
        self,
        name: str,
        df: DataFrame,
        layer: str = "tables",
        by: str | None = None,
        within: Iterable[str] = (),
        gather: bool = True,
        only: Iterable[str] | None = None,
    ) -> DataFrame:
        """Write a table's rows and return the table as the next version will have it.

        ``by`` is a date or number with a folder for each value; rows are sorted ``within`` a folder's files,
        so that a filter on those columns skips most of a file (with ``gather`` off they stay as they come).
        ``only`` names values of ``by`` whose
        rows ``df`` has all of: they alone are replaced (or go, if ``df`` has none), the others stay.
        """
        home = f"{layer}/{name}"
        folder = f"{home}/{RUN}={self.run}"
        path = f"{self.warehouse.root}/{folder}"
        if by is None:
            df.write.mode("overwrite").parquet(path, compression=CODEC)
            folders = {WHOLE: folder}
        else:
            # Gathered by value, so that a task writes few files; a value with very many rows is split by size.
            rows = df.hint("rebalance", F.col(by)).sortWithinPartitions(by, *within) if gather else df
            rows.write.mode("overwrite").partitionBy(by).parquet(path, compression=CODEC)
            made = [n for n in marks.names(self.warehouse.spark, path) if n.startswith(f"{by}=")]
            folders = {n.split("=", 1)[1]: f"{folder}/{n}" for n in made}
        if only is not None:
            replaced = set(only)
            if other := sorted(set(folders) - replaced):
                raise ValueError(f"{name} has rows outside of what is replaced: {', '.join(other)}")
            before = self.tables[name].folders if name in self.tables else {}
            folders = {**{value: f for value, f in before.items() if value not in replaced}, **folders}
        self.tables[name] = Stored(home, df.schema, dict(sorted(folders.items())), by)
        return self.warehouse.open(self.tables[name])

    def adopt(self, name: str, stored: Stored) -> DataFrame:
        """Take over a table that this change wrote before a failure."""
        self.tables[name] = replace(stored)
        return self.warehouse.open(stored)

    def drop(self, name: str) -> None:
        self.tables.pop(name, None)

    def commit(self) -> int:
        """Make this the newest version. Raises FileExistsError if another run was faster: its version stays."""
        version = self.version + 1
        tables = {n: t.to_json() for n, t in sorted(self.tables.items())}
        text = json.dumps({"version": version, "tables": tables, "notes": self.notes})
        marks.put(self.warehouse.spark, self.warehouse._manifest(version), text)
        self.version = version
        return version
