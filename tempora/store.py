"""Versioned tables: a run writes what it changes beside the current files, then one rename publishes all of it."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The part of a table that isn't cut in parts.
WHOLE = ""


@dataclass
class Change:
    """Rows with a string column `part`. Parts in `replaced` get these rows instead of what they have - none, where
    the rows have none for them - and rows of other parts are added to what is there."""

    rows: DataFrame
    replaced: list[str] = field(default_factory=list)


class Store:
    """base/pointers/<number>: one line of JSON that lists the folders of every part of every table, and marks. The
    greatest number counts; base/versions/<id>/ holds what one run wrote.

    A pointer appears by one rename to a name that isn't there yet, and none is ever deleted, so that readers see one
    whole version or the one before, also after a crash between any two steps. What a run doesn't change is carried
    over by its path.
    """

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark, self.base = spark, base.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.base).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        path = self._path(f"{self.base}/{folder}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def _pointers(self) -> list[str]:
        return [n for n in self._names("pointers") if n.isdigit()]

    def _manifest(self, pointer: str | None) -> dict:
        if pointer is None:
            return {"version": None, "tables": {}, "marks": {}}
        return json.loads(self.spark.read.text(f"{self.base}/pointers/{pointer}").first()["value"])

    def manifest(self) -> dict:
        """version, tables (name -> part -> folders) and marks of what is published."""
        names = self._pointers()
        return self._manifest(names[-1] if names else None)

    def current(self) -> str | None:
        return self.manifest()["version"]

    def read(self, table: str, schema: str | StructType | None = None, parts: Iterable[str] | None = None) -> DataFrame:
        """The published table, or some of its parts; without a table, or parts, an empty frame of the schema."""
        known = self.manifest()["tables"].get(table)
        if known is None and schema is None:
            raise FileNotFoundError(table)
        wanted = list(known or {}) if parts is None else [p for p in parts if p in (known or {})]
        folders = [f"{self.base}/{f}" for p in wanted for f in known[p]]
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(*folders)

    def folder(self) -> str:
        """A fresh folder under base for the tables of a run, which publish can take over as they are."""
        return f"versions/{uuid.uuid4().hex}"

    def publish(self, tables: dict[str, DataFrame] | None = None, changes: dict[str, Change] | None = None, written: dict[str, str] | None = None, marks: dict[str, str] | None = None) -> str:
        """Whole new tables, changed parts, tables that stand in folders already (name -> folder under base), marks;
        then swap the pointer."""
        names = self._pointers()
        before, version = self._manifest(names[-1] if names else None), uuid.uuid4().hex
        folder, after = f"versions/{version}", {n: dict(parts) for n, parts in before["tables"].items()}
        for name, df in (tables or {}).items():
            df.write.parquet(f"{self.base}/{folder}/{name}")
            after[name] = {WHOLE: [f"{folder}/{name}"]}
        for name, place in (written or {}).items():
            after[name] = {WHOLE: [place]}
        for name, change in (changes or {}).items():
            change.rows.repartition("part").write.partitionBy("part").parquet(f"{self.base}/{folder}/{name}")
            parts = after.setdefault(name, {})
            for part in change.replaced:
                parts.pop(part, None)
            for child in self._names(f"{folder}/{name}"):
                if child.startswith("part="):
                    part = child.removeprefix("part=")
                    parts[part] = [*parts.get(part, []), f"{folder}/{name}/{child}"]
        told = json.dumps({"version": version, "tables": after, "marks": {**before["marks"], **(marks or {})}}, sort_keys=True)
        fresh, pointer = self._path(f"{self.base}/pointers/{version}.tmp"), self._path(f"{self.base}/pointers/{int(names[-1]) + 1 if names else 0:012d}")
        out = self._fs.create(fresh, True)
        out.writeBytes(told)
        out.close()
        if self._fs.exists(pointer) or not self._fs.rename(fresh, pointer):
            raise OSError("another run has published meanwhile")
        return version

    def written(self, version: str) -> int:
        """Bytes of what one version wrote itself."""
        path = self._path(f"{self.base}/versions/{version}")
        return self._fs.getContentSummary(path).getLength() if self._fs.exists(path) else 0

    def vacuum(self, keep: int = 3, hours: float = 24) -> list[str]:
        """Delete folders that none of the last `keep` versions lists and that are older than `hours`, so that no
        run that still writes loses any; what was deleted."""
        used = {f for p in self._pointers()[-keep:] for parts in self._manifest(p)["tables"].values() for folders in parts.values() for f in folders}
        gone, limit = [], (time.time() - hours * 3600) * 1000
        for version in self._names("versions"):
            for table in self._names(f"versions/{version}"):
                whole = f"versions/{version}/{table}"
                parts = [f"{whole}/{p}" for p in self._names(whole) if p.startswith("part=")]
                places = [p for p in parts if p not in used] if used & {*parts, whole} else [whole]
                for place in places if whole not in used else []:
                    path = self._path(f"{self.base}/{place}")
                    if self._fs.getFileStatus(path).getModificationTime() < limit:
                        self._fs.delete(path, True)
                        gone.append(place)
        return gone


def part_of(*columns: str, parts: int) -> F.Column:
    """A hash part by the columns, as text."""
    return F.pmod(F.xxhash64(*columns), F.lit(parts)).cast("string")
