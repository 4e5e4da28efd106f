"""Tables that a streaming query builds batch by batch, read through a manifest.

A batch writes its rows to new folders and, last of all, a manifest: the folders that make up
each table from now on, and how far the query's event time has come (its mark). Readers take
the newest manifest, so a batch that fails half-way changes nothing that they see. A batch
that runs again starts from the manifest of the batch before it and replaces its own, so a
replay changes nothing either. Folders of several batches are merged into larger ones, ``fan``
at a time, so a table of n batches has about fan * log(n) folders and each row is rewritten
log(n) times. A path belongs to one query and its checkpoint.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from orderlake.sources.files import Files


@dataclass(frozen=True)
class Version:
    """What a manifest says: folders and schema of each table, and the mark in microseconds."""

    batch: int = -1
    mark: int | None = None
    folders: Mapping[str, list[str]] = field(default_factory=dict)
    schemas: Mapping[str, dict] = field(default_factory=dict)


class Written(NamedTuple):
    """Rows that a batch has written, read back, and where they lie."""

    rows: DataFrame
    folder: str


class BatchTables:
    """The tables of one query below ``base``; ``name`` tells its manifests from others' there."""

    def __init__(
        self,
        spark: SparkSession,
        base: str,
        name: str,
        fan: int = 8,
        keep: int = 16,
        partition_by: Mapping[str, tuple[str, ...]] | None = None,
    ):
        self.spark, self.base, self.fan, self.keep = spark, base.rstrip("/"), fan, keep
        self.manifests = f"{self.base}/_{name}_manifest"
        self.partition_by = partition_by or {}
        self.files = Files(spark, self.base)

    def batches(self) -> list[int]:
        names = self.files.names(self.manifests)
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def newest(self, before: int | None = None) -> Version:
        """The newest version, or the newest of an earlier batch than ``before``."""
        known = [b for b in self.batches() if before is None or b < before]
        return self._version(known[-1]) if known else Version()

    def _version(self, batch: int) -> Version:
        return Version(**json.loads(self.files.read(f"{self.manifests}/{batch}.json")))

    def table(self, name: str, version: Version | None = None) -> DataFrame | None:
        """The rows of a table in a version (the newest by default); None before it has any."""
        version = version or self.newest()
        if name not in version.folders:
            return None
        return self._read(version.folders[name], T.StructType.fromJson(version.schemas[name]))

    def _read(self, folders: list[str], schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self.base}/{f}" for f in folders])

    def write(self, name: str, rows: DataFrame, batch: int, tier: int = 0) -> Written:
        """Rows of a batch in a folder of their own."""
        folder = f"{name}/batch=t{tier}-{batch}-{uuid.uuid4().hex[:12]}"
        rows.write.partitionBy(*self.partition_by.get(name, ())).parquet(f"{self.base}/{folder}")
        return Written(self._read([folder], rows.schema), folder)

    def commit(
        self,
        last: Version,
        batch: int,
        mark: int | None,
        append: Mapping[str, Written] | None = None,
        replace: Mapping[str, Written] | None = None,
    ) -> Version:
        """Make written rows part of the tables: added to them, or in place of what they held."""
        folders, schemas = dict(last.folders), dict(last.schemas)
        for name, written in (append or {}).items():
            folders[name] = [*folders.get(name, []), written.folder]
            folders[name] = self._merged(name, folders[name], written.rows.schema, batch)
        for name, written in (replace or {}).items():
            folders[name] = [written.folder]
        for name, written in {**(append or {}), **(replace or {})}.items():
            schemas[name] = json.loads(written.rows.schema.json())
        version = Version(batch, mark, folders, schemas)
        self.files.replace(f"{self.manifests}/{batch}.json", json.dumps(vars(version)))
        self._expire(batch)
        return version

    def _merged(self, name: str, folders: list[str], schema: T.StructType, batch: int) -> list[str]:
        """The folders, with any ``fan`` of one size rewritten as a larger one."""

        def tier(folder: str) -> int:
            return int(folder.rsplit("/batch=t", 1)[1].split("-")[0])

        while True:
            sizes = Counter(map(tier, folders))
            full = min((t for t, n in sizes.items() if n >= self.fan), default=None)
            if full is None:
                return folders
            small = [f for f in folders if tier(f) == full]
            keys = self.partition_by.get(name, ())
            rows = self._read(small, schema).hint("rebalance", *keys)
            merged = self.write(name, rows, batch, full + 1)
            folders = [f for f in folders if f not in small] + [merged.folder]

    def _expire(self, batch: int) -> None:
        """Drop manifests of later batches, which a rerun replaces, and all but the last
        ``keep``, with the folders that only they name. Readers have that long to finish."""
        known = self.batches()
        for later in (b for b in known if b > batch):
            self.files.delete(f"{self.manifests}/{later}.json")
        kept = [b for b in known if b <= batch][-self.keep :]
        old = [b for b in known if b < kept[0]]
        if not old:
            return
        needed = {f for folders in self._version(kept[0]).folders.values() for f in folders}
        for b in old:
            for folder in {f for folders in self._version(b).folders.values() for f in folders} - needed:
                self.files.delete(f"{self.base}/{folder}")
            self.files.delete(f"{self.manifests}/{b}.json")
