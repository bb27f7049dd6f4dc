"""Tables in versions: readers see the old table or the new one, whatever happens to the writer.

A table is a folder of immutable parts (a day each, say) and one small manifest per version that says which
parts make it up. A change writes new parts beside the old ones, then a manifest that
names them, then renames that into place: only this last step is seen by readers. A job that
dies earlier leaves parts no manifest names, which `vacuum` removes.

Parts are pruned by their names in the manifest, without listing or opening any file of the others.
One writer at a time: of two that start from the same version the second to publish fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import storage

UNDATED = "undated"
_WHOLE = "all"


class VersionConflict(RuntimeError):
    """The table has moved on since the change was begun."""


@dataclass(frozen=True)
class Manifest:
    version: int
    schema: T.StructType
    parts: dict[str, str]  # part name to folder, under the table


class Draft:
    """A version written but not published: to be read and checked, then published or left."""

    def __init__(self, table: VersionedTable, manifest: Manifest) -> None:
        self.table, self.manifest = table, manifest

    def read(self) -> DataFrame:
        return self.table._frame(self.manifest, self.manifest.parts)

    def publish(self) -> int:
        return self.table._publish(self.manifest)


class VersionedTable:
    """The table at `path`, in parts by the day of `partition`, or in one part without it."""

    def __init__(
        self, spark: SparkSession, path: str, partition: str | None = None, cluster_by: Iterable[str] = (), base: int | None = None
    ) -> None:
        """`base` is the version to read and to change, the latest by default."""
        self.spark, self.path, self.base = spark, path.rstrip("/"), base
        self.partition, self.cluster_by = partition, list(cluster_by)

    # --- reading ---

    def versions(self) -> list[int]:
        return [int(p.rsplit("/", 1)[1].removesuffix(".json")) for p in storage.glob(self.spark, f"{self.path}/manifest/*.json")]

    def exists(self) -> bool:
        return bool(self.versions())

    def manifest(self, version: int | None = None) -> Manifest:
        version = self.base if version is None else version
        version = max(self.versions()) if version is None else version
        held = json.loads(storage.read_text(self.spark, self._manifest_path(version)))
        return Manifest(version, T.StructType.fromJson(held["schema"]), held["parts"])

    def read(self, days: Iterable[object] | None = None, version: int | None = None) -> DataFrame:
        """The table, or some days of it, at its latest or an earlier version."""
        manifest = self.manifest(version)
        wanted = manifest.parts if days is None else [n for n in manifest.parts if n in {str(d) for d in days}]
        return self._frame(manifest, wanted)

    def _manifest_path(self, version: int) -> str:
        return f"{self.path}/manifest/{version:010d}.json"

    def _frame(self, manifest: Manifest, names: Iterable[str]) -> DataFrame:
        folders = [f"{self.path}/{manifest.parts[name]}" for name in names]
        if not folders:
            return self.spark.createDataFrame([], manifest.schema)
        return self.spark.read.schema(manifest.schema).parquet(*folders)

    # --- changing ---

    def stage_overwrite(self, rows: DataFrame) -> Draft:
        """All of the table anew; undated rows have a part of their own."""
        name = F.lit(_WHOLE)
        if self.partition:
            name = F.coalesce(F.col(self.partition).cast("date").cast("string"), F.lit(UNDATED))
        return self._staged(rows, name, {})

    def stage_load(self, rows: DataFrame, load: str) -> Draft:
        """A load's rows in place of what it brought before: its days, and its rows without one.

        The day named `load` is replaced even when no row has it any more. Undated rows are kept apart by load.
        """
        undated = f"{UNDATED}-{load}"
        name = F.coalesce(F.col(self.partition).cast("date").cast("string"), F.lit(undated))
        return self._staged(rows, name, self._without({load, undated}))

    def stage_part(self, rows: DataFrame, name: str) -> Draft:
        """One part by name, whatever its rows hold; no rows, no part."""
        return self._staged(rows, F.lit(name), self._without({name}))

    def overwrite(self, rows: DataFrame) -> int:
        return self.stage_overwrite(rows).publish()

    def load(self, rows: DataFrame, load: str) -> int:
        return self.stage_load(rows, load).publish()

    def replace_part(self, rows: DataFrame, name: str) -> int:
        return self.stage_part(rows, name).publish()

    def _without(self, names: set[str]) -> dict[str, str]:
        if self.base == 0 or not self.exists():
            return {}
        return {n: f for n, f in self.manifest().parts.items() if n not in names}

    def _staged(self, rows: DataFrame, name: Column, kept: dict[str, str]) -> Draft:
        folder = f"data/{uuid.uuid4().hex}"
        base = max(self.versions(), default=0)
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
        parts = rows.withColumn("_part", name).hint("rebalance", "_part").sortWithinPartitions("_part", *self.cluster_by)
        parts.write.partitionBy("_part").parquet(f"{self.path}/{folder}")
        written = storage.glob(self.spark, f"{self.path}/{folder}/_part=*")
        fresh = {p.rsplit("_part=", 1)[1]: f"{folder}/_part={p.rsplit('_part=', 1)[1]}" for p in written}
        return Draft(self, Manifest(base + 1, schema, {**kept, **fresh}))

    def _publish(self, manifest: Manifest) -> int:
        if max(self.versions(), default=0) >= manifest.version:
            raise VersionConflict(f"{self.path} has a version {manifest.version} already")
        held = {"schema": manifest.schema.jsonValue(), "parts": manifest.parts}
        storage.create_text(self.spark, self._manifest_path(manifest.version), json.dumps(held))
        return manifest.version

    def vacuum(self, keep: int = 1) -> int:
        """Remove what only versions before the last `keep` use, and what none does. Returns folders removed.

        Not to be run beside a writer or a reader of an older version.
        """
        versions = sorted(self.versions())
        for version in versions[:-keep]:
            storage.delete(self.spark, self._manifest_path(version))
        used = {folder for version in versions[-keep:] for folder in self.manifest(version).parts.values()}
        stale = [p for p in storage.glob(self.spark, f"{self.path}/data/*/_part=*") if "/".join(p.rsplit("/", 3)[1:]) not in used]
        for path in stale:
            storage.delete(self.spark, path)
        return len(stale)
