"""Write, audit, publish: several tables become visible together, or not at all.

A release names one version of each table, in one small file. Readers go through it, so tables
that are written and even published on their own show nothing until a release names them. A run stages
its tables, audits what it has staged, and only then writes the next release; a failed audit
leaves the last one standing.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from .. import storage
from ..operators import quality
from ..operators.quality import Rules
from ..sources.versions import Draft, VersionedTable

Audit = Callable[[dict[str, DataFrame]], None]


class Release:
    """The published state of the tables under `root`."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def numbers(self) -> list[int]:
        return [int(p.rsplit("/", 1)[1].removesuffix(".json")) for p in storage.glob(self.spark, f"{self.root}/release/*.json")]

    def versions(self, number: int | None = None) -> dict[str, int]:
        """Table name to version, of the last release or an earlier one."""
        numbers = self.numbers()
        if not numbers:
            return {}
        return json.loads(storage.read_text(self.spark, self._path(max(numbers) if number is None else number)))

    def _path(self, number: int) -> str:
        return f"{self.root}/release/{number:010d}.json"

    def table(self, name: str, partition: str | None = None, cluster_by: tuple[str, ...] = ()) -> VersionedTable:
        """A table as released, to read or to stage changes of; versions that no release names are not built upon."""
        return VersionedTable(self.spark, f"{self.root}/{name}", partition, cluster_by, base=self.versions().get(name, 0))

    def read(self, name: str, number: int | None = None) -> DataFrame:
        return VersionedTable(self.spark, f"{self.root}/{name}").read(version=self.versions(number)[name])

    def publish(self, drafts: Mapping[str, Draft]) -> int:
        """Make all drafts visible by one rename. Returns the release's number."""
        before = self.versions()
        number = max(self.numbers(), default=0) + 1
        after = before | {name: draft.publish() for name, draft in drafts.items()}
        storage.create_text(self.spark, self._path(number), json.dumps(after))
        return number


def audited(rules: Mapping[str, Rules], parents: Mapping[str, DataFrame] | None = None) -> Audit:
    """An audit by declared rules: raises on the first table that breaks one; warnings pass."""

    def audit(tables: dict[str, DataFrame]) -> None:
        known = {**(parents or {}), **tables}
        for name in (n for n in tables if n in rules):
            quality.enforce(quality.report(tables[name], rules[name], known), name, rules[name].warn)

    return audit


def audit_and_publish(release: Release, drafts: Mapping[str, Draft], audit: Audit) -> int:
    """Judge the staged tables; publish them together if they pass."""
    audit({name: draft.read() for name, draft in drafts.items()})
    return release.publish(drafts)
