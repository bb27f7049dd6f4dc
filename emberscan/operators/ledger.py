"""Which batches a table has taken in.

A batch enters the ledger after its rows are in the table. Found there, it is not taken in
again; missing though its rows stand, because the job died in between, the rows themselves
tell (they are not unseen any more). So a batch may be sent any number of times.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from .. import storage

SCHEMA = "batch string, days array<string>, rows long, dead long"


class BatchLedger:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.root = spark, f"{path.rstrip('/')}.batches"

    def _entry(self, batch: str) -> str:
        name = "".join(c if c.isalnum() or c in "-_." else f"%{ord(c):x}" for c in batch)
        return f"{self.root}/{name}.json"

    def holds(self, batch: str) -> bool:
        return storage.exists(self.spark, self._entry(batch))

    def enter(self, batch: str, days: set, rows: int, dead: int = 0) -> None:
        """One small file under the batch's name, created whole by a rename; `dead` counts what was turned away."""
        known = sorted(str(day) for day in days if day is not None)
        storage.write_text(self.spark, self._entry(batch), json.dumps({"batch": batch, "days": known, "rows": rows, "dead": dead}))

    def entries(self) -> DataFrame:
        """batch, days, rows, dead of every batch taken in."""
        if not storage.exists(self.spark, self.root):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).json(self.root)
