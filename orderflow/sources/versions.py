"""A replicated table side that changes while a stream runs.

The table is published as whole versions (folders named by a manifest, see
:mod:`orderflow.sinks.transaction`): readers see the newest published one, never
half of it.  A stream joined in ``foreachBatch`` reads it anew for every
micro-batch, so a row meets the version that held when its batch began; rows
already written keep what they met.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderflow.sinks import files as sinks
from orderflow.sinks.transaction import Ledger


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.ledger = spark, Ledger(spark, root)

    def publish(self, rows: DataFrame) -> int:
        """Make ``rows`` the table's next version."""
        version = (self.version() or 0) + 1
        folder = f"versions/{version}-{uuid.uuid4().hex[:8]}"
        rows.write.parquet(f"{self.ledger.root}/{folder}")
        self.ledger.publish(version, {"rows": folder}, {"version": version})
        return version

    def version(self) -> int | None:
        at = self.ledger.position()
        return at["version"] if at else None

    def current(self) -> DataFrame:
        entries = self.ledger.entries()
        if not entries:
            raise ValueError("no version has been published")
        return self.spark.read.parquet(f"{self.ledger.root}/{entries[-1]['outputs']['rows']}")


def joined_batches(table: VersionedTable, join: Callable[[DataFrame, DataFrame], DataFrame], path: str
                   ) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer of ``join(batch, newest version)``; a replayed batch is written once."""
    write = sinks.idempotent_batches(path)
    return lambda batch, batch_id: write(join(batch, table.current()), batch_id)
