"""Several outputs of a micro-batch and its input position, published together.

A batch writes each output to a staged folder of its own attempt; when all are
written, one manifest file names them and the input position, and appears by a
rename.  Readers see what manifests name and nothing else, so after a failure at
any point either all outputs of a batch are there, or none: a rerun of the batch
writes a new attempt, and a batch whose manifest exists is skipped.  Folders
of failed attempts are never read.

Every ``MERGE_EVERY``-th manifest repeats the entries before it, so a reader
opens at most that many files however many batches there are.

The manifest's rename must be atomic and must not replace a file (HDFS, local
file systems); on a store without such a rename the folder of manifests belongs on one that has it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MERGE_EVERY = 20


class Ledger:
    """The manifests of a folder: which batches are published, with their outputs and positions."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.jvm = spark.sparkContext._jvm
        self.fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _names(self) -> list[int]:
        folder = self._path("manifests")
        if not self.fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self.fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def _read(self, batch: int) -> dict:
        stream = self.fs.open(self._path(f"manifests/{batch}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def entries(self) -> list[dict]:
        """One entry per published batch, in order: batch, position, outputs (name -> folder)."""
        out: dict[int, dict] = {}
        for batch in reversed(self._names()):
            found = self._read(batch)
            for e in found["entries"]:
                out.setdefault(e["batch"], e)
            if found["whole"]:
                break
        return [out[b] for b in sorted(out)]

    def has(self, batch: int) -> bool:
        return self.fs.exists(self._path(f"manifests/{batch}.json"))

    def publish(self, batch: int, outputs: dict[str, str], position: dict, supersede: bool = False) -> None:
        """Make a batch's outputs visible; ``supersede``: instead of all before it."""
        entry = {"batch": batch, "position": position, "outputs": outputs}
        before = self._names()
        merge = len(before) % MERGE_EVERY == MERGE_EVERY - 1 and not supersede
        body = {"whole": merge or supersede or not before, "entries": [*(self.entries() if merge else []), entry]}
        staged = self._path(f"staged/{uuid.uuid4().hex}.json")
        stream = self.fs.create(staged, False)
        try:
            stream.write(bytearray(json.dumps(body).encode()))
        finally:
            stream.close()
        self.fs.mkdirs(self._path("manifests"))
        if self.has(batch) or not self.fs.rename(staged, self._path(f"manifests/{batch}.json")):
            raise RuntimeError(f"batch {batch} was published by another run")

    def position(self) -> dict | None:
        """The input position of the last published batch."""
        entries = self.entries()
        return entries[-1]["position"] if entries else None

    def read(self, output: str, schema: T.StructType | str) -> DataFrame:
        """All published rows of an output."""
        folders = [f"{self.root}/{e['outputs'][output]}" for e in self.entries() if output in e["outputs"]]
        reader = self.spark.read.schema(schema)
        return reader.parquet(*folders) if folders else self.spark.createDataFrame([], schema)


def atomic_batches(spark: SparkSession, root: str, transform: Callable[[DataFrame], dict[str, DataFrame]],
                   position: Callable[[DataFrame], dict]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer: all outputs of ``transform`` and ``position`` of a batch appear together, once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        ledger = Ledger(batch.sparkSession, root)
        if ledger.has(batch_id):
            return
        attempt = f"staged/batch-{batch_id}-{uuid.uuid4().hex[:12]}"
        at = position(batch)
        outputs = {}
        for name, df in transform(batch).items():
            df.write.parquet(f"{ledger.root}/{attempt}/{name}")
            outputs[name] = f"{attempt}/{name}"
        ledger.publish(batch_id, outputs, at)
    return write
