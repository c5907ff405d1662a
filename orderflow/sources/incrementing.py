"""A table read by an ever-growing id: a Python data source with offsets.

``format("incrementing")`` reads the rows of a Parquet table whose id exceeds
the last offset, as a batch (``after`` < id <= ``upto``) and as a stream whose
offset is the largest id handed on.  The offset is kept by the
stream's checkpoint: a restart goes on behind the last committed id, and two runs never
overlap.  A micro-batch is cut into id ranges, each read by its own task with the
file statistics pruning row groups, and comes back as Arrow batches.

Options: ``path`` (a Parquet file or folder; any file system that Arrow
resolves from the address), ``column`` (the id), ``after``, ``upto``, ``partitions``.  Rows with a null id
have no place in such a table and are not read.  Ids that appear later below the offset are
not seen, as with every high-water mark.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

NAME = "incrementing"
START = -(1 << 63)


def _dataset(path: str):
    import pyarrow.dataset as ds
    from pyarrow import fs
    if path.startswith("file:/"):
        path = "/" + path[len("file:"):].lstrip("/")
    if "://" in path:
        system, path = fs.FileSystem.from_uri(path)
        return ds.dataset(path, filesystem=system, format="parquet")
    return ds.dataset(path, format="parquet")


def largest_id(path: str, column: str) -> int:
    """The largest id, from the statistics of the files where they have them."""
    import pyarrow.compute as pc
    top = START
    data = _dataset(path)
    for fragment in data.get_fragments():
        for group in fragment.row_groups or [None]:
            stats = (group.statistics or {}).get(column) if group is not None else None
            if stats is None:  # written without statistics: read the column
                for batch in data.scanner(columns=[column]).to_batches():
                    m = pc.max(batch.column(0)).as_py()
                    top = max(top, START if m is None else m)
                return top
            if stats["max"] is not None:
                top = max(top, stats["max"])
    return top


class IdRange(InputPartition):
    def __init__(self, after: int, upto: int):
        self.after, self.upto = after, upto


class _Reading:
    """What batch and stream share: cutting and reading id ranges."""

    def __init__(self, schema: StructType, options: dict):
        self.schema, self.path, self.column = schema, options["path"], options["column"]
        self.after = int(options.get("after", START))
        self.upto = int(options["upto"]) if "upto" in options else None
        self.count = int(options.get("partitions", 8))

    def top(self) -> int:
        top = largest_id(self.path, self.column)
        return top if self.upto is None else min(top, self.upto)

    def ranges(self, after: int, upto: int) -> list[IdRange]:
        if upto <= after:
            return []
        low = max(after, min(upto, 0) - 1) if after == START else after
        step = max(1, -(-(upto - low) // self.count))
        cuts = [*range(low, upto, step), upto]
        cuts[0] = after
        return [IdRange(a, b) for a, b in zip(cuts[:-1], cuts[1:])]

    def read(self, partition: IdRange) -> Iterator:
        import pyarrow.compute as pc
        at = pc.field(self.column)
        names = [f.name for f in self.schema.fields]
        found = _dataset(self.path).scanner(columns=names, filter=(at > partition.after) & (at <= partition.upto))
        yield from (b for b in found.to_batches() if b.num_rows)


class IncrementingReader(_Reading, DataSourceReader):
    def partitions(self) -> list[IdRange]:
        return self.ranges(self.after, self.top()) or [IdRange(0, 0)]


class IncrementingStream(_Reading, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"id": self.after}

    def latestOffset(self) -> dict:
        return {"id": max(self.after, self.top())}

    def partitions(self, start: dict, end: dict) -> list[IdRange]:
        return self.ranges(start["id"], end["id"])

    def commit(self, end: dict) -> None:
        """Offsets live in the checkpoint; the source has nothing to give back."""


class Incrementing(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        raise ValueError("give the schema: spark.read.format(...).schema(...)")

    def reader(self, schema: StructType) -> IncrementingReader:
        return IncrementingReader(schema, dict(self.options))

    def streamReader(self, schema: StructType) -> IncrementingStream:
        return IncrementingStream(schema, dict(self.options))


def register(spark: SparkSession) -> None:
    # sent by value: the processes that plan and read need not have this package
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(Incrementing)


def read_incrementing(spark: SparkSession, path: str, column: str, schema: StructType, after: int | None = None,
                      upto: int | None = None, stream: bool = False, partitions: int = 8) -> DataFrame:
    """Rows with ``after`` < id <= ``upto`` (either open), as a batch or as a stream that goes on from its checkpoint."""
    register(spark)
    r = (spark.readStream if stream else spark.read).format(NAME).schema(schema)
    r = r.option("path", path).option("column", column).option("partitions", partitions)
    for name, value in (("after", after), ("upto", upto)):
        if value is not None:
            r = r.option(name, value)
    return r.load()
