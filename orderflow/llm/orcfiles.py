"""Token ids in ORC files.

Documents are range-partitioned by id, sorted, encoded and written in
ascending id order, one ORC file per partition; the file number gives the
order of the files.  A row holds ``doc_id``, ``start`` (ids of the file's
documents before it), ``n_tokens`` and ``ids``.  What the format does with it:

* integers are run-length encoded (the second version of the encoding);
* every ``row_index`` rows the row index holds the bounds of each column, and
  a Bloom filter holds the document ids, so a reader that asks for ids skips
  files, stripes and row groups from the metadata;
* stripes of ``stripe_bytes`` are independent: a large file is read by several
  tasks, and a reader of counts does not touch the ids.

Reading back takes the totals of each file from the ``n_tokens`` column alone;
the running sum over the files (one row each) turns the starts within a file
into global ones, so no document is ever sorted again.  That table is sent to
the readers while it has at most ``BROADCAST_FILES`` rows, so the ids are not
shuffled; beyond that it is joined by a shuffle.

Defined cases: null text is empty (the end id alone); null ids come first;
repeated rows are written each; an empty table writes an empty file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm import words as wd
from orderflow.llm.tokens import encoder
from orderflow.session import materialize, scratch_path

END_ID, STRIPE_BYTES, ROW_INDEX, BLOOM_FPP, BROADCAST_FILES = 1, 16 << 20, 1000, 0.01, 100_000
_SCHEMA = "doc_id long, start long, n_tokens int, ids array<int>"


def write_ids(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
              end_id: int = END_ID, files: int | None = None, stripe_bytes: int = STRIPE_BYTES,
              row_index: int = ROW_INDEX) -> None:
    """Write the ids of every text and ``end_id`` to ORC files under ``path``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, before = encoder(tokenizer), 0
        for rb, data, offs in wd.blocks(batches, "text"):
            flat, at = enc.encode(data, offs)
            n = len(offs) - 1
            # one more id behind every document
            ends = at[1:] + np.arange(1, n + 1)
            ids = np.full(len(flat) + n, end_id, dtype=np.int32)
            own = np.ones(len(ids), dtype=bool)
            own[ends - 1] = False
            ids[own] = flat.astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids))
            starts = before + np.append(0, ends[:-1])
            before += int(ends[-1])
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), pa.array(starts.astype(np.int64)), pa.array(np.diff(np.append(0, ends)).astype(np.int32)),
                 lists], names=["doc_id", "start", "n_tokens", "ids"])

    src = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                      F.col(f"`{text_col}`").cast("string").alias("text"))
    dealt = src.repartitionByRange(files, "doc_id") if files else src.repartitionByRange("doc_id")
    (dealt.sortWithinPartitions("doc_id", F.xxhash64("text")).mapInArrow(run, _SCHEMA)
     .write.option("orc.stripe.size", stripe_bytes).option("orc.row.index.stride", row_index)
     .option("orc.create.index", "true").option("orc.bloom.filter.columns", "doc_id")
     .option("orc.bloom.filter.fpp", BLOOM_FPP).option("compression", "zstd").mode("overwrite").orc(path))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids -- in no order."""
    stored = spark.read.schema(_SCHEMA).orc(path).withColumn("file", F.col("_metadata.file_name"))
    number = F.regexp_extract("file", "part-([0-9]+)", 1).cast("bigint")
    sums = stored.groupBy("file").agg(F.sum("n_tokens").alias("n")).withColumn("number", number)
    sums = sums.selectExpr("file", "SUM(n) OVER (ORDER BY number, file ROWS BETWEEN UNBOUNDED PRECEDING "
                                   "AND CURRENT ROW) - n AS base")
    sums = materialize(sums, "token-files")
    if sums.count() <= BROADCAST_FILES:
        sums = F.broadcast(sums)
    return stored.join(sums, "file").select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids")


def lookup(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """The stored rows of a few documents; files, stripes and row groups without them are skipped."""
    return read_ids(spark, path).where(F.col("doc_id").isin(*ids))


def checksums(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit integers)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            lists = rb.column(3)
            at = lists.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(), dtype="<i4")).cast("B")
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), rb.column(1), rb.column(2).cast(pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
               end_id: int = END_ID) -> DataFrame:
    """Write the ids of ``docs`` and give the figures of every document as read back from the files."""
    path = scratch_path(docs.sparkSession, "token-ids")
    write_ids(docs, path, tokenizer, id_col, text_col, end_id)
    return checksums(read_ids(docs.sparkSession, path))
