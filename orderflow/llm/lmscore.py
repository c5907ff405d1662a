"""Stupid-backoff scores of documents under the corpus's own n-gram counts.

For the word w behind the context h (the ``order`` - 1 words before it, fewer
at the start of a document), with counts c over all *other* documents:

    S(w | h) = c(h w) / c(h)              if c(h w) > 0
             = alpha * S(w | shorter h)   otherwise
    S(w)     = c(w) / N,  or 1 / N if c(w) = 0

The document's own occurrences are taken out of every count and of N (leaving
one out), so a text is scored by what the rest of the corpus says about it and
backing off happens.  The score is the sum of log S over the words.

The computation is a hash join of exploded n-grams with count tables, with
blocks of documents as rows:

1. Texts are packed into block rows (some MB of text each) once.  A block is
   its own unit of work, so it gives the same n-grams whenever it is read.
2. A block explodes into its distinct n-grams with their counts (so a word
   pair that fills a third of the corpus is one entry per block) and sends
   them, as 64-bit hashes sorted and cut by hash range, to the partitions of
   the count tables.
3. A partition adds up the counts of every n-gram it holds -- its part of the
   count table -- and answers each block with the totals of its n-grams, in
   the block's own order, so no hash travels back.
   Steps 2 and 3 go through the orders one by one, so the disk holds the
   exchange of one order beside the answers, never that of all.
4. A block joined with its answers scores its words and sums per document.

A row of the exchange is a block's part of one hash range.  There are
``RANGES`` ranges up to ``RANGES * RANGE_KEYS`` words, so rows follow the
input; beyond that the ranges grow in number, which keeps a count table's part
in a task's memory.  Every shuffle row is bounded by a block.  Hashes are 64
bits wide; two n-grams that share one are counted as one.

Defined cases: null or blank text has no words and score 0; in a corpus
without other words N counts as 1; repeated rows are documents of their own; a
text longer than a block is a block of its own; an empty table gives no rows;
other columns, whatever their names, are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm import words as wd
from orderflow.session import materialize

ORDER, ALPHA, RANGES, RANGE_KEYS, BLOCK_BYTES = 3, 0.4, 64, 4_000_000, 8 << 20


def blocks_of(docs: DataFrame) -> DataFrame:
    """block, n_words, ids (null-safe list), texts (compressed), offs: one row per block of documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ctx = TaskContext.get()
        block = ctx.partitionId() << 32
        for rb, data, offs in wd.blocks(batches, "text", BLOCK_BYTES):
            row, _, _, _ = wd.words(data, offs)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([len(row)]), pa.array([rb.column(0).to_pylist()], pa.list_(pa.int64())),
                 pa.array([zlib.compress(data.tobytes(), 1)], pa.binary()),
                 pa.array([offs.tolist()], pa.list_(pa.int64()))],
                names=["block", "n_words", "ids", "texts", "offs"])
            block += 1

    return docs.mapInArrow(run, "block long, n_words long, ids array<long>, texts binary, offs array<long>")


class Grams:
    """The n-grams of a block: per order, from ``least`` on, the hash at each word and whether it lies in one
    document."""

    def __init__(self, texts: bytes, offs: np.ndarray, order: int, least: int = 1):
        data = wd.lower_ascii(np.frombuffer(zlib.decompress(texts), dtype=np.uint8))
        self.row, codes, distinct = wd.word_codes(data, offs)
        h = wd.hash64(distinct)[codes]
        self.key, self.whole = [], []
        n = len(h)
        for k in range(least, order + 1):
            key, whole = np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=bool)
            if n >= k:
                key[k - 1:] = wd.windows(h, k)  # the n-gram that ends at the word
                whole[k - 1:] = self.row[k - 1:] == self.row[:n - k + 1]
            self.key.append(key)
            self.whole.append(whole)


def _range_starts(ranges: int) -> np.ndarray:
    """The least hash of every range."""
    return np.array([(i << 64) // ranges for i in range(ranges)], dtype=np.uint64)


def requests(blocks: DataFrame, order: int, ranges: int, least: int = 1) -> DataFrame:
    """part (order and hash range), block, keys, counts: the distinct n-grams of every block, of ``least`` to
    ``order`` words.

    Keys travel as steps from one to the next: what is left of a hash among so many is narrower by two bytes.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut_at = _range_starts(ranges)
        cut = cut_at[1:]
        for rb in batches:
            for i in range(rb.num_rows):
                g = Grams(rb.column(3)[i].as_py(), rb.column(4)[i].values.to_numpy(), order, least)
                part, keys, counts = [], [], []
                for k, key, whole in zip(range(least - 1, order), g.key, g.whole):
                    u, c = np.unique(key[whole], return_counts=True)
                    at = [0, *np.searchsorted(u, cut).tolist(), len(u)]
                    for r, (a, b) in enumerate(zip(at[:-1], at[1:])):
                        if b > a:
                            part.append(k * ranges + r)
                            keys.append(wd.pack(np.diff(u[a:b], prepend=cut_at[r])))
                            counts.append(wd.pack(c[a:b].astype(np.uint32)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.int64()), pa.array([rb.column(0)[i].as_py()] * len(part), pa.int64()),
                     pa.array(keys, pa.binary()), pa.array(counts, pa.binary())],
                    names=["part", "block", "keys", "counts"])

    return blocks.mapInArrow(run, "part long, block long, keys binary, counts binary")


def answers(asked: DataFrame, ranges: int) -> DataFrame:
    """part, block, totals: the corpus count of every n-gram a block asked for, in its order."""
    def run(table: pa.Table) -> pa.Table:
        start = _range_starts(ranges)[table.column("part")[0].as_py() % ranges]
        keys = [np.cumsum(wd.unpack(x, np.uint64), dtype=np.uint64) + start for x in table.column("keys").to_pylist()]
        counts = [wd.unpack(x, np.uint32) for x in table.column("counts").to_pylist()]
        u, inv = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(inv.reshape(-1), weights=np.concatenate(counts), minlength=len(u)).astype(np.int64)
        ends = np.cumsum([len(k) for k in keys])
        mine = total[inv.reshape(-1)]
        return pa.table({"part": table.column("part"), "block": table.column("block"),
                         "totals": pa.array([wd.pack(x) for x in np.split(mine, ends[:-1])], pa.binary())})

    return asked.groupBy("part").applyInArrow(run, "part long, block long, totals binary")


def log_scores(g: Grams, n_rows: int, totals: list[np.ndarray], n: int, alpha: float) -> np.ndarray:
    """Sum of log S per document; ``totals``: corpus counts of the block's distinct n-grams by order."""
    length = np.bincount(g.row, minlength=n_rows)
    rest = np.maximum(n - length, 1)[g.row].astype(np.float64)
    others = []  # per order: occurrences of the n-gram at each word in the other documents
    for key, whole, total in zip(g.key, g.whole, totals):
        out = np.zeros(len(key), dtype=np.int64)
        at = np.flatnonzero(whole)
        if len(at):
            inv = np.unique(key[at], return_inverse=True)[1].reshape(-1)
            _, own_of, own = np.unique(inv * n_rows + g.row[at], return_inverse=True, return_counts=True)
            out[at] = total[inv] - own[own_of.reshape(-1)]
        others.append(out)
    score = np.maximum(others[0], 1) / rest
    for k in range(1, len(others)):
        seen = others[k] > 0
        before = np.ones(len(score), dtype=np.int64)
        before[1:] = others[k - 1][:-1]  # the context is the shorter n-gram that ends one word earlier
        score = np.where(g.whole[k], np.where(seen, others[k] / np.maximum(before, 1), alpha * score), score)
    return np.bincount(g.row, weights=np.log(score), minlength=n_rows)


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER,
                    alpha: float = ALPHA) -> DataFrame:
    """doc_id, n_words, log_score (rounded to six digits) of every document."""
    src = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                      F.col(f"`{text_col}`").cast("string").alias("text"))
    blocks = materialize(blocks_of(src), "lm-blocks")
    n = int(blocks.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0])
    ranges = max(RANGES, -(-n // RANGE_KEYS))
    told = [materialize(answers(requests(blocks, k, ranges, k), ranges), f"lm-answers-{k}")
            for k in range(1, order + 1)]

    def run(one: pa.Table, two: pa.Table) -> pa.Table:
        row = one.slice(0, 1)
        offs = row.column("offs").chunk(0)[0].values.to_numpy()
        g = Grams(row.column("texts")[0].as_py(), offs, order)
        parts = sorted(zip(two.column("part").to_pylist(), two.column("totals").to_pylist()))
        totals = [np.concatenate([np.zeros(0, np.int64), *[
            wd.unpack(t, np.int64) for p, t in parts if p // ranges == k]]) for k in range(order)]
        n_rows = len(offs) - 1
        return pa.table({
            "doc_id": pa.array(row.column("ids")[0].as_py(), pa.int64()),
            "n_words": np.bincount(g.row, minlength=n_rows).astype(np.int64),
            "log_score": np.round(log_scores(g, n_rows, totals, n, alpha), 6) + 0.0})

    return blocks.groupBy("block").cogroup(reduce(DataFrame.union, told).groupBy("block")).applyInArrow(
        run, "doc_id long, n_words long, log_score double")
