"""Bound-certified best-fit packing of documents into token sequences.

Documents are encoded, closed by ``end_id`` and cut into pieces of at most
``capacity`` tokens (only longer ones are cut; their first piece may be
shorter).  The pieces are dealt by a hash of their place in the written table of
pieces (so repeated rows are spread like any others) to partitions of about
``PART_ROWS``; each partition packs its own by best-fit decreasing: longest
first, into the fullest sequence that still has room.

Every partition also computes a lower bound on the sequences *any* packing of
its pieces needs, from dual-feasible functions on its length histogram: the
plain sum, the threshold family (lengths over C - t count as whole, lengths
under t as nothing, for every t up to C / 2) and the rounding family.  The
same bound over the whole table (from its histogram, ``capacity`` numbers)
certifies the total.  While the total is above it, every partition keeps its
well-filled sequences and gives up its least filled ones, more of them the
further it is from its own bound; the pieces of those are dealt anew over
fewer partitions and packed again.  The new packing is taken when it needs
fewer sequences than the ones given up.  It ends when the bound is met, when
one partition holds all that is left, or when a round brings no gain.

A task holds one partition: some thousand lengths; the driver gets the
histogram's counts, at most ``capacity`` numbers.  Within a partition nothing
depends on the order of rows: ties are broken by length, id, piece and checksum.

Defined cases: null text is empty (the end id alone); repeated rows are packed
each; a null id is packed like any other; an empty table gives no rows; only
the id and the text are read, so other columns may have any names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm import words as wd
from orderflow.llm.tokens import encoder
from orderflow.session import materialize

CAPACITY, END_ID, PART_ROWS, BLOCK_BYTES = 2048, 0, 4096, 2 << 20
# a sequence's number: round, partition, number in the partition
SEQ_BITS, PART_BITS = 20, 34
_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece; ``ids`` adds the token ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for rb, data, offs in wd.blocks(batches, "text", BLOCK_BYTES):
            flat, at = enc.encode(data, offs)
            row, piece, start, length, crc, lists = [], [], [], [], [], []
            for r, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
                doc = np.append(flat[a:b], np.uint32(end_id))
                lo, k = 0, 0
                hi = len(doc) % capacity or capacity
                while lo < len(doc):
                    part = doc[lo:hi]
                    row.append(r), piece.append(k), start.append(lo), length.append(hi - lo)
                    crc.append(zlib.crc32(part.astype("<u4").tobytes()))
                    if ids:
                        lists.append(part.astype(np.int32))
                    lo, hi, k = hi, hi + capacity, k + 1
            cols = [rb.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            if ids:
                cols.append(pa.array(lists, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(
                cols, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:len(cols)])

    src = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                      F.col(f"`{text_col}`").cast("string").alias("text"))
    return src.mapInArrow(run, _PIECE + (", ids array<int>" if ids else ""))


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Sequences that no packing of these lengths can do without."""
    return bound_of(np.bincount(lengths, minlength=capacity + 1)[:capacity + 1], capacity)


def bound_of(hist: np.ndarray, capacity: int) -> int:
    """The same from the number of pieces of every length, 0 to ``capacity``."""
    hist = hist.astype(np.int64)
    if not hist.any():
        return 0
    size = np.arange(capacity + 1, dtype=np.int64)
    count, total = np.cumsum(hist), np.cumsum(hist * size)
    best = -(-int(total[-1]) // capacity)
    # thresholds: lengths over capacity - t are whole, those under t are nothing
    t = np.arange(1, capacity // 2 + 1)
    whole = count[-1] - count[capacity - t]
    middle = total[capacity - t] - total[t - 1]
    best = max(best, int((whole + -(-middle // capacity)).max()))
    # rounding: length x counts floor((k + 1) x / capacity) of k parts, exact multiples their share
    for k in range(1, 21):
        parts = (k + 1) * size // capacity
        exact = (k + 1) * size % capacity == 0
        value = np.where(exact, size * k, parts * capacity)  # in units of 1 / (k * capacity)
        best = max(best, -(-int((hist * value).sum()) // (k * capacity)))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, offset) of each length, given longest first, and the tokens in each sequence."""
    open_by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some sequence has room for exactly r more
    seq, off, fill = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    for i, n in enumerate(lengths.tolist()):
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            s = open_by_room[room].pop()
            if not open_by_room[room]:
                rooms ^= 1 << room
        else:
            room, s = capacity, len(fill)
            fill.append(0)
        seq[i], off[i] = s, capacity - room
        fill[s] += n
        if room > n:
            open_by_room[room - n].append(s)
            rooms |= 1 << (room - n)
    return seq, off, np.array(fill, dtype=np.int64)


_PACKED = _PIECE + ", place long, part long, seq long, offset long, given boolean, sequences long, given_up long"


def pack_parts(dealt: DataFrame, capacity: int) -> DataFrame:
    """Best-fit decreasing in every ``part``; ``given``: in a sequence that the partition gives up."""
    def run(table: pa.Table) -> pa.Table:
        t = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"),
                           ("ids_crc32", "ascending")])
        lengths = t.column("length").to_numpy()
        seq, off, fill = best_fit(lengths, capacity)
        if len(fill) >> SEQ_BITS:
            raise ValueError("too many sequences in one partition to number")
        bound = lower_bound(lengths, capacity)
        gap = len(fill) - bound
        given = np.zeros(len(fill), dtype=bool)
        worst = np.argsort(fill, kind="stable")[:16 * (1 + gap)]
        given[worst] = fill[worst] < capacity
        n = len(lengths)
        first = np.zeros(n, dtype=bool)
        first[:1] = True  # the partition's figures stand in one row
        return pa.table({
            **{c: t.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32", "place", "part")},
            "seq": seq, "offset": off, "given": given[seq],
            "sequences": np.where(first, len(fill), 0), "given_up": np.where(first, given.sum(), 0)})

    return dealt.groupBy("part").applyInArrow(run, _PACKED)


def deal(rows: DataFrame, n: int, turn: int) -> tuple[DataFrame, int]:
    parts = max(1, -(-n // PART_ROWS))
    return rows.withColumn("part", F.pmod(F.xxhash64(F.lit(turn), "place"), F.lit(parts))), parts


def pack(rows: DataFrame, capacity: int = CAPACITY, rounds: int | None = None) -> DataFrame:
    """Pieces with sequence_id and offset; ``rounds``: at most so many (None: as long as they gain)."""
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    rows = materialize(rows.select(*columns, F.monotonically_increasing_id().alias("place")), "pieces")
    hist = np.zeros(capacity + 1, dtype=np.int64)
    for r in rows.groupBy("length").count().collect():  # at most ``capacity`` rows
        hist[r[0]] = r[1]
    bound, n = bound_of(hist, capacity), int(hist.sum())
    done, left, before, kept, turn = [], rows, None, 0, 0
    while rounds is None or turn < rounds:
        dealt, parts = deal(left.select(*columns, "place"), n, turn)
        if parts >> PART_BITS or turn >> 63 - SEQ_BITS - PART_BITS:
            raise ValueError("too many partitions or rounds to number sequences by")
        packed = materialize(pack_parts(dealt, capacity), f"packed-{turn}")
        s = packed.agg(F.sum("sequences"), F.sum("given_up"), F.count(F.when(F.col("given"), 1))).first()
        used, given, n = int(s[0] or 0), int(s[1] or 0), int(s[2])
        if before is not None and used >= before:
            done.append(left)  # no better than what was given up: those sequences stay
            left = None
            break
        numbered = packed.withColumn("sequence_id", F.lit(turn << SEQ_BITS + PART_BITS)
                                     + F.col("part") * (1 << SEQ_BITS) + F.col("seq"))
        if kept + used == bound or parts == 1:
            left = numbered
            break
        done.append(numbered.where("NOT given"))
        left = numbered.where("given")
        before, kept, turn = given, kept + used - given, turn + 1
    if left is not None:
        done.append(left)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(pieces(docs, tokenizer, id_col, text_col, capacity, end_id), capacity)
