"""Vectorised text helpers used inside Arrow tasks.

A text column of an Arrow batch is one byte buffer plus offsets; words,
lines and hashes are found on that buffer with numpy, so a task handles
whole blocks of documents and never loops over characters.  Blocks are cut
by bytes (``BLOCK_BYTES``), so a task's memory does not depend on the number
of rows in a batch; one text larger than a block is a block of its own.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D.
"""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

BLOCK_BYTES = 4 << 20

_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def pack(x: np.ndarray) -> bytes:
    """Whole numbers, sorted or small, by byte planes (the upper ones hardly vary), compressed."""
    planes = np.ascontiguousarray(x.reshape(-1, 1).view(np.uint8).reshape(len(x), x.itemsize).T)
    return zlib.compress(planes.tobytes(), 1)


def unpack(raw: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(raw), dtype=np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def fresh(columns, name: str) -> str:
    """``name``, or the first ``name_<i>`` that no column bears (Spark ignores case)."""
    taken = {c.lower() for c in columns}
    out, i = name, 0
    while out.lower() in taken:
        i += 1
        out = f"{name}_{i}"
    return out


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column (null: empty) and its row offsets, from 0."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    bufs = column.buffers()
    offs = np.frombuffer(bufs[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] else np.zeros(0, dtype=np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text",
           limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with about ``limit`` text bytes: (slice, bytes, offsets)."""
    for rb in batches:
        if rb.num_rows == 0:
            continue
        data, offs = text_bytes(rb.column(rb.schema.get_field_index(text)))
        first = 0
        while first < rb.num_rows:
            last = int(np.searchsorted(offs, offs[first] + limit, side="right")) - 1
            last = min(max(last, first + 1), rb.num_rows)
            part = offs[first:last + 1]
            yield rb.slice(first, last - first), data[part[0]:part[-1]], part - part[0]
            first = last
        del rb, data, offs, part  # not beside the next batch
    release()


def release() -> None:
    """Give freed memory back: a worker outlives its task, and keeps it through stages that do without Python."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def per_row(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Number of set flags (one per byte) in each row."""
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def as_binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary array over contiguous slices of ``data``."""
    return pa.Array.from_buffers(
        pa.large_binary(), len(offsets) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offsets, dtype=np.int64)),
         pa.py_buffer(np.ascontiguousarray(data))])


def encode(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Dictionary codes of ``values`` and the distinct values."""
    d = values.dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary


def byte_list(values: pa.Array) -> list[bytes]:
    """The values of a binary array without nulls, sooner than by its scalars."""
    values = values.cast(pa.large_binary())
    raw = values.buffers()[2].to_pybytes() if len(values) else b""
    at = np.frombuffer(values.buffers()[1], dtype=np.int64)[values.offset:values.offset + len(values) + 1].tolist()
    return [raw[a:b] for a, b in zip(at[:-1], at[1:])]


def words(data: np.ndarray, offs: np.ndarray,
          gap: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row of each word, first byte, byte after the last, space flag of each byte).

    ``gap``: which of the 256 bytes part words (white space by default)."""
    space = gap[data]
    word = ~space
    edge = np.ones(len(data) + 1, dtype=bool)
    edge[1:-1] = space[:-1] | space[1:]
    before = np.ones(len(data), dtype=bool)
    before[1:] = space[:-1]
    inner = offs[(offs > 0) & (offs < len(data))]
    before[inner] = True
    after = np.ones(len(data), dtype=bool)
    after[:-1] = space[1:]
    after[inner - 1] = True
    starts = np.flatnonzero(word & before)
    ends = np.flatnonzero(word & after) + 1
    row = np.searchsorted(offs[1:], starts, side="right")
    return row, starts, ends, space


def word_codes(data: np.ndarray, offs: np.ndarray,
               gap: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(row of each word, code of each word, distinct words of the block)."""
    row, starts, ends, space = words(data, offs, gap)
    lens = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=lens[1:])
    codes, distinct = encode(as_binary(data[~space], lens))
    return row, codes, distinct


def hash64(values: pa.Array, seed: int = 0) -> np.ndarray:
    """xxHash64 of each (distinct) binary value."""
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(v, seed) for v in byte_list(values)), dtype=np.uint64, count=len(values))


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every input bit over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def windows(values: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every window of ``n`` consecutive values (order matters)."""
    m = len(values) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    acc = np.zeros(m, dtype=np.uint64)
    for i in range(n):
        acc = mix64(acc * _GOLDEN + values[i:i + m])
    return acc
