"""Substring dedup by hashing the lines of a text and the sentences in them.

Units are normalised (A-Z lower-cased, white space between words made one
space) and hashed to 128 bits; digests are grouped over the whole table.  The
earliest occurrence -- smallest document id, then smallest text hash, then
position -- stays.  There are two units:

* a line with its words, of any length: every later line of the same digest
  is removed, so no whole line (or paragraph of whole lines) recurs;
* a sentence: it begins at the first word of a line or behind a word that ends
  in ``.``, ``!`` or ``?``.  Sentences find passages that were set into other
  lines.  A maximal run of consecutive units that occur earlier (sentences, or lines
  that go anyway) is removed if it spans at least ``min_chars`` characters;
  shorter ones inside a line stay, so a stock phrase does not cost a line its middle.

The result keeps the original offsets: ``removed`` lists the removed spans
(code points, end exclusive) of the input text, ``text`` is the rest.

Plan: units leave the scan as narrow rows (two hash words, document, number);
only the first occurrence within a document goes to the grouping, which
aggregates before its shuffle, and only digests of two or more documents come
back to the units by an inner join that AQE may split.  The repeats of one
document (never more than it has units) are gathered and joined to its text
by (id, text hash).

Defined cases: null text counts as empty and comes back as null, lines without
words stay; rows with equal id and text are one occurrence and are treated
alike; a null id ranks last; repeats within one document count like repeats
across documents; a text of any length is one document; an empty table gives
no rows; input columns may have any names, one named ``removed`` is replaced
where that column is asked for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.llm import words as wd
from orderflow.session import materialize

MIN_CHARS = 120
SENTENCE, LINE, BOTH = 0, 1, 2
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".!?")] = True


class Units:
    """The units of a block of texts."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        row, starts, ends, space = wd.words(data, offs)
        n = len(starts)
        begin, newline = np.ones(n, dtype=bool), np.ones(n, dtype=bool)
        if n > 1:
            breaks = np.zeros(len(data) + 1, dtype=np.int64)
            np.cumsum(data == 10, out=breaks[1:])
            newline[1:] = (row[1:] != row[:-1]) | (breaks[starts[1:]] > breaks[ends[:-1]])
            begin[1:] = newline[1:] | _STOP[data[ends[:-1] - 1]]
        first = np.flatnonzero(begin)
        self.row = row[first]                                   # row of each unit
        self.lines = np.flatnonzero(newline[first])             # first unit of each line
        self.start = starts[first]                              # first byte of the unit's first word
        self.of_row = np.searchsorted(self.row, np.arange(len(offs)))  # first unit of each row
        # normalised: words with one space between the words of a unit
        keep = ~space
        inner = np.flatnonzero(~begin)                          # words that follow another of their unit
        keep[starts[inner] - 1] = True
        low = wd.lower_ascii(data)
        low[starts[inner] - 1] = 0x20
        total = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(keep, out=total[1:])
        at = np.append(total[self.start], total[-1])
        raw = low[keep].tobytes()
        h = xxhash.xxh3_128_digest
        digests = b"".join(h(raw[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist()))
        self.digest = np.frombuffer(digests, dtype=np.int64).reshape(-1, 2)

        # the digest of a line of several sentences
        self.line_digest = self.digest[self.lines]
        size = np.diff(np.append(self.lines, len(first)))
        for i in np.flatnonzero(size > 1).tolist():
            u = int(self.lines[i])
            whole = b" ".join(raw[at[k]:at[k + 1]] for k in range(u, u + int(size[i])))
            self.line_digest[i] = np.frombuffer(h(whole), dtype=np.int64)
        self.single = size == 1

    def new_in_row(self) -> tuple[np.ndarray, np.ndarray]:
        """Units, and lines, whose digest does not occur earlier in their row."""
        return _first(self.row, self.digest), _first(self.row[self.lines], self.line_digest)

    def of_lines(self, flags: np.ndarray) -> np.ndarray:
        """A flag of each line as a flag of each of its units."""
        return np.repeat(flags, np.diff(np.append(self.lines, len(self.row))))


def _first(row: np.ndarray, digest: np.ndarray) -> np.ndarray:
    if not len(row):
        return np.zeros(0, dtype=bool)
    order = np.lexsort((np.arange(len(row)), digest[:, 1], digest[:, 0], row))
    k = np.column_stack([row, digest])[order]
    out = np.zeros(len(row), dtype=bool)
    out[order] = np.concatenate([[True], (k[1:] != k[:-1]).any(axis=1)])
    return out


def _text_hash(text: Column) -> Column:
    """Tells the texts of one id apart (null: empty)."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def unit_rows(docs: DataFrame) -> DataFrame:
    """h1, h2, doc_id, text_hash, unit, kind of every sentence and line that is new in its document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb, data, offs in wd.blocks(batches, "text"):
            u = Units(data, offs)
            unit, line = u.new_in_row()
            # a line of one sentence is one row for both if it is new as either
            kind = np.full(len(u.row), -1)
            kind[unit] = SENTENCE
            alone = u.lines[line & u.single]
            kind[alone] = np.where(kind[alone] == SENTENCE, BOTH, LINE)
            at, several = np.flatnonzero(kind >= 0), line & ~u.single
            digest = np.concatenate([u.digest[at], u.line_digest[several]])
            kind = np.concatenate([kind[at], np.full(int(several.sum()), LINE)]).astype(np.int8)
            at = np.concatenate([at, u.lines[several]])
            row = u.row[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(digest[:, 0]), pa.array(digest[:, 1]), rb.column(0).take(pa.array(row)),
                 rb.column(2).take(pa.array(row)), pa.array((at - u.of_row[row]).astype(np.int32)), pa.array(kind)],
                names=["h1", "h2", "doc_id", "text_hash", "unit", "kind"])

    return docs.select("doc_id", "text", _text_hash(F.col("text")).alias("text_hash")).mapInArrow(
        run, "h1 long, h2 long, doc_id long, text_hash long, unit int, kind byte")


def repeats(units: DataFrame) -> DataFrame:
    """doc_id, text_hash, units: twice the number of every sentence, twice and one that of the first sentence
    of every line, whose earliest occurrence is elsewhere."""
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    line = F.when(F.col("kind") != SENTENCE, rank)
    first = (units.groupBy("h1", "h2").agg(F.min(rank).alias("first"), F.max(rank).alias("other"),
                                           F.min(line).alias("first_line"))
             .where(~F.col("first").eqNullSafe(F.col("other"))).select("h1", "h2", "first", "first_line"))

    def elsewhere(c: str) -> Column:
        return ~(F.col("doc_id").eqNullSafe(F.col(f"{c}.doc_id")) & (F.col("text_hash") == F.col(f"{c}.text_hash")))

    again = units.join(first, ["h1", "h2"]).select("doc_id", "text_hash", F.explode(F.array_compact(F.array(
        F.when((F.col("kind") != LINE) & elsewhere("first"), 2 * F.col("unit")),
        F.when((F.col("kind") != SENTENCE) & elsewhere("first_line"), 2 * F.col("unit") + 1)))).alias("unit"))
    return again.groupBy("doc_id", "text_hash").agg(F.collect_set("unit").alias("units"))


def remove_spans(u: Units, data: np.ndarray, offs: np.ndarray, again: np.ndarray, gone: np.ndarray,
                 min_chars: int) -> tuple[list[bytes], list[list[dict]]]:
    """The rest of every row and its removed spans in code points.

    ``gone``: units of lines to remove; ``again``: units that occur earlier, removed in runs of ``min_chars``."""
    end = np.append(u.start[1:], len(data))
    end[u.of_row[1:][np.diff(u.of_row) > 0] - 1] = offs[1:][np.diff(u.of_row) > 0]
    chars = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=chars[1:])

    def runs(flags: np.ndarray) -> list[list[int]]:
        """Stretches of set flags within a row."""
        at = np.flatnonzero(flags)
        if not len(at):
            return []
        cut = np.flatnonzero((np.diff(at) > 1) | (u.row[at[1:]] != u.row[at[:-1]])) + 1
        return [[int(x[0]), int(x[-1]) + 1] for x in np.split(at, cut)]

    drop = gone.copy()
    for i, j in runs(gone | again):
        if chars[end[j - 1]] - chars[u.start[i]] >= min_chars:
            drop[i:j] = True
    by_row: dict[int, list[list[int]]] = {}
    for i, j in runs(drop):
        by_row.setdefault(int(u.row[i]), []).append([i, j])
    rest, spans, raw = [], [], data.tobytes()
    for r in range(len(offs) - 1):
        lo, hi = int(offs[r]), int(offs[r + 1])
        kept, cut = [], []
        for i, j in by_row.get(r, []):
            s, e = int(u.start[i]), int(end[j - 1])
            kept.append(raw[lo:s])
            cut.append({"start": int(chars[s] - chars[offs[r]]), "end": int(chars[e] - chars[offs[r]])})
            lo = e
        kept.append(raw[lo:hi])
        rest.append(b"".join(kept))
        spans.append(cut)
    return rest, spans


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_chars: int = MIN_CHARS, detail: bool = True) -> DataFrame:
    """All columns of ``docs`` with the rest of the text; ``detail`` adds the column ``removed``
    (an input column of that name is replaced by it)."""
    src = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                      F.col(f"`{text_col}`").cast("string").alias("text"))
    found = materialize(repeats(unit_rows(src)), "passage-repeats")

    # the input's columns go by number here, so no name can clash
    own = {f"c{i}": c for i, c in enumerate(docs.columns)}
    others = [k for k, c in own.items() if c.lower() != text_col.lower()]
    text_at = next(k for k, c in own.items() if c.lower() == text_col.lower())
    held = docs.select(*[F.col(f"`{own[k]}`").alias(k) for k in others],
                       F.col(f"`{id_col}`").cast("bigint").alias("id"),
                       F.col(f"`{text_col}`").cast("string").alias(text_at))

    # no Python here: with a broadcast of ``found`` it would run beside ``strip``, two workers to a task
    held = held.withColumn("hash", _text_hash(F.col(text_at)))
    f = found.select(F.col("doc_id").alias("i"), F.col("text_hash").alias("h"), "units")
    both = held.join(f, F.col("id").eqNullSafe(F.col("i")) & (F.col("hash") == F.col("h")), "left").select(
        *others, text_at, "units")
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([*both.schema.fields[:-1], T.StructField("removed", span)])
    arrow_span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb, data, offs in wd.blocks(batches, text_at):
            u = Units(data, offs)
            again, line = (~x for x in u.new_in_row())
            lists = rb.column(rb.num_columns - 1)
            for r in np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False)).tolist():
                found = lists[r].values.to_numpy()
                again[u.of_row[r] + found[found % 2 == 0] // 2] = True
                line[np.searchsorted(u.lines, u.of_row[r] + found[found % 2 == 1] // 2)] = True
            rest, spans = remove_spans(u, data, offs, again, u.of_lines(line), min_chars)
            was_null = rb.column(rb.num_columns - 2).is_null().to_pylist()
            text = pa.array([None if z else x for x, z in zip(rest, was_null)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*rb.columns[:-2], text, pa.array(spans, arrow_span)],
                                             names=[*others, text_at, "removed"])

    out = both.mapInArrow(strip, schema)
    keep = [k for k in own if not (detail and own[k].lower() == "removed")]
    return out.select(*[F.col(k).alias(own[k]) for k in keep], *(["removed"] if detail else []))


def strip_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars",
                  **options) -> DataFrame:
    """``docs`` with the repeats removed from the text and, where there is one, ``chars_col`` brought up to date."""
    out = remove_repeats(docs, id_col, text_col, detail=False, **options)
    if chars_col in docs.columns:
        kind = docs.schema[chars_col].dataType
        out = out.withColumn(chars_col, F.char_length(f"`{text_col}`").cast(kind))
    return out
