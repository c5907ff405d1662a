"""Ranked lexical search by the Best Position Algorithm over impact lists.

For every item of a query set, the ``k`` documents with the highest scores.
Terms are runs of letters, digits and non-ASCII characters, A-Z lower-cased.
With N documents that hold a term, L terms in all of them, n terms in a
document, df documents that hold the term and tf occurrences in the document
(all over the whole table, copies included):

    w      = floor(1000 * ln((2 N + 2) / (2 df + 1)))
    m      = 10 + (90 n N) div L
    impact = w * ((10^9 tf) div (1000 tf + 8 m)),   score = sum over the item's distinct terms

1. One pass over the texts writes index blocks of at most ``BLOCK_DOCS``
   documents: the postings of the query terms, ordered by term and document.
2. Document frequencies, N and L are summed from the blocks.
3. Every block turns its postings into impact lists (highest first) and
   answers every item by the Best Position Algorithm: each list knows which
   of its positions have been seen -- read from the list or reached by a
   direct access from another list -- and its best position, the end of the
   gapless run of seen ones.  A round reads the next unseen positions behind
   each best position and scores their documents by direct accesses to all
   lists, which marks their positions seen.  No document that is still
   unseen can score more than the sum of the impacts that follow the best
   positions; the search of an item ends when that sum is strictly below its
   k-th score, so equal scores are all found.  A task carries the k best of
   every item from block to block, which is the bar for its later blocks.
4. The k best of every task are merged per item.

The query set is read in chunks of about ``CHUNK_BYTES`` of text (by a hash of
the item id; each chunk is a pass of its own over the documents), so what is
sent to the tasks and gathered on the driver -- a chunk's terms and their
document frequencies -- is bounded whatever the size of either table.

Defined cases: rows of one item id are one item with the terms of all its
texts (a null id is an id); null or blank texts have no terms, an item without
terms or matches has no rows; every row of ``docs`` is a document, also if id
or text repeat; equal scores go by ascending document id, null last; empty
tables give no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm import words as wd
from orderflow.session import materialize

TOP = 10
BLOCK_DOCS, BLOCK_POSTINGS, CHUNK_BYTES = 8192, 2_000_000, 8 << 20
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_GAP = np.zeros(256, dtype=bool)
_GAP[:0x80] = True
for _a, _b in (("0", "9"), ("A", "Z"), ("a", "z")):
    _GAP[ord(_a):ord(_b) + 1] = False
_LAST = np.iinfo(np.int64).max


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, term: the distinct terms of every item."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    t = F.translate(F.col(f"`{text_col}`").cast("string"), upper, lower)
    found = F.regexp_extract_all(t, F.lit(TERM), F.lit(0))
    return items.select(F.col(f"`{id_col}`").cast("bigint").alias("item_id"), F.explode(found).alias("term")).distinct()


def index_blocks(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """held (documents with terms), total (their terms), ids, lengths, terms, df, doc, tf: one row per block.

    ``terms`` are numbers of the vocabulary's terms that occur, ``df`` their postings in
    the block; ``doc`` and ``tf`` are the postings in the order of (term, document)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array([t.encode() for t in vocabulary], pa.large_binary())
        ids, lengths, posts, n, n_posts = [], [], [], 0, 0

        def block() -> pa.RecordBatch:
            length = np.concatenate(lengths)
            term, doc, tf = (np.concatenate(x) for x in zip(*posts))
            order = np.lexsort((doc, term))
            u, df = np.unique(term, return_counts=True)
            row = [int((length > 0).sum()), int(length.sum()), [x for i in ids for x in i],
                   *(wd.pack(x) for x in (length, u, df, doc[order], tf[order]))]
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 5]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=_BLOCK_NAMES)

        for rb, data, offs in wd.blocks(batches, "text"):
            row, codes, distinct = wd.word_codes(wd.lower_ascii(data), offs, _GAP)
            code = pc.index_in(distinct.cast(pa.large_binary()), value_set=wanted)
            code = code.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            term = code[codes] if len(codes) else codes
            hit = np.flatnonzero(term >= 0)
            key, tf = np.unique(term[hit] * rb.num_rows + row[hit], return_counts=True)
            if n and (n + rb.num_rows > BLOCK_DOCS or n_posts + len(key) > BLOCK_POSTINGS):
                yield block()
                ids, lengths, posts, n, n_posts = [], [], [], 0, 0
            ids.append(rb.column(0).to_pylist())
            lengths.append(np.bincount(row, minlength=rb.num_rows).astype(np.int64))
            posts.append((key // rb.num_rows, key % rb.num_rows + n, tf.astype(np.int64)))
            n, n_posts = n + rb.num_rows, n_posts + len(key)
        if n:
            yield block()

    return docs.mapInArrow(run, _BLOCK)


_BLOCK = ("held long, total long, ids array<long>, lengths binary, terms binary, df binary, "
          "doc binary, tf binary")
_BLOCK_NAMES = [x.split()[0] for x in _BLOCK.split(", ")]


def document_frequencies(blocks: DataFrame) -> dict[int, int]:
    """Term number -> documents that hold it; at most the vocabulary's terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for t, d in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(wd.unpack(t, np.int64)), pa.array(wd.unpack(d, np.int64))],
                                                 names=["term", "df"])

    rows = blocks.select("terms", "df").mapInArrow(run, "term long, df long")
    return {r[0]: r[1] for r in rows.groupBy("term").agg(F.sum("df").alias("df")).collect()}


class Best:
    """The k best documents of an item so far: highest score first, then smallest id (null last)."""

    def __init__(self, k: int):
        self.k, self.score, self.doc = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def bar(self) -> int:
        """The k-th score; 0 while there are fewer."""
        return int(self.score[-1]) if len(self.score) == self.k else 0

    def add(self, score: np.ndarray, doc: np.ndarray) -> None:
        ok = (score > 0) & (score >= self.bar())
        score, doc = np.concatenate([self.score, score[ok]]), np.concatenate([self.doc, doc[ok]])
        order = np.lexsort((doc, -score))[:self.k]
        self.score, self.doc = score[order], doc[order]


class ImpactLists:
    """The postings of a block, by document for direct accesses and by impact for reading."""

    def __init__(self, row: dict, weight: np.ndarray, n_docs: int, n_terms: int):
        length, self.terms, df, self.doc, tf = (
            wd.unpack(row[c], np.int64) for c in ("lengths", "terms", "df", "doc", "tf"))
        ids = row["ids"]
        self.ids = np.array([_LAST if i is None else i for i in ids], dtype=np.int64)
        self.n = len(ids)
        if len(length) and 90 * int(length.max()) * n_docs > _LAST:  # beyond 64 bits on the way
            m = np.array([10 + 90 * x * n_docs // n_terms for x in length.tolist()], dtype=np.int64)
        else:
            m = 10 + 90 * length * n_docs // max(1, n_terms)
        self.start = np.concatenate([[0], np.cumsum(df)]).astype(np.int64)
        term = np.repeat(np.arange(len(df)), df)
        self.key = term * self.n + self.doc
        self.impact = weight[self.terms[term]] * (10 ** 9 * tf // (1000 * tf + 8 * m[self.doc]))
        self.order = np.lexsort((-self.impact, term))   # posting at each place of the impact lists
        self.rank = np.empty_like(self.order)
        self.rank[self.order] = np.arange(len(self.order)) - self.start[term]  # place in its own list

    def search(self, terms: np.ndarray, best: Best, width: int = 16) -> int:
        """Best-position search of the terms' lists; returns the documents scored."""
        t = np.searchsorted(self.terms, terms)
        t = t[(t < len(self.terms)) & (self.terms[np.minimum(t, len(self.terms) - 1)] == terms)] if len(self.terms) else t[:0]
        begin, size = self.start[t], self.start[t + 1] - self.start[t]
        base = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        seen = np.zeros(int(base[-1]), dtype=bool)   # by list and position
        at = np.zeros(len(t), dtype=np.int64)        # best position of each list
        scored = 0
        while True:
            more = np.flatnonzero(at < size)
            bound = int(self.impact[self.order[begin[more] + at[more]]].sum())
            if bound == 0 or bound < best.bar():
                return scored
            ahead = []
            for i in more.tolist():
                lo, hi = int(at[i]), int(min(at[i] + width, size[i]))
                ahead.append(self.order[begin[i] + lo:begin[i] + hi][~seen[base[i] + lo:base[i] + hi]])
            new = np.unique(self.doc[np.concatenate(ahead)])
            key = (t[:, None] * self.n + new[None, :]).reshape(-1)
            p = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            hit = self.key[p] == key
            best.add(np.where(hit, self.impact[p], 0).reshape(len(t), -1).sum(axis=0), self.ids[new])
            seen[np.repeat(base[:-1], len(new))[hit] + self.rank[p[hit]]] = True
            for i in more.tolist():
                tail = seen[base[i] + at[i]:base[i + 1]]
                gap = int(tail.argmin())
                at[i] += len(tail) if tail[gap] else gap
            scored += len(new)
            width = min(2 * width, 1024)


def search_blocks(blocks: DataFrame, items: list[tuple[int | None, list[int]]], weight: np.ndarray,
                  n_docs: int, n_terms: int, k: int) -> DataFrame:
    """item_id, doc_id, score: the k best documents of every item in every partition of the blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in items]
        terms = [np.array(sorted(t), dtype=np.int64) for _, t in items]
        for rb in batches:
            for i in range(rb.num_rows):
                lists = ImpactLists({c: rb.column(c)[i].as_py() for c in rb.schema.names}, weight, n_docs, n_terms)
                for b, t in zip(best, terms):
                    lists.search(t, b)
        for (item, _), b in zip(items, best):
            if len(b.doc):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(b.doc), pa.int64()), pa.array(b.doc, mask=b.doc == _LAST), pa.array(b.score)],
                    names=["item_id", "doc_id", "score"])

    return blocks.select("ids", "lengths", "terms", "df", "doc", "tf").mapInArrow(
        run, "item_id long, doc_id long, score long")


def _search_chunk(src: DataFrame, terms: DataFrame, k: int) -> DataFrame | None:
    by_item: dict[int | None, list[str]] = {}
    for r in terms.collect():  # the terms of a chunk of items
        by_item.setdefault(r.item_id, []).append(r.term)
    if not by_item:
        return None
    vocabulary = sorted({t for ts in by_item.values() for t in ts})
    number = {t: i for i, t in enumerate(vocabulary)}
    items = sorted(((i, [number[t] for t in ts]) for i, ts in by_item.items()), key=lambda x: (x[0] is None, x[0] or 0))
    blocks = materialize(index_blocks(src, vocabulary), "search-index")
    n_docs, n_terms = blocks.agg(F.coalesce(F.sum("held"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    weight = np.zeros(len(vocabulary), dtype=np.int64)
    for t, df in document_frequencies(blocks).items():
        weight[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    return search_blocks(blocks, items, weight, n_docs, n_terms, k)


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", query_col: str = "text", k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the k highest-scoring documents of every item."""
    src = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                      F.col(f"`{text_col}`").cast("string").alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length(F.col(f"`{query_col}`").cast("string"))), F.lit(0))).first()[0]
    chunks = max(1, -(-int(size) // CHUNK_BYTES))
    terms = item_terms(items, item_col, query_col)
    found = []
    for c in range(chunks):
        part = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(chunks)) == c)
        hits = _search_chunk(src, part, k)
        if hits is not None:
            found.append(hits)
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    hits = found[0]
    for h in found[1:]:
        hits = hits.unionByName(h)
    order = "PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST"
    return hits.selectExpr("item_id", f"row_number() OVER ({order}) AS rank", "doc_id", "score").where(F.col("rank") <= k)
