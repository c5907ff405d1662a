import math
import re
from collections import Counter

import duckdb
import numpy as np

from conftest import SF001
from edge import clash, edge_rows, edge_table, prose
from orderflow.llm import catalog, search, sql
from tools.check_oracle import digest

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _brute(docs, items, k=10):
    held = [(i, Counter(_terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    by_item = {}
    for i, t in items:
        by_item.setdefault(i, set()).update(_terms(t))
    out = []
    for item, ts in by_item.items():
        scores = []
        for i, c in held:
            m = 10 + 90 * sum(c.values()) * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) *
                    (10 ** 9 * c[t] // (1000 * c[t] + 8 * m)) for t in ts if c[t])
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def _got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


ITEMS = [(1, prose(1, 30)), (2, "w1 W1 w2 the one"), (2, "zwei é日本"), (3, None), (4, " \t.!"), (None, prose(5, 12)),
         (7, prose(99, 200)), (8, "no such terms anywhereatall"), (9, "the"), (2, "zwei é日本")]


def test_edge_rows_equal_brute_force(spark):
    docs = clash(edge_table(spark), "item_id", "rank", "score", "term")
    items = clash(spark.createDataFrame(ITEMS, "item_id long, text string"), "doc_id", "score")
    exp = _brute([(r[0], r[1]) for r in edge_rows()], ITEMS)
    assert _got(search.search(docs, items)) == exp
    assert {x[0] for x in exp} == {1, 2, 7, 9, None}


def test_blocks_tasks_and_item_chunks_change_nothing(spark, monkeypatch):
    rows = [(i % 90, prose(i % 130, 20 + i % 50, vocab=300)) for i in range(400)]  # equal ids and texts: ties
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = [(i, prose(1000 + i, 15, vocab=300)) for i in range(25)]
    idf = spark.createDataFrame(items, "item_id long, text string")
    exp = _brute(rows, items)
    assert _got(search.search(docs, idf)) == exp
    monkeypatch.setattr(search, "BLOCK_DOCS", 16)
    monkeypatch.setattr(search.wd, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(search, "CHUNK_BYTES", 500)
    assert _got(search.search(docs.repartition(5), idf)) == exp
    assert _got(search.search(docs.coalesce(1), idf, k=3)) == _brute(rows, items, 3)


def _lists(impacts):
    """A block whose list t holds the documents d with impact impacts[t][d] (as weight 1 and set impacts)."""
    lists = object.__new__(search.ImpactLists)
    term = np.array([t for t, row in enumerate(impacts) for d in row], dtype=np.int64)
    lists.doc = np.array([d for row in impacts for d in sorted(row)], dtype=np.int64)
    lists.impact = np.array([row[d] for row in impacts for d in sorted(row)], dtype=np.int64)
    lists.terms = np.arange(len(impacts))
    lists.start = np.concatenate([[0], np.cumsum([len(r) for r in impacts])]).astype(np.int64)
    lists.n = 1 + max(d for r in impacts for d in r)
    lists.ids = np.arange(lists.n)
    lists.key = term * lists.n + lists.doc
    lists.order = np.lexsort((-lists.impact, term))
    lists.rank = np.empty_like(lists.order)
    lists.rank[lists.order] = np.arange(len(lists.order)) - lists.start[term]
    return lists


def test_search_stops_early_and_strictly_below_the_kth_score():
    # one list falls steeply, the other is flat: few documents need a look
    steep = {d: 10_000 // (d + 1) for d in range(5000)}
    flat = {d: 5 for d in range(0, 5000, 7)}
    best = search.Best(3)
    scored = _lists([steep, flat]).search(np.array([0, 1]), best)
    assert best.doc.tolist() == [0, 1, 2] and scored < 200
    # all scores tie: the smallest ids win though the bound never falls below the k-th score
    best = search.Best(3)
    tie = {d: 9 for d in range(300)}
    assert _lists([tie]).search(np.array([0]), best) == 300
    assert best.doc.tolist() == [0, 1, 2]
    # a bar from other blocks ends the search before the first access
    best = search.Best(1)
    best.add(np.array([10 ** 6]), np.array([77]))
    assert _lists([steep, flat]).search(np.array([0, 1]), best) == 0


def test_query_equals_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    exp = con.execute(sql.search_sql()).df()
    assert len(exp) > 100
    assert digest(catalog.op11_best_position_search(spark, SF001).toPandas()) == digest(exp)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert search.search(docs, items).count() == 0
    assert search.search(edge_table(spark), items.limit(0)).count() == 0
    assert search.search(spark.createDataFrame([(1, None), (2, " ")], "doc_id long, text string"), items).count() == 0
